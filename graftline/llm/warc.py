"""WARC archives: a writer through Spark's text sink and a salvage reader.

Writing: each record is one text row, and the sink's line separator is the two line ends that
close a WARC record; so archives are committed by Spark's own protocol to any file system it
knows. A payload that an earlier page has too becomes a revisit record that names that page.

Reading: a record must have its version line, headers, length, closing line ends and digests in
order (SHA-1, SHA-256, SHA-512 or MD5, in base32 or hex; a digest of another kind is not checked), and a `Payload-Length`, if it has one, that
is the payload's. Sizes and digests of responses are measured, not taken from headers. Where one of these checks fails,
the reader looks for the next version line or gzip member that holds a valid record, goes on from
there, and logs the skipped bytes as a gap with the reason. A gzip member is salvaged inside: of a damaged or
truncated one, what could be inflated is searched alike. Plain archives and archives of gzip members can be mixed.

Scale: one pass over the pages for digests, of which only those that occur more than once travel
on; they are broadcast only below a counted size. Pages are written by classes of size, so that an archive holds
2 * ARCHIVE_BYTES or one record, whatever the pages next to each other are; reading one fits in a task. The
reader's work is linear in the archive: each byte is searched once for either kind of start and for the end of headers, and where
headers fail, the search goes on behind what made them fail. Members are inflated and searched in slices, so a member may inflate to any
size; what is held is a slice or one record. Archives of any name are read, each as one row in a task, which Spark bounds at 2 GB.

Defined results: null html is an empty payload; a null url has no target header; control
characters in urls are percent-encoded; rows that repeat the smallest page_id are all responses;
a null page_id is a revisit of any other; other columns are not read and may have any name; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Generator, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hinted, shared_dir, table

VERSION, MEMBER = b"WARC/", b"\x1f\x8b\x08"
VERSION_LINE = re.compile(rb"WARC/\d\.\d+\r\n")
CRLF = b"\r\n"
END = b"\r\n\r\n"
#: Payloads shorter than this are always responses.
REVISIT_BYTES = 100
ARCHIVE_BYTES = 32_000_000
#: What is inflated at a time, and inflated bytes that are searched at a time.
SLICE, SEARCHED_BYTES = 1 << 16, 1 << 24
#: A record of more doesn't fit in a row.
RECORD_BYTES = (1 << 31) - 1
#: Headers that a record has once.
SINGLE = frozenset(["warc-type", "warc-record-id", "content-length"])
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Record:
    """A record that passed all checks, with its place in the archive (of its gzip member, if it is in one)."""

    headers: dict[str, str]
    payload: bytes
    start: int
    end: int


@dataclass
class Salvaged:
    records: list[Record] = field(default_factory=list)
    #: (first byte, byte after the last, reason)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)


class Damaged(ValueError):
    """Why there is no valid record at a place; where the next one may begin, and how many bytes would be needed to tell if more are to come."""

    def __init__(self, why: str, resume: int = 0, need: int = 0):
        super().__init__(why)
        self.resume, self.need = resume, need


class Starts:
    """The next places of some patterns; nothing is searched twice as long as places only grow."""

    def __init__(self, data: bytes, patterns: tuple[bytes, ...]):
        self.data, self.next = data, dict.fromkeys(patterns, -1)

    def after(self, at: int) -> int:
        for pattern, place in self.next.items():
            if place < at:
                found = self.data.find(pattern, at)
                self.next[pattern] = found if found >= 0 else len(self.data)
        return min(self.next.values())


def digest_matches(value: str, data: bytes) -> bool | None:
    """Whether data has the digest `algorithm:value`; None if the algorithm is not known."""
    name, _, text = value.partition(":")
    if (name := name.lower().replace("-", "")) not in ("md5", "sha1", "sha256", "sha512"):
        return None
    digest, text = hashlib.new(name, data, usedforsecurity=False).digest(), text.strip()
    return text.lower() == digest.hex() or text.rstrip("=").upper() == base64.b32encode(digest).decode().rstrip("=")


def _headers(data: bytes, at: int, close: int) -> dict[str, str]:
    """The headers between the version line at `at` and `close`.

    Another record can't begin, with these headers, between `at` and the line that makes them fail, so that is where the search resumes.
    """
    out: dict[str, str] = {}
    lines: dict[str, int] = {}
    last, begin = "", data.find(CRLF, at) + len(CRLF)
    while begin < close:
        stop = data.find(CRLF, begin, close)
        stop = close if stop < 0 else stop
        line = data[begin:stop]
        if line[:1] in (b" ", b"\t") and last:
            out[last] += " " + line.decode("utf-8", "replace").strip()
        else:
            name, colon, value = line.partition(b":")
            if not colon or b"\n" in line or b"\r" in line:
                raise Damaged("malformed header", begin)
            last = name.decode("latin-1").strip().lower()
            if last in SINGLE and last in lines:
                raise Damaged("repeated header", max(at + 1, lines[last]))
            lines[last] = begin
            out[last] = value.decode("utf-8", "replace").strip()
        begin = stop + len(CRLF)
    return out


def _plain(data: bytes, at: int, ends: Starts, sure: bool = False) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and end of the record whose version line begins at `at`; `sure` asks for a digest that holds."""
    if not VERSION_LINE.match(data, at):
        raise Damaged("no version line", at + 1, at + 64 if len(data) < at + 64 else 0)
    close = ends.after(at)
    if close >= len(data):
        raise Damaged("headers don't end", at + 1, 2 * len(data))
    headers = _headers(data, at, close)
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length", close)
    body = close + len(END)
    stop = body + int(length)
    if stop - at > RECORD_BYTES:
        raise Damaged("longer than a row", close)
    if data[stop : stop + len(END)] != END:
        short = stop + len(END) > len(data)
        raise Damaged("truncated" if short else "length doesn't match", close, stop + len(END) if short else 0)
    block = data[body:stop]
    if headers.get("content-type", "").startswith("application/http"):
        _, found, payload = block.partition(END)
        if not found:
            raise Damaged("no HTTP headers", close)
    else:
        payload = block
    revisit = headers.get("warc-type") == "revisit"
    if (own := headers.get("payload-length")) is not None and not revisit and own != str(len(payload)):
        raise Damaged("payload length doesn't match", close)
    checked = False
    for name, part in (("block", block), ("payload", payload)):
        if (digest := headers.get(f"warc-{name}-digest")) and not (name == "payload" and revisit):
            good = digest_matches(digest, part)
            if good is False:
                raise Damaged(f"{name} digest doesn't match", close)
            checked = checked or good is True
    if sure and not checked:
        raise Damaged("no digest in a damaged member", close)
    return headers, payload, stop + len(END)


def _inflated(data: bytes, at: int) -> Generator[bytes, None, tuple[int, str]]:
    """What the gzip member at `at` inflates to, slice by slice; returns its end and what is wrong with it (empty: nothing)."""
    inflate, view, place = zlib.decompressobj(31), memoryview(data), at
    step = 1 << 10
    while not inflate.eof and place < len(data):
        before, piece = inflate.copy(), view[place : place + step]
        try:
            got = inflate.decompress(piece, SEARCHED_BYTES)
            while not inflate.eof and (inflate.unconsumed_tail or len(got) == SEARCHED_BYTES):
                yield got
                got = inflate.decompress(inflate.unconsumed_tail, SEARCHED_BYTES)
        except zlib.error as e:
            for i in range(len(piece)):  # what comes before the damage
                try:
                    yield before.decompress(piece[i : i + 1])
                except zlib.error:
                    break
            return max(place + i, at + 1), f"gzip member: {e}"
        yield got
        place += len(piece)
        step = min(SLICE, step * 2)
    if not inflate.eof:
        return place, "gzip member is truncated"
    return place - len(inflate.unused_data), ""


def _searched(pieces: Iterable[bytes], sure: bool) -> Iterator[Record | tuple[int, int, str]]:
    """All valid records of bytes that come in pieces, and the ranges between them; holds what may still belong to a record."""
    parts, size, base, need, lost, why = iter(pieces), 0, 0, SEARCHED_BYTES, -1, ""
    held: list[bytes] = []
    final = False
    while not final:
        while size < need and not final:
            piece = next(parts, None)
            final = piece is None
            held += [piece] if piece else []
            size += len(piece or b"")
        data, at = b"".join(held), 0
        starts, ends = Starts(data, (VERSION,)), Starts(data, (END,))
        need = 0
        while at < len(data):
            try:
                headers, payload, end = _plain(data, at, ends, sure)
            except Damaged as e:
                if e.need and not final and data[at : at + len(VERSION)] == VERSION[: len(data) - at]:
                    need = min(e.need - at, RECORD_BYTES)
                    break
                if lost < 0:
                    lost, why = base + at, str(e)
                found = starts.after(e.resume)
                # a version line may begin in the last bytes and go on in the next piece
                at = found if found < len(data) or final else max(at + 1, len(data) - len(VERSION) + 1)
                continue
            if lost >= 0:
                yield lost, base + at, why
                lost = -1
            yield Record(headers, payload, base + at, base + end)
            at = end
        at = min(at, len(data))
        held, size, base = [data[at:]], len(data) - at, base + at
        need = max(need, size + 1, SEARCHED_BYTES)
    if lost >= 0:
        yield lost, base + size, why


def _member(data: bytes, at: int) -> Generator[Record | tuple[int, int, str], None, int]:
    """The records and gaps of the gzip member at `at`; returns its end. Inflated a second time only if it is large."""
    kept: list[bytes] | None = []
    size, head, slices = 0, b"", _inflated(data, at)
    while True:
        try:
            piece = next(slices)
        except StopIteration as done:
            end, wrong = done.value
            break
        head = head or piece[: len(VERSION)]
        size += len(piece)
        kept = [*kept, piece] if kept is not None and size <= SEARCHED_BYTES else None
    gaps: list[tuple[int, int, str]] = []
    any_found = False
    for item in _searched(kept if kept is not None else _inflated(data, at), sure=wrong.startswith("gzip member:")):
        if isinstance(item, Record):
            yield Record(item.headers, item.payload, at, end)
            any_found = True
        else:
            gaps.append((at, end, f"{item[2]} (inflated bytes {item[0]} to {item[1]})"))
    if not any_found and (wrong or not head.startswith(VERSION)):
        raise Damaged(wrong or "no version line", at + 1)
    yield from gaps
    if wrong:  # the rest of the member is lost, up to the next start that holds something
        yield at, end, wrong
    return end


def salvaged(data: bytes) -> Iterator[Record | tuple[int, int, str]]:
    """All valid records of an archive and the byte ranges between them, (first byte, byte after the last, reason), as they are found.

    A gap inside a gzip member is told by the member's range, and in its reason by the range of inflated bytes.
    """
    at, lost, why, starts, ends = 0, -1, "", Starts(data, (VERSION, MEMBER)), Starts(data, (END,))
    while at < len(data):
        try:
            if data.startswith(MEMBER, at):
                inside = _member(data, at)
                while True:
                    try:
                        item = next(inside)
                    except StopIteration as done:
                        end = done.value
                        break
                    if lost >= 0:
                        yield lost, at, why
                        lost = -1
                    yield item
            else:
                headers, payload, end = _plain(data, at, ends)
                if lost >= 0:
                    yield lost, at, why
                    lost = -1
                yield Record(headers, payload, at, end)
        except Damaged as e:
            if lost < 0:
                lost, why = at, str(e)
            at = starts.after(max(at + 1, e.resume)) if not data.startswith(MEMBER, at) else starts.after(at + 1)
            continue
        at = end
    if lost >= 0:
        yield lost, len(data), why


def salvage(data: bytes) -> Salvaged:
    """What `salvaged` finds, as two lists."""
    out = Salvaged()
    for item in salvaged(data):
        out.records.append(item) if isinstance(item, Record) else out.gaps.append(item)
    return out


def record_text(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html, n_bytes, digest, refers_to) as text of whole records without their closing line ends."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace(F.regexp_replace("url", r"\r", "%0D"), r"\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit("\r\n\r\n"))
    block_bytes = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", page(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(line("WARC-Target-URI", url)),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", page(F.col("refers_to"))))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("Payload-Length", F.col("n_bytes").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block_bytes.cast("string")),
        F.lit("\r\n"),
    )
    return pages.select(F.concat(head, http, F.when(revisit, F.lit("")).otherwise(F.col("html"))).alias("value"))


def size_class(n_bytes: Column) -> Column:
    """The bits that it takes to write the size: sizes of class k are below 2**k."""
    return F.length(F.bin(n_bytes))


def class_ranges(sizes: dict[int, int]) -> list[tuple[int, int]]:
    """Classes of size that are written together: those that hold nine tenths of all pages, then by twos."""
    if not sizes:
        return [(0, 1)]
    top, seen = 0, 0
    for k in sorted(sizes):
        top, seen = k, seen + sizes[k]
        if 10 * seen >= 9 * sum(sizes.values()):
            break
    out = [(0, top)]
    while max(sizes) > top:
        low = min(k for k in sizes if k > top)
        top = low + 1
        out.append((low, top))
    return out


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Writes a record for each row into archives under path."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("long").alias("n_bytes"), F.sha2("html", 256).alias("digest"))
    groups = rows.where(f"n_bytes >= {REVISIT_BYTES}").groupBy("digest").agg(F.count(F.lit(1)).alias("_n"), F.min("page_id").alias("_first"))
    copies = groups.where("_n > 1").select(F.col("digest").alias("_digest"), "_first")
    sizes = {r.k: r.n for r in rows.groupBy(size_class(F.col("n_bytes")).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = rows.join(hinted(copies), F.col("digest") == F.col("_digest"), "left")
    rows = rows.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first")))
    for low, high in class_ranges(sizes):
        some = rows.where(size_class(F.col("n_bytes")).between(low, high))
        most = max(1, 2 * ARCHIVE_BYTES // ((1 << high) + 1000))
        record_text(some).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", most).text(f"{path}/size-{high}")


#: Payloads that are handed on together.
BATCH_BYTES, BATCH_ROWS = 8_000_000, 500


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["kind", "archive", "start", "end", "reason", "headers", "payload"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rows: list[tuple] = []
            size = 0
            for item in salvaged(content.as_buffer().to_pybytes()):
                if isinstance(item, Record):
                    rows.append(("record", path.as_py(), item.start, item.end, None, list(item.headers.items()), item.payload))
                    size += len(item.payload)
                else:
                    rows.append(("gap", path.as_py(), item[0], item[1], item[2], [], None))
                if size > BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)


def read_archives(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Rows of kind record (headers, payload) or gap (reason), with archive, start and end, of all files under path whose name fits the pattern."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(_read, "kind string, archive string, start long, end long, reason string, headers map<string,string>, payload binary")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """The page of every salvaged record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Size and SHA-256 are measured; those of a revisit, which has no payload, are what its headers say.
    """
    revisit = F.element_at("headers", "warc-type").eqNullSafe("revisit")
    h = lambda name: F.element_at("headers", name)
    page = lambda name: F.nullif(F.regexp_extract(h(name), "^<urn:page:(.*)>$", 1), F.lit("")).cast("long")
    return read_archives(spark, path).where("kind = 'record'").select(
        page("warc-record-id").alias("page_id"),
        h("warc-target-uri").alias("url"),
        F.when(revisit, h("payload-length").cast("long")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace(h("warc-payload-digest"), "^sha256:", "")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        h("warc-type").alias("record_type"),
        page("warc-refers-to").alias("refers_to"),
        "payload",
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), path)
    return page_records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
