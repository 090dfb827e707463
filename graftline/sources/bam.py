"""BAM files as tables: a data source that splits compressed files at their blocks, and a sink of such files.

A BAM file is a chain of small gzip members (blocks) over a stream of records, and neither is marked where it begins. A task
takes a range of compressed bytes. It finds the first block whose header leads to another block's, and, in the blocks from there, the first
place from which `CHAINED` records in a row (or all up to the end) are well formed. It reads the records that begin in blocks of
its range, the last one to its end beyond it. Every row says between which places (block and place in it) it lies, and `unbroken` holds
the tasks of a file against each other: each record has to begin where the one before it ends.

The sink writes one file for each task, all with the same header, under a hidden name that the driver's commit changes; what a
failed or repeated attempt leaves stays hidden and is not read. Files are read and written through pyarrow's file systems, so paths of any store that these know will do.

Rows have the columns of a SAM line: qname, flag, rname, pos (from 1, 0: none), mapq, cigar, rnext (as a name, never =), pnext, tlen, seq, qual, tags.
`*` stands for what is not there. An empty file has no rows; a damaged block is an error that names the file and the place.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags string"
PLACES = "file string, block long, at int, next_block long, next_at int"
#: Compressed bytes for one task, uncompressed bytes in a block, records that have to be well formed for a start, rows in a batch.
SPLIT_BYTES, BLOCK_BYTES, CHAINED, BATCH_ROWS = 16_000_000, 0xFF00, 5, 5000
#: A longer record is none.
RECORD_BYTES = 1 << 29
EOF_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BASES, OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
_CIGAR = re.compile(r"(\d+)([MIDNSHP=X])")
_NUMBERS = {"c": "b", "C": "B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}


def opened(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def files_of(path: str) -> list[tuple[str, int]]:
    """The BAM files of a path, a file or a folder, with their sizes."""
    system, at = opened(path)
    info = system.get_file_info(at)
    found = [info] if info.type == fs.FileType.File else [x for x in system.get_file_info(fs.FileSelector(at, recursive=True)) if x.type == fs.FileType.File and x.base_name.endswith(".bam") and x.base_name[0] not in "._"]
    prefix = path[: len(path) - len(at)] if "://" in path and path.endswith(at) else ""
    return sorted((prefix + x.path, x.size) for x in found)


def block_size(head: bytes) -> int:
    """The size of the block that begins with these bytes, 0 if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return 0
    end, at = 12 + int.from_bytes(head[10:12], "little"), 12
    while at + 4 <= min(end, len(head)):
        size = int.from_bytes(head[at + 2 : at + 4], "little")
        if head[at : at + 2] == b"BC" and size == 2 and at + 6 <= len(head):
            return int.from_bytes(head[at + 4 : at + 6], "little") + 1
        at += 4 + size
    return 0


class Blocks:
    """The blocks of a file from a place on."""

    def __init__(self, path: str, size: int):
        system, at = opened(path)
        self.path, self.size, self.file = path, size, system.open_input_file(at)

    def first(self, start: int, stop: int) -> int:
        """The first block that begins from start on; stop if none does before it."""
        if not start:
            return 0
        data = self.file.read_at(min(stop - start + (1 << 17), self.size - start), start)
        at = data.find(b"\x1f\x8b\x08\x04")
        while 0 <= at < stop - start:
            size = block_size(data[at : at + 64])
            if size and (start + at + size == self.size or block_size(data[at + size : at + size + 64])):
                return start + at
            at = data.find(b"\x1f\x8b\x08\x04", at + 1)
        return stop

    def read(self, at: int) -> tuple[bytes, int]:
        """What the block at this place holds, and the next block's place."""
        size = block_size(self.file.read_at(min(64, self.size - at), at))
        if not size or at + size > self.size:
            raise ValueError(f"{self.path}: no whole block at byte {at}")
        raw = self.file.read_at(size, at)
        data = zlib.decompress(raw, 31)
        return data, at + size


class Stream:
    """The uncompressed bytes from a block on; knows for each byte its block and place in it."""

    def __init__(self, blocks: Blocks, at: int, within: int = 0):
        self.blocks, self.next, self.data, self.place = blocks, at, bytearray(), within
        #: (first byte in data, block) of the blocks in data.
        self.marks: list[tuple[int, int]] = []

    def fill(self, upto: int) -> bool:
        """Whether there are so many bytes behind the place."""
        while len(self.data) < self.place + upto and self.next < self.blocks.size:
            data, after = self.blocks.read(self.next)
            self.marks.append((len(self.data), self.next))
            self.data += data
            self.next = after
        return len(self.data) >= self.place + upto

    def where(self) -> tuple[int, int]:
        """Block and place in it; the end of a block is the start of the next."""
        while self.marks and len(self.marks) > 1 and self.marks[1][0] <= self.place:
            self.marks.pop(0)
        if not self.marks or self.place >= len(self.data):
            return self.next, 0
        return self.marks[0][1], self.place - self.marks[0][0]

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError(f"{self.blocks.path}: the last record is cut")
        out = bytes(self.data[self.place : self.place + n])
        self.place += n
        if self.place > 1 << 22:  # what is behind is not needed any more
            block = self.where()
            drop = self.place
            del self.data[:drop]
            self.marks = [(a - drop, b) for a, b in self.marks if b >= block[0]]
            self.place = 0
        return out


def well_formed(data: bytes | bytearray, at: int, refs: int) -> int:
    """The size of the record at this place, its length field included, if its numbers fit together; 0 if not; -1 if that can't be told yet."""
    if at + 36 > len(data):
        return -1
    size, ref, pos, name, _, _, ops, flag, bases, next_ref, next_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if not (32 <= size <= RECORD_BYTES and -1 <= ref < refs and -1 <= next_ref < refs and pos >= -1 and next_pos >= -1 and name >= 1 and bases >= 0 and flag < 1 << 12):
        return 0
    if 32 + name + 4 * ops + (bases + 1) // 2 + bases > size:
        return 0
    if at + 36 + name > len(data):
        return -1
    text = data[at + 36 : at + 35 + name]
    if data[at + 35 + name] or any(c < 33 or c > 126 for c in text):
        return 0
    return size + 4


def first_record(stream: Stream, refs: int) -> bool:
    """Moves the stream to the first place from which records are well formed; whether there is one."""
    while True:
        at, seen = stream.place, 0
        while seen < CHAINED:
            size = well_formed(stream.data, at, refs)
            if size < 0 or size and at + size > len(stream.data):
                if stream.fill(len(stream.data) - stream.place + 1):
                    continue
                size = 1 if at == len(stream.data) and seen else 0  # the records end with the file
                seen = CHAINED if size else seen
            if not size:
                break
            at, seen = at + size, seen + 1
        if seen >= CHAINED:
            return True
        stream.place += 1
        if not stream.fill(1):
            return False


def header(path: str, size: int) -> tuple[str, list[tuple[str, int]], tuple[int, int]]:
    """The header's text, the references with their lengths, and where the first record begins."""
    stream = Stream(Blocks(path, size), 0)
    if stream.take(4) != b"BAM\1":
        raise ValueError(f"{path}: not a BAM file")
    text = stream.take(*struct.unpack("<i", stream.take(4))).rstrip(b"\0").decode()
    refs = []
    for _ in range(*struct.unpack("<i", stream.take(4))):
        name = stream.take(*struct.unpack("<i", stream.take(4)))[:-1].decode()
        refs.append((name, *struct.unpack("<i", stream.take(4))))
    stream.fill(1)
    return text, refs, stream.where()


def tag_text(raw: bytes) -> str:
    """Tags as in SAM, by tabs."""
    out, at = [], 0
    while at < len(raw):
        name, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind == "A":
            out.append(f"{name}:A:{chr(raw[at])}")
            at += 1
        elif kind in "ZH":
            end = raw.index(0, at)
            out.append(f"{name}:{kind}:{raw[at:end].decode('utf-8', 'replace')}")
            at = end + 1
        elif kind == "B":
            sub, n = chr(raw[at]), int.from_bytes(raw[at + 1 : at + 5], "little")
            one = struct.Struct(_NUMBERS[sub])
            values = [one.unpack_from(raw, at + 5 + i * one.size)[0] for i in range(n)]
            out.append(f"{name}:B:{','.join([sub, *map(_number, values)])}")
            at += 5 + n * one.size
        else:
            one = struct.Struct(_NUMBERS[kind])
            # the kind of number is kept, so that a file can be written as it was read
            out.append(f"{name}:{kind}:{_number(one.unpack_from(raw, at)[0])}")
            at += one.size
    return "\t".join(out)


def _number(x: float) -> str:
    return f"{x:.9g}" if isinstance(x, float) else str(x)


def tag_bytes(text: str) -> bytes:
    out = []
    for field in text.split("\t") if text else ():
        name, kind, value = field.split(":", 2)
        out.append(name.encode() + kind.encode())
        if kind == "A":
            out.append(value.encode())
        elif kind in "ZH":
            out.append(value.encode() + b"\0")
        elif kind == "B":
            sub, *values = value.split(",")
            out.append(sub.encode() + struct.pack("<i", len(values)) + b"".join(struct.pack(_NUMBERS[sub], (float if sub == "f" else int)(v)) for v in values))
        else:
            out.append(struct.pack(_NUMBERS[kind], (float if kind == "f" else int)(value)))
    return b"".join(out)


_PAIRS = [BASES[i >> 4] + BASES[i & 15] for i in range(256)]
_CODE = {c: i for i, c in enumerate(BASES)}


def decoded(raw: bytes, refs: list[tuple[str, int]]) -> tuple:
    ref, pos, name, mapq, _, ops, flag, bases, next_ref, next_pos, tlen = struct.unpack_from("<iiBBHHHiiii", raw)
    at = 32 + name
    cigar = "".join(f"{x >> 4}{OPS[x & 15]}" for x in struct.unpack_from(f"<{ops}I", raw, at)) or "*"
    at += 4 * ops
    packed = raw[at : at + (bases + 1) // 2]
    at += len(packed)
    seq = "".join(map(_PAIRS.__getitem__, packed))[:bases] or "*"
    quality = raw[at : at + bases]
    qual = "*" if not bases or quality[0] == 255 else bytes(q + 33 for q in quality).decode("latin-1")
    of = lambda i: refs[i][0] if i >= 0 else "*"
    return raw[32 : 31 + name].decode(), flag, of(ref), pos + 1, mapq, cigar, of(next_ref), next_pos + 1, tlen, seq, qual, tag_text(raw[at + bases :])


def _bin(begin: int, end: int) -> int:
    """The smallest bin of the index's five levels that holds the interval."""
    for level, shift in enumerate((14, 17, 20, 23, 26)):
        if begin >> shift == (end - 1) >> shift:
            return ((1 << (15 - 3 * level)) - 1) // 7 + (begin >> shift)
    return 0


def encoded(row: tuple, index: dict[str, int]) -> bytes:
    qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, tags = row
    ops = _CIGAR.findall(cigar)
    span = sum(int(n) for n, o in ops if o in "MDN=X") or 1
    seq = "" if seq == "*" else seq
    codes = [_CODE.get(c, 15) for c in seq.upper()] + [0] * (len(seq) % 2)
    quality = bytes([255]) * len(seq) if qual == "*" else bytes(ord(c) - 33 for c in qual)
    own = index.get(rname, -1)
    head = struct.pack(
        "<iiBBHHHiiii", own, pos - 1, len(qname) + 1, mapq, _bin(pos - 1, pos - 1 + span) if pos > 0 else 4680, len(ops), flag, len(seq), own if rnext == "=" else index.get(rnext, -1), pnext - 1, tlen
    )
    body = head + qname.encode() + b"\0" + b"".join(struct.pack("<I", int(n) << 4 | OPS.index(o)) for n, o in ops) + bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True)) + quality + tag_bytes(tags or "")
    return struct.pack("<i", len(body)) + body


@dataclass
class Range(InputPartition):
    path: str
    size: int
    start: int
    stop: int
    refs: list[tuple[str, int]]
    first: tuple[int, int]


class BamReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[Range]:
        out = []
        for path, size in files_of(self.path):
            _, refs, first = header(path, size)
            out += [Range(path, size, at, min(size, at + self.split), refs, first) for at in range(0, size, self.split)]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(part.path, part.size)
        if part.first[0] >= part.stop:
            return
        if part.first[0] >= part.start:
            stream = Stream(blocks, part.first[0], part.first[1])
        else:
            begin = blocks.first(part.start, part.stop)
            if begin >= part.stop:
                return
            stream = Stream(blocks, begin)
            if not stream.fill(1) or not first_record(stream, len(part.refs)):
                return
        rows = []
        while stream.fill(4):
            block, at = stream.where()
            if block >= part.stop:
                break
            raw = stream.take(*struct.unpack("<i", stream.take(4)))
            rows.append((*decoded(raw, part.refs), part.path, block, at, *stream.where()))
            if len(rows) >= BATCH_ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


_NAMES = [f.split(" ")[0] for f in f"{SCHEMA}, {PLACES}".split(", ")]
_KINDS = [{"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[f.split(" ")[1]] for f in f"{SCHEMA}, {PLACES}".split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=_NAMES)


@dataclass
class Written(WriterCommitMessage):
    hidden: str
    final: str


class BamWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.header = options["path"], options.get("header", "")
        self.refs = [(n, int(x)) for n, x in (line.split("\t") for line in options.get("refs", "").split("\n") if line)]
        self.block = int(options.get("blockbytes", BLOCK_BYTES))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, at = opened(self.path)
        system.create_dir(at)
        name = uuid.uuid4().hex
        hidden, final = f"{at}/.{name}.bam", f"{at}/part-{name}.bam"
        index = {n: i for i, (n, _) in enumerate(self.refs)}
        text = self.header.encode()
        out = bytearray(b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.refs)))
        for n, x in self.refs:
            out += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", x)
        names = _NAMES[:12]
        with system.open_output_stream(hidden, compression=None) as f:
            for batch in batches:
                for row in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
                    out += encoded(row, index)
                    while len(out) >= self.block:
                        f.write(compressed(bytes(out[: self.block])))
                        del out[: self.block]
            if out:
                f.write(compressed(bytes(out)))
            f.write(EOF_BLOCK)
        return Written(hidden, final)

    def commit(self, messages: list[Written]) -> None:
        system, _ = opened(self.path)
        for m in messages:
            if m is not None:
                system.move(m.hidden, m.final)

    def abort(self, messages: list[Written]) -> None:
        system, _ = opened(self.path)
        for m in messages:
            if m is not None and system.get_file_info(m.hidden).type == fs.FileType.File:
                system.delete_file(m.hidden)


def compressed(data: bytes) -> bytes:
    """One block."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class Bam(DataSource):
    """Format `bam`. Reading: path, splitBytes. Writing: path, header (its text), refs (name, tab, length; by lines), blockBytes."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return f"{SCHEMA}, {PLACES}"

    def reader(self, schema) -> BamReader:
        return BamReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> BamWriter:
        return BamWriter(dict(self.options))


def read_bam(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of a BAM file or of all in a folder, with their places."""
    spark.dataSource.register(Bam)
    return spark.read.format("bam").option("splitBytes", str(split_bytes)).load(path)


def write_bam(rows: DataFrame, path: str, refs: list[tuple[str, int]], text: str | None = None, block_bytes: int = BLOCK_BYTES) -> None:
    """Writes rows of the columns of a SAM line, a file for each task, with these references (a header's size, so given here)."""
    rows.sparkSession.dataSource.register(Bam)
    text = "".join(["@HD\tVN:1.6\n", *(f"@SQ\tSN:{n}\tLN:{x}\n" for n, x in refs)]) if text is None else text
    out = rows.select(*_NAMES[:12]).write.format("bam").mode("append")
    out.option("header", text).option("refs", "\n".join(f"{n}\t{x}" for n, x in refs)).option("blockBytes", str(block_bytes)).save(path)


def unbroken(rows: DataFrame) -> DataFrame:
    """(file, block, at) of records of read_bam that don't begin where the one before them in their file ends: none, if all tasks agree."""
    by = Window.partitionBy("file").orderBy("block", "at")
    before = F.lag(F.struct(F.col("next_block").alias("block"), F.col("next_at").alias("at"))).over(by)
    marked = rows.select("file", "block", "at", "next_block", "next_at").withColumn("_before", before)
    return marked.where(F.col("_before").isNotNull() & ((F.col("_before.block") != F.col("block")) | (F.col("_before.at") != F.col("at")))).select("file", "block", "at")


def sam_lines(rows: DataFrame) -> DataFrame:
    """(value): the records as lines of SAM."""
    kept = [F.col(n).cast("string") for n in _NAMES[:11]]
    return rows.select(F.concat_ws("\t", *kept, F.when(F.col("tags") != "", F.regexp_replace("tags", r"(^|\t)(..):[cCsSI]:", "$1$2:i:"))).alias("value"))
