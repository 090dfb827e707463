from __future__ import annotations

import base64
import gzip
import hashlib
import time
import zlib

import pytest

from graftline.llm import warc


def record(i: int, payload: bytes, **more: str) -> bytes:
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{i}>", "WARC-Payload-Digest": "sha256:" + hashlib.sha256(payload).hexdigest(), "Content-Type": "application/http", "Content-Length": str(len(block))} | more
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def ids(found):
    return [r.headers["warc-record-id"] for r in found.records]


def test_salvages_after_damage_and_logs_gaps():
    a, b, c, d = (record(i, b"text %d " % i * 30) for i in range(4))
    broken = b[:-200] + b"X" + b[-199:]
    data = a + broken + gzip.compress(c) + b"junk" + d
    found = warc.salvage(data)
    assert ids(found) == ["<urn:page:0>", "<urn:page:2>", "<urn:page:3>"]
    assert [(x, y) for x, y, _ in found.gaps] == [(len(a), len(a) + len(broken)), (len(data) - len(d) - 4, len(data) - len(d))]
    assert found.gaps[0][2] == "payload digest doesn't match"


def test_damaged_lengths_members_and_tails():
    a, b = record(1, b"x" * 500), record(2, b"y" * 500)
    longer = a.replace(b"Content-Length: 519", b"Content-Length: 999")
    assert ids(warc.salvage(longer + b)) == ["<urn:page:2>"]
    member = bytearray(gzip.compress(a))
    member[len(member) // 2] ^= 255
    assert ids(warc.salvage(bytes(member) + gzip.compress(b))) == ["<urn:page:2>"]
    cut = warc.salvage(b + a[:-50])
    assert ids(cut) == ["<urn:page:2>"] and cut.gaps == [(len(b), len(b) + len(a) - 50, "truncated")]
    assert warc.salvage(b"") == warc.Salvaged() and warc.salvage(b"none").gaps == [(0, 4, "no version line")]
    inside = record(3, b"WARC/1.1\r\nnot a record\r\n\r\n" * 9)
    assert ids(warc.salvage(inside + b)) == ["<urn:page:3>", "<urn:page:2>"]


def test_round_trip_with_revisits(spark, tmp_path):
    big = "é<p>" * 60
    rows = [(5, "http://a/\r\nX: y", big, 1), (2, None, big, 1), (9, "u", big, 1), (2, None, big, 1), (3, "u", None, 1), (4, "u", "", 1), (6, "u", "short", 1), (7, "u", "short", 1), (8, "u", "WARC/1.1\r\n\r\n\r\n" * 20, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    warc.write_archives(pages, str(tmp_path / "w"))
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.page_records(spark, str(tmp_path / "w")).collect()}
    sha = lambda s: hashlib.sha256((s or "").encode()).hexdigest()
    want = {(i, len((h or "").encode()), sha(h), "revisit" if i in (5, 9) else "response", 2 if i in (5, 9) else None) for i, _, h, _ in rows}
    assert got == want
    payloads = {r.page_id: bytes(r.payload).decode() for r in warc.page_records(spark, str(tmp_path / "w")).where("record_type = 'response'").collect()}
    assert payloads == {i: h or "" for i, _, h, _ in rows if i not in (5, 9)}
    assert warc.read_archives(spark, str(tmp_path / "w")).where("kind = 'gap'").count() == 0


def test_empty_table(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    assert warc.page_records(spark, str(tmp_path / "e")).count() == 0


def sha1(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_digests_of_public_crawls():
    p = b"some payload" * 20
    good = [sha1(p), "sha1:" + hashlib.sha1(p).hexdigest().upper(), "md5:" + hashlib.md5(p).hexdigest(), "sha-256:" + hashlib.sha256(p).hexdigest(), "blake3:whatever"]
    data = b"".join(record(i, p, **{"WARC-Payload-Digest": d}) for i, d in enumerate(good))
    found = warc.salvage(data)
    assert len(found.records) == 5 and not found.gaps
    assert warc.salvage(record(1, p, **{"WARC-Payload-Digest": sha1(p + b"x")})).gaps[0][2] == "payload digest doesn't match"
    folded = record(1, p).replace(b"WARC-Type: response", b"WARC-Type: response\r\nX-Long: one\r\n two")
    assert warc.salvage(folded).records[0].headers["x-long"] == "one two"


def test_salvages_inside_members():
    a, b, c = (record(i, bytes([65 + i]) * 400) for i in range(3))
    broken = b.replace(b"B" * 400, b"B" * 399 + b"X")
    member = gzip.compress(a + broken + c)
    found = warc.salvage(member + record(9, b"z" * 200))
    assert ids(found) == ["<urn:page:0>", "<urn:page:2>", "<urn:page:9>"]
    assert found.gaps == [(0, len(member), f"payload digest doesn't match (inflated bytes {len(a)} to {len(a) + len(broken)})")]


@pytest.mark.parametrize("cut", [0.7, 0.9])
def test_truncated_and_damaged_members_keep_their_first_records(cut):
    noise = [hashlib.sha256(bytes([i, j])).hexdigest().encode() for i in range(3) for j in range(200)]
    a, b = record(1, b"".join(noise[:200])), record(2, b"".join(noise[200:]))
    member = gzip.compress(a + b)
    short = warc.salvage(member[: int(len(member) * cut)])
    assert ids(short) == ["<urn:page:1>"] and any("truncated" in g[2] for g in short.gaps)
    bad = bytearray(member)
    bad[int(len(bad) * cut)] ^= 255
    hurt = warc.salvage(bytes(bad) + gzip.compress(record(3, b"c" * 200)))
    assert ids(hurt) == ["<urn:page:1>", "<urn:page:3>"] and hurt.gaps
    crc = bytearray(gzip.compress(a + b))
    crc[-8] ^= 1
    assert ids(warc.salvage(bytes(crc))) == ["<urn:page:1>", "<urn:page:2>"]


@pytest.mark.parametrize("slice_bytes", [50, 1000, 1 << 24])
def test_members_of_any_size_are_searched_in_slices(monkeypatch, slice_bytes):
    """Also where a version line, headers or a record lie across slices, and with damage between them."""
    monkeypatch.setattr(warc, "SEARCHED_BYTES", slice_bytes)
    rows = [record(i, hashlib.sha256(bytes([i])).hexdigest().encode() * (1 + 40 * (i % 5 == 0))) for i in range(40)]
    rows[7] = rows[7][:60] + b"?" + rows[7][60:]
    rows[20] = rows[20][:-9]
    plain = b"".join(rows)
    found = warc.salvage(gzip.compress(plain) + gzip.compress(record(99, b"z")))
    assert ids(found) == [f"<urn:page:{i}>" for i in range(40) if i not in (7, 20)] + ["<urn:page:99>"]
    assert len(found.gaps) == 2 and all("inflated bytes" in g[2] for g in found.gaps)
    assert sum(len(r) for i, r in enumerate(rows) if i in (7, 20)) == sum(int(b) - int(a) for a, b in (g[2].split("bytes ")[1].rstrip(")").split(" to ") for g in found.gaps))


def test_lengths_and_digests_are_measured(spark, tmp_path):
    assert warc.salvage(record(1, b"12345", **{"Payload-Length": "999"})).gaps[0][2] == "payload length doesn't match"
    p = b"not a page of ours" * 9
    (tmp_path / "crawl-0001.warc").write_bytes(record(1, p, **{"WARC-Payload-Digest": sha1(p)}) + record(2, p).replace(b"WARC-Payload-Digest", b"X-Digest"))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "x.warc.gz").write_bytes(gzip.compress(record(3, p)))
    got = {(r.page_id, r.payload_bytes, r.payload_digest) for r in warc.page_records(spark, str(tmp_path)).collect()}
    assert got == {(i, len(p), hashlib.sha256(p).hexdigest()) for i in (1, 2, 3)}
    assert warc.read_archives(spark, str(tmp_path), "*.gz").count() == 1


def test_a_header_that_is_there_twice_is_two_records():
    """The rest of a record that was cut inside its headers is no part of the next one's."""
    a, b = record(1, b"a" * 200), record(2, b"b" * 200)
    found = warc.salvage(a[:120] + b)
    assert ids(found) == ["<urn:page:2>"] and found.gaps[0][:2] == (0, 120)


@pytest.mark.parametrize("line", [b"WARC/1.1\r\n", b"a: WARC/1.1\r\n", b"WARC/1.1\r\nContent-Length: 5\r\n", b"WARC/1.1\r\nA: b\r\n\r\n", b"xWARC/1.1\r\n"])
def test_time_is_linear_in_false_version_lines(line):
    took = {}
    for n in (10_000, 40_000):
        began = time.process_time()
        found = warc.salvage(line * n + b"\r\n" + record(1, b"x"))
        assert ids(found) == ["<urn:page:1>"]
        assert not warc.salvage(line * n).records
        took[n] = time.process_time() - began
    assert took[40_000] < 8 * took[10_000] + 1


def test_time_is_linear_in_members_and_false_starts():
    member = gzip.compress(record(1, zlib.compress(hashlib.shake_128(b"x").digest(8000))))
    took = {}
    for n in (1000, 4000):
        began = time.process_time()
        assert len(warc.salvage(member * n).records) == n
        took["members", n] = time.process_time() - began
    for n in (10_000, 40_000):
        began = time.process_time()
        found = warc.salvage(b"\x1f\x8b\x08abcdef" * n + record(1, b"x"))
        assert len(found.records) == 1 and len(found.gaps) == 1
        took["starts", n] = time.process_time() - began
    assert took["members", 4000] < 8 * took["members", 1000] + 1 and took["starts", 40_000] < 8 * took["starts", 10_000] + 1


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    rows = [(i, "u", str(i) + "x" * (50_000 if 40 <= i < 46 else 900)) for i in range(80)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    sizes = [p.stat().st_size for p in (tmp_path / "w").rglob("part-*")]
    assert max(sizes) < 52_000 and len(sizes) < 20
    assert warc.page_records(spark, str(tmp_path / "w")).count() == 80
    assert warc.class_ranges({}) == [(0, 1)] and warc.class_ranges({5: 90, 9: 5, 10: 3, 20: 2}) == [(0, 5), (9, 10), (20, 21)]
