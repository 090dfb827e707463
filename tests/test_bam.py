from __future__ import annotations

import gzip
import random
import struct

import pytest

from graftline.sources import bam, text

REFS = [("chr1", 100000), ("tig/2", 5000)]
#: One record, written out by hand: r1, flag 16, chr1:101, mapq 60, 3M1I2M, seq ACGTNA, tags of several kinds.
HAND = (
    struct.pack("<iiBBHHHiiii", 0, 100, 3, 60, 4681, 3, 16, 6, 1, 7, -20)
    + b"r1\0" + struct.pack("<III", 3 << 4, 1 << 4 | 1, 2 << 4) + bytes([0x12, 0x48, 0xF1]) + bytes([30, 31, 32, 33, 34, 35])
    + b"NMC\x02" + b"MDZ3A2\0" + b"XAA!" + b"XBBs" + struct.pack("<ihh", 2, -5, 7) + b"XFf" + struct.pack("<f", 0.25)
)


def rows(n: int, seed: int = 1, longest: int = 300):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.randint(1, longest)
        seq = "".join(rng.choice("ACGTN") for _ in range(size))
        qual = rng.choice(["*", "".join(chr(33 + rng.randint(0, 60)) for _ in range(size))])
        mapped = rng.random() < 0.8
        ref = rng.choice(REFS)[0] if mapped else "*"
        tags = rng.choice(["", "NM:C:3\tRG:Z:a b", "XB:B:i,-1,2\tXA:A:c", "XF:f:0.5"])
        out.append((f"read/{i}", rng.choice([0, 16, 4, 2048]), ref, rng.randint(1, 4000) if mapped else 0, rng.randint(0, 60), f"{size}M" if mapped else "*", rng.choice(["*", "chr1"]), 0, rng.randint(-500, 500), seq, qual, tags))
    return out


def test_a_record_by_hand():
    want = ("r1", 16, "chr1", 101, 60, "3M1I2M", "tig/2", 8, -20, "ACGTNA", "?@ABCD", "NM:C:2\tMD:Z:3A2\tXA:A:!\tXB:B:s,-5,7\tXF:f:0.25")
    assert bam.decoded(HAND, REFS) == want
    assert bam.encoded(want, {n: i for i, (n, _) in enumerate(REFS)}) == struct.pack("<i", len(HAND)) + HAND


@pytest.mark.parametrize(("block", "split"), [(700, 3000), (60_000, 2_000), (200, 250)])
def test_a_file_in_many_tasks_and_back(spark, tmp_path, block, split):
    data = rows(600)
    frame = spark.createDataFrame(data, bam.SCHEMA).coalesce(1)
    bam.write_bam(frame, str(tmp_path / "a"), REFS, block_bytes=block)
    (file,) = (tmp_path / "a").iterdir()
    got = bam.read_bam(spark, str(tmp_path / "a"), split)
    found = got.collect()
    assert sorted(tuple(r)[:12] for r in found) == sorted(data) and bam.unbroken(got).count() == 0
    assert got.rdd.getNumPartitions() == -(-file.stat().st_size // split)
    order = sorted(found, key=lambda r: (r.block, r.at))
    assert [tuple(r)[:12] for r in order] == data
    again = spark.createDataFrame([tuple(r)[:12] for r in order], bam.SCHEMA).coalesce(1)
    bam.write_bam(again, str(tmp_path / "b"), REFS, block_bytes=block)
    (copy,) = (tmp_path / "b").iterdir()
    assert gzip.decompress(copy.read_bytes()) == gzip.decompress(file.read_bytes())
    refs = bam.header(str(file), file.stat().st_size)
    assert refs[1] == REFS and refs[0].startswith("@HD")


def test_records_longer_than_blocks_and_splits(spark, tmp_path):
    data = rows(12, 2, 90_000)
    bam.write_bam(spark.createDataFrame(data, bam.SCHEMA).coalesce(1), str(tmp_path / "a"), REFS)
    got = bam.read_bam(spark, str(tmp_path / "a"), 10_000)
    assert sorted(tuple(r)[:12] for r in got.collect()) == sorted(data) and bam.unbroken(got).count() == 0


def test_several_files_no_rows_and_damage(spark, tmp_path):
    bam.write_bam(spark.createDataFrame(rows(40), bam.SCHEMA).repartition(3), str(tmp_path / "a"), REFS)
    assert len(list((tmp_path / "a").glob("part-*.bam"))) == 3 and not list((tmp_path / "a").glob(".*.bam"))
    assert bam.read_bam(spark, str(tmp_path / "a")).count() == 40
    bam.write_bam(spark.createDataFrame([], bam.SCHEMA).coalesce(1), str(tmp_path / "e"), REFS)
    assert bam.read_bam(spark, str(tmp_path / "e")).count() == 0
    file = next((tmp_path / "a").glob("part-*.bam"))
    file.write_bytes(file.read_bytes()[:-40])
    with pytest.raises(Exception, match="no whole block|cut|incomplete"):
        bam.read_bam(spark, str(file)).collect()
    with pytest.raises(Exception, match="not a BAM file"):
        (tmp_path / "x.bam").write_bytes(bam.compressed(b"SAM\1" + bytes(20)))
        bam.read_bam(spark, str(tmp_path / "x.bam")).collect()


def test_sam_lines_read_as_before(spark, tmp_path):
    data = rows(50, 3)
    bam.write_bam(spark.createDataFrame(data, bam.SCHEMA), str(tmp_path / "a"), REFS)
    bam.sam_lines(bam.read_bam(spark, str(tmp_path / "a"))).write.text(str(tmp_path / "s"))
    got = {tuple(r) for r in text.sam_pairs(spark, str(tmp_path / "s"), 20).collect()}
    assert got == {(r[0], r[2], r[3], r[4]) for r in data if r[2] != "*" and r[4] >= 20}
    assert any("NM:i:3" in r.value for r in spark.read.text(str(tmp_path / "s")).collect())
