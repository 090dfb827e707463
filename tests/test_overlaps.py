from __future__ import annotations

import random

from pyspark.sql import functions as F

from graftline.sources import overlaps as OV


def test_slices_read_their_folders_only(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randrange(5000), rng.randrange(5000), rng.randint(1, 9), i % 2 == 0) for i in range(3000)] + [(7, rng.randrange(5000), 1, True) for _ in range(900)]
    both = OV.mirrored(spark.createDataFrame(rows, "a long, b long, n int, first boolean"), {"first": ~F.col("first")})
    path = str(tmp_path / "store")
    OV.write_overlaps(both, path, slice_reads=500)
    every = [*rows, *((b, a, n, not f) for a, b, n, f in rows)]
    for low, high in ((0, 4999), (7, 7), (499, 500), (1200, 1900), (None, 30), (4990, None)):
        got = OV.overlaps_of(spark, path, low, high, slice_reads=500)
        assert sorted(map(tuple, got.collect())) == sorted(r for r in every if (low is None or r[0] >= low) and (high is None or r[0] <= high))
    part = OV.overlaps_of(spark, path, 1200, 1900, slice_reads=500)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slice" in plan and "GreaterThanOrEqual(a,1200)" in plan
    OV.write_overlaps(both.limit(0), str(tmp_path / "none"))
    assert (tmp_path / "none").exists()
