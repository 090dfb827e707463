from __future__ import annotations

import random

import numpy as np

from graftline.operators import homology as HO
from graftline.operators import mapping as MP

TURN = str.maketrans("ACGT", "TGCA")


def turned(s: str) -> str:
    return s[::-1].translate(TURN)


def bases(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def mutated(rng, s, rate):
    return "".join(rng.choice("ACGT".replace(c, "")) if rng.random() < rate else c for c in s)


def test_planted_homologies_are_found_with_their_identity(spark):
    rng = random.Random(1)
    a, b = bases(rng, 9000), bases(rng, 9000)
    near, far = mutated(rng, a[2000:7000], 0.03), mutated(rng, b[1000:5000], 0.08)
    target = bases(rng, 3000) + near + bases(rng, 2500) + turned(far) + bases(rng, 1000)
    queries = spark.createDataFrame([("a", a), ("b", b), ("c", bases(rng, 6000)), ("s", a[3000:3500]), ("e", ""), ("n", None)], "query string, seq string")
    got = {r.query: r for r in HO.homology_map(queries, spark.createDataFrame([("t", target)], "target string, seq string"), length=800).collect()}
    assert set(got) == {"a", "b", "s"}
    where = {"a": (2000, 7000, "+", 3000, 8000, near, 9000), "b": (1000, 5000, "-", 10500, 14500, far, 9000), "s": (0, 500, "+", 4000, 4500, near[1000:1500], 500)}
    for name, (qs, qe, strand, ts, te, copy, size) in where.items():
        r = got[name]
        assert (r.strand, r.target, r.qlen, r.tlen) == (strand, "t", size, len(target))
        assert all(abs(x - y) < 120 for x, y in ((r.qstart, qs), (r.qend, qe), (r.tstart, ts), (r.tend, te))), r
        source = {"a": a, "b": b, "s": a[3000:3500]}[name][qs:qe]
        ops = MP.align(*(np.frombuffer(x[:700].encode(), np.uint8) for x in (source, copy)))[3]
        assert abs(r.identity - ops.count("=") / len(ops)) < 0.03


def test_two_copies_are_two_rows_and_common_kmers_go(spark):
    rng = random.Random(2)
    part = bases(rng, 4000)
    target = bases(rng, 2000) + part + bases(rng, 5000) + part + bases(rng, 2000)
    queries = spark.createDataFrame([("q", part)], "query string, seq string")
    targets = spark.createDataFrame([("t", target)], "target string, seq string")
    got = sorted((r.tstart, r.tend, r.identity, r.windows) for r in HO.homology_map(queries, targets).collect())
    assert len(got) == 2 and all(abs(x - y) < 60 for g, y0 in zip(got, (2000, 11000), strict=True) for x, y in ((g[0], y0), (g[1], y0 + 4000)))
    assert all(g[2] > 0.99 and g[3] == 4 for g in got)
    assert HO.homology_map(queries, targets, most=1).count() == 0 and HO.homology_map(queries.limit(0), targets).count() == 0
