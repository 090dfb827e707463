"""Queries over whole inputs against brute force on small tables."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

from graftline.operators import finishing as FI
from graftline.operators import layout as L
from graftline.operators import phasing as PH
from graftline.plans import registry


def placed(walks):
    """The layout of walks on the walks of three steps or more, straight from its definition."""
    size = lambda step: 100 + 10 * (len(step) - 1)
    offsets = lambda path: [sum(map(size, path[:i])) for i in range(len(path))]
    out = set()
    for read, path in walks.items():
        rlen, found = sum(map(size, path)), []
        for contig, other in walks.items():
            if len(other) < 3:
                continue
            rows = defaultdict(list)
            for step, xs in zip(path, offsets(path), strict=True):
                for place, at in zip(other, offsets(other), strict=True):
                    if step[1:] == place[1:]:
                        xe, forward = xs + size(step), step[0] == place[0]
                        cs = at - (xs if forward else rlen - xe)
                        rows[forward].append((cs, cs + rlen, xs, xe))
            for forward, parts in rows.items():
                clusters = []
                for r in sorted(parts):
                    if clusters and r[0] < clusters[-1][-1][0] + 50:
                        clusters[-1].append(r)
                    else:
                        clusters.append([r])
                for c in clusters:
                    exact = len({x for _, _, xs, xe in c for x in range(xs, xe)})
                    if max(r[3] for r in c) - min(r[2] for r in c) >= rlen * L.MIN_SPAN and exact >= rlen * L.MIN_EXACT:
                        cs, ce = c[-1][:2]
                        found.append((exact, contig, cs if forward else ce, ce if forward else cs))
        best = {f[1:] for f in found if f[0] == max(x[0] for x in found)}
        out |= {(c, read, b, e, len(best)) for c, b, e in best}
    return out


def test_layout_without_limits_takes_every_walk(spark):
    rng = random.Random(8)
    walks = {}
    for user in range(14):
        steps = []
        for i in range(rng.choice([1, 2, 3, 4, 6, 9])):
            kind, value, hour = rng.choice(["click", "purchase"]), rng.choice([10.0, 90.0]), i * 2
            steps.append(f"{'>' if value >= 50 else '<'}{kind}{hour // 6}")
        walks[f"{user}/2024-01-01"] = steps
    size = lambda path: sum(100 + 10 * (len(x) - 1) for x in path)
    names = {x[1:] for path in walks.values() for x in path}
    nodes = spark.createDataFrame([(x, size([f">{x}"])) for x in names], "node string, length long")
    contigs = spark.createDataFrame([(w, p) for w, p in walks.items() if len(p) >= 3], "contig string, path array<string>")
    reads = spark.createDataFrame([(w, size(p), 0, p, 0, size(p)) for w, p in walks.items()], "read string, rlen long, rstart long, path array<string>, pstart long, pend long")
    got = {tuple(r) for r in L.layout(reads, contigs, nodes, max_copies=None, max_matches=None).select("contig", "read", "bgn", "end", "copies").collect()}
    assert got == placed(walks) and {r for _, r, *_ in got} == set(walks)


def test_layout_without_limits(spark):
    nodes = spark.createDataFrame([("n", 100)], "node string, length long")
    contigs = spark.createDataFrame([("c", [">n"] * 1001)], "contig string, path array<string>")
    reads = spark.createDataFrame([("r", 100, 0, [">n"], 0, 100)], "read string, rlen long, rstart long, path array<string>, pstart long, pend long")
    assert L.layout(reads, contigs, nodes).count() == 0
    assert L.layout(reads, contigs, nodes, max_copies=None, max_matches=None).count() == 1001


def test_overlap_candidates_counts_minimizers_on_many_reads(spark, tmp_path):
    rng = random.Random(9)
    bases = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    common, rare = bases(60), bases(22)
    rows = [(i, bases(40) + common + bases(20)) for i in range(55)] + [(100, rare + bases(30)), (101, bases(30) + rare), (102, bases(70))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    reads = defaultdict(set)
    for r in FI.minimizers(spark.createDataFrame(rows, "read long, seq string"), 11, 8).collect():
        reads[r.kmer].add(r.read)
    assert max(map(len, reads.values())) > 50
    shared = Counter(pair for found in reads.values() for pair in itertools.combinations(sorted(found), 2))
    got = {(r.a, r.b): r.shared for r in registry.QUERIES["overlap_candidates"](spark, str(tmp_path)).collect()}
    assert got == {pair: n for pair, n in shared.items() if n >= 2} and len(got) >= 55 * 54 // 2


def test_near_path_ends_keeps_rows_that_repeat_their_key(spark, tmp_path):
    rows = [(1, 1, 10, 1, 30), (1, 1, 11, 1, 30), (1, 2, 12, 1, 30), (1, 3, 13, 1, 30), (1, 3, 14, 1, 5), (1, 3, 14, 1, 5), (2, 1, 20, 1, 9), (2, 1, 21, 1, 2), (2, 2, 22, 1, 50)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity int").write.parquet(str(tmp_path / "lineitem.parquet"))
    want = Counter()
    for path in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == path)
        for i, r in enumerate(own):
            if min(sum(x[4] for x in own[:i]), sum(x[4] for x in own[i + 1 :])) < 10:
                want[path, r[2]] += 1
    got = {(r.path, r.node): r.n for r in registry.QUERIES["near_path_ends_all_rows"](spark, str(tmp_path)).collect()}
    assert got == want == {(1, 10): 1, (1, 14): 2, (2, 20): 1, (2, 21): 1, (2, 22): 1}


def test_phased_components_tries_all_starts(spark, tmp_path, monkeypatch):
    tried = []
    bisections = PH.phased
    monkeypatch.setattr(PH, "phased", lambda nodes, links, seeds=100: tried.append(seeds) or bisections(nodes, links, seeds))
    rows = [(i % 9, i % 7, 50.0, 0.1) for i in range(60)]
    spark.createDataFrame(rows, "l_partkey long, l_suppkey long, l_quantity double, l_discount double").write.parquet(str(tmp_path / "lineitem.parquet"))
    sides = registry.QUERIES["phased_components"](spark, str(tmp_path))
    assert tried == [100] and sides.count() == 16
