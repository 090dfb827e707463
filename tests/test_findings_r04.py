from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from graftline.operators import building as BD
from graftline.operators import finishing as FI
from graftline.operators import graph as G
from graftline.operators import phasing as PH
from graftline.plans import registry

TURN = str.maketrans("ACGT", "TGCA")


def bases(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def documents(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(path / "documents.parquet"))


def test_whole_matches_of_items_that_stand_in_many_documents(spark, tmp_path):
    """Each k-mer of the item stands at more places than mapping takes seeds from."""
    rng = random.Random(1)
    item, rare = bases(rng, 45), bases(rng, 50)
    rows = [(i, bases(rng, 7) + item + bases(rng, 5)) for i in range(1005)] + [(2000, item[:30]), (2001, "A" * 12 + item[::-1].translate(TURN) + item + item), (2002, rare[::-1].translate(TURN)), (2003, None)]
    documents(spark, tmp_path, rows)
    spark.createDataFrame([(1, item), (2, rare), (3, item[:39]), (4, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {tuple(r[c] for c in ("read", "target", "strand", "first_start", "qlen")) for r in registry.QUERIES["mapped_benchmark_whole"](spark, str(tmp_path)).collect()}
    assert got == {(1, i, "+", 7, 45) for i in range(1005)} | {(1, 2001, "+", 57, 45), (1, 2001, "-", 12, 45), (2, 2002, "-", 0, 50)}


def test_samples_by_digest_are_those_by_expression(spark):
    """In arrays of many sequences: the same samples as from the expression, one row a read or one row a sample."""
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("ACGT"[: rng.choice((2, 4))]) * rng.choice((1, 1, 2)) for _ in range(rng.choice((0, 5, 30, 200))))) for i in range(60)] + [(60, None)]
    reads = spark.createDataFrame(rows, "read long, seq string")
    want = {tuple(r) for r in BD.samples(reads, 7, 4, order=F.md5).collect()}
    assert {tuple(r) for r in BD.samples(reads, 7, 4, digest=hashlib.md5).collect()} == want
    assert {(r.read, p, s) for r in BD.walked(reads, 7, 4, digest=hashlib.md5).collect() for p, s in zip(r.pos, r.step, strict=True)} == want


def test_sparse_nodes_write_no_table_and_arcs_no_walks(spark, tmp_path, monkeypatch):
    """Nodes and arcs are one pass each over the documents; nothing of the rest of the graph is made for them."""
    rng = random.Random(3)
    documents(spark, tmp_path, [(i, bases(rng, 80)) for i in range(30)])
    made = []
    for name in ("saved", "written"):
        monkeypatch.setattr(BD, name, lambda df: made.append(df) or df)
    assert registry.QUERIES["sparse_graph_nodes"](spark, str(tmp_path)).count() > 0
    assert registry.QUERIES["sparse_graph_arcs"](spark, str(tmp_path)).count() > 0
    assert not made


def test_walks_are_cut_where_an_arc_lost_and_spelled_in_linear_time(spark):
    """A long read of two letters and a period has pairs with several overlaps; what its walks spell is the read, whatever their length."""
    rng = random.Random(4)
    text = "".join(rng.choice(("AC", "AG", "TC")) for _ in range(20000)) + "AC" * 300 + "AGAC" * 200
    reads = spark.createDataFrame([(1, text), (2, text[500:900]), (3, text[::-1])], "read long, seq string")
    nodes, arcs, walks = BD.sparse_graph(reads, 11, 8, digest=hashlib.md5)
    known = {(r.u, r.v): r.overlap for r in BD.both_ways(arcs).collect()}
    rows = walks.withColumn("spelled", BD.spelled(F.col("path"), F.col("overlaps"))).collect()
    whole = {1: text, 2: text[500:900], 3: text[::-1]}
    for r in rows:
        assert r.spelled == "".join(c for i, c in enumerate(whole[r.read]) if not i or whole[r.read][i - 1] != c)[r.start : r.end]
        assert all(known[a, b] == o for a, b, o in zip(r.path, r.path[1:], r.overlaps, strict=False))
    steps = BD.walked(reads, 11, 8, digest=hashlib.md5).collect()
    cut = {r.read: 1 + sum(known[a, b] != 11 - (q - p) for a, b, p, q in zip(r.step, r.step[1:], r.pos, r.pos[1:], strict=False)) for r in steps}
    assert {i: sorted(r.part for r in rows if r.read == i) for i in cut} == {i: list(range(1, n + 1)) for i, n in cut.items()} and max(cut.values()) > 1


def test_only_ends_of_simple_arcs_are_followed(spark):
    """Of a graph with branches the runs are the same whether all arcs or only the simple ones are told."""
    rng = random.Random(5)
    nodes = [f"n{i:02}" for i in range(40)]
    found = {(rng.choice("<>") + rng.choice(nodes), rng.choice("<>") + rng.choice(nodes)) for _ in range(30)}
    turn = lambda x: ("<" if x[0] == ">" else ">") + x[1:]
    both = sorted(found | {(turn(v), turn(u)) for u, v in found})
    graph, names = spark.createDataFrame([(u, v, 3) for u, v in both], "u string, v string, overlap int"), spark.createDataFrame([(n,) for n in nodes], "node string")
    out, into = Counter(u for u, _ in both), Counter(v for _, v in both)
    simple = {(u, v) for u, v in both if out[u] == into[v] == 1 and u[1:] != v[1:]}
    assert {(r.u, r.v) for r in G.simple_arcs(graph).collect()} == simple
    runs = {tuple(r) for r in G.unitigs(names, graph).collect()}
    assert runs == {tuple(r) for r in G.unitigs(names, G.simple_arcs(graph), simple=True).collect()}
    assert sorted(s[1:] for _, _, s in runs) == nodes


def test_seeds_that_begin_alike_are_tried_once_and_groups_are_components(spark, monkeypatch):
    """The best of all seeds as each seed's own bisection has it, with few bisections; also where seeds are dealt out to several rows."""
    rng = random.Random(6)
    rows, links = [], []
    for c, n in enumerate((1, 2, 3, 7, 12)):
        names = [f"c{c}n{i:02}" for i in range(n)]
        rows += [(f"c{c}", x) for x in names]
        links += [(a, b, float(rng.randrange(-3, 6))) for i, a in enumerate(names) for b in names[i + 1 :] if rng.random() < 0.6]
    want = set()
    for c in range(5):
        names = sorted(x for y, x in rows if y == f"c{c}")
        weight = {(a, b): w for a, b, w in links if a in names}
        score, seed, side = min(((-s, i, d) for i in range(30) for s, d in [PH.bisect(names, weight, i)]), key=lambda x: x[:2])
        assert PH.best_of_seeds(names, weight, range(30)) == (-score, seed, side)
        want |= {(f"c{c}", n, side[n] ^ side[names[0]]) for n in names}
    nodes, edges = spark.createDataFrame(rows, "component string, node string"), spark.createDataFrame(links, "a string, b string, w double")
    for size in (20_000, 40):
        monkeypatch.setattr(PH, "TASK_SIZE", size)
        assert {tuple(r) for r in PH.phased(nodes, edges, 30).collect()} == want
    tried = []
    split = PH._split
    monkeypatch.setattr(PH, "_split", lambda *a: tried.append(a) or split(*a))
    PH.best_of_seeds(["a", "b"], {("a", "b"): 1.0}, range(100))
    assert len(tried) <= 4


def test_minimizers_have_the_hash_of_spark_and_pairs_move_as_lists(spark):
    """The same minimizers as the expression has for every k, and the same pairs as a join of them, where reads lie in several batches, too."""
    rng = random.Random(7)
    common = bases(rng, 70)
    rows = [(f"r{i}", bases(rng, rng.choice((3, 30, 90))) + common[: rng.randrange(70)]) for i in range(60)] + [("two", "AC" * 40), ("null", None), ("empty", "")]
    reads = spark.createDataFrame(rows, "read string, seq string")
    for k in (1, 4, 7, 8, 11, 15, 31, 32, 45):
        texts = spark.createDataFrame([(bases(rng, k),) for _ in range(20)], "t string").select("t", F.xxhash64("t").alias("h")).collect()
        assert FI.xxhash64(np.array([list(r.t.encode()) for r in texts], np.uint8)).tolist() == [r.h for r in texts]
    turned = lambda x: x[::-1].translate(TURN)
    for k, w in ((11, 8), (5, 1)):
        texts = sorted({min(s[i : i + k], turned(s[i : i + k])) for _, s in rows if s for i in range(len(s) - k + 1)})
        value = {r.t: r.h for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
        want = set()
        for name, s in rows:
            kmers = [min(s[i : i + k], turned(s[i : i + k])) for i in range(len(s or "") - k + 1)]
            want |= {(name, j, kmers[j]) for i in range(len(kmers) - w + 1) for j in [min(range(i, i + w), key=lambda j: (value[kmers[j]], j))]}
        assert {tuple(r) for r in FI.minimizers(reads, k, w).collect()} == want
    lists = {}
    for r in FI.minimizers(reads, 11, 8).collect():
        lists.setdefault(r.kmer, set()).add(r.read)
    shared = Counter((a, b) for names in lists.values() if len(names) <= 40 for a in names for b in names if a < b)
    found = FI.overlap_candidates(FI.minimizers(reads, 11, 8), most=40)
    assert {(r.a, r.b): r.shared for r in found.collect()} == {p: n for p, n in shared.items() if n >= 2}
    batch = lambda a, b: pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    parts = [batch([1, 1], [[2, 3], [3]]), batch([1], [[2, 3, 4]]), batch([2, 3], [[3], [4, 5]]), batch([3], [[5]])]
    assert [tuple(r.values()) for x in FI._shared(iter(parts), 2) for r in x.to_pylist()] == [(1, 2, 2), (1, 3, 3), (3, 5, 2)]


def test_pairs_of_overlaps_are_no_rows_before_they_are_counted(spark):
    """No join of minimizers with themselves stands in the plan: as rows, pairs of reads of each minimizer would go through a join and a second shuffle."""
    reads = spark.createDataFrame([(1, "ACGT" * 9)], "read long, seq string")
    plan = FI.overlap_candidates(FI.minimizers(reads, 11, 8))._jdf.queryExecution().toString()
    assert "Join" not in plan
