from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from graftline.operators import bridges as BR
from graftline.operators import bubbles as BU
from graftline.operators import coverage as C
from graftline.operators import gaps as GA
from graftline.operators import graph as G
from graftline.operators import unique as U


def links(spark, *edges, overlap=0):
    rows = [(a[1:], a[0] == ">", b[1:], b[0] == ">", overlap) for a, b in edges]
    return G.arcs(spark.createDataFrame(rows, "src string, src_fw boolean, dst string, dst_fw boolean, overlap int"))


def nodes(spark, **length):
    return spark.createDataFrame([(k, v) for k, v in length.items()], "node string, length long")


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def test_arcs_are_closed_under_mirrors(spark):
    g = links(spark, (">a", "<b"), (">b", ">b"), overlap=3)
    assert pairs(g) == [("<b", "<b", 3), (">a", "<b", 3), (">b", "<a", 3), (">b", ">b", 3)]
    n = nodes(spark, a=1, b=1, c=1)
    assert pairs(G.tips(n, g)) == [("<a",), ("<c",), (">c",)]
    assert dict(pairs(G.degrees(n, g)))[">b"] == 2
    assert pairs(G.graph_components(n, g)) == [("a", "a"), ("b", "a"), ("c", "c")]


def test_tangles_keep_the_ends_of_unique_nodes_apart(spark):
    n = nodes(spark, u=9, x=1, w=9)
    g = links(spark, (">u", ">x"), (">x", ">w"))
    t = dict(pairs(G.tangles(n, g, spark.createDataFrame([("u",), ("w",)], "node string"))))
    assert t[">u"] == t["<x"] == t[">x"] == t["<w"] and len({t["<u"], t[">u"], t[">w"]}) == 3


def test_untip(spark):
    n = nodes(spark, a=50_000, b=50_000, t=2_000, u=30_000)
    g = links(spark, (">a", ">b"), (">a", ">t"), (">a", ">u"))
    assert pairs(G.untipped(n, g, 15_000, 5_000, 0.1), "node") == [("a",), ("b",), ("u",)]
    d = dict(pairs(G.depths(nodes(spark, p=1, q=2, r=4), links(spark, (">p", ">q"), (">q", ">r"), (">r", ">q")))))
    assert d[">p"] == float("inf") and d["<p"] == 0
    d = dict(pairs(G.depths(nodes(spark, p=1, q=2, r=4), links(spark, (">p", ">q"), (">q", ">r")))))
    assert (d[">p"], d[">q"], d[">r"], d["<r"]) == (6, 4, 0, 3)


def test_depths_equal_brute_force(spark):
    """Random graphs with cycles, parallel ways and overlaps, and bubbles in a row."""
    for seed in range(4):
        rng = random.Random(seed)
        names = [f"n{i}" for i in range(14)]
        length = {x: rng.randint(1, 9) for x in names}
        pairs_ = {(f"{rng.choice('><')}{rng.choice(names)}", f"{rng.choice('><')}{rng.choice(names)}") for _ in range(9 + 2 * seed)}
        graph = links(spark, *sorted(pairs_))
        follow = {}
        for u, v in pairs(graph, "u", "v"):
            follow.setdefault(u, []).append(v)

        def deep(x, above, follow=follow, length=length):
            if x in above:
                return float("inf")
            return max((deep(v, {*above, x}) + length[v[1:]] for v in follow.get(x, ())), default=0.0)

        got = dict(pairs(G.depths(nodes(spark, **length), graph), "end", "depth"))
        assert got == {o + x: deep(o + x, set()) for x in names for o in "><"}


def test_depths_of_long_chains_take_few_rounds(spark, monkeypatch):
    n, times = 2000, []
    monkeypatch.setattr(G, "saved", lambda df, keep=G.saved: times.append(1) or keep(df))
    rows = [(f">c{i}", f">c{i + 1}", 0) for i in range(n)] + [(f">c{i}", f">d{i}", 0) for i in range(0, n, 7)] + [(f">d{i}", f">c{i + 1}", 0) for i in range(0, n, 7)]
    graph = spark.createDataFrame(rows, "u string, v string, overlap int")
    sizes = spark.createDataFrame([(f"c{i}", 2) for i in range(n + 1)] + [(f"d{i}", 3) for i in range(0, n, 7)], "node string, length long")
    got = dict(pairs(G.depths(sizes, graph), "end", "depth"))
    assert got[">c0"] == 2 * n + 3 * len(range(0, n, 7)) and got[f">c{n}"] == 0 and got["<c5"] == 0 and len(times) < 60


def test_unitigs_of_chains_branches_and_cycles(spark):
    n = nodes(spark, **{k: 1 for k in "abcdexyz"}, lone=1)
    g = links(spark, (">a", ">b"), (">b", "<c"), ("<c", ">d"), ("<c", ">e"), (">x", ">y"), (">y", ">z"), (">z", ">x"))
    found = {}
    for unitig, pos, step in pairs(G.unitigs(n, g), "unitig", "pos", "step"):
        found.setdefault(unitig, []).append(step)
    flip = lambda p: tuple(("<" if s[0] == ">" else ">") + s[1:] for s in reversed(p))
    runs = {min(tuple(p), flip(p)) for p in found.values()}
    assert {min(p, flip(p)) for p in [(">a", ">b", "<c"), (">d",), (">e",), (">lone",)]} <= runs
    cycle = [p for p in runs if len(p) == 3 and "x" in "".join(p)]
    assert len(cycle) == 1 and len(runs) == 5 and sum(map(len, runs)) == 9


def test_spelled_paths_and_lineage(spark):
    seqs = spark.createDataFrame([("a", "ACGT"), ("b", "GTTT")], "node string, seq string")
    steps = spark.createDataFrame([("p", 0, ">a", None), ("p", 1, ">b", 2), ("q", 0, "<b", None), ("q", 1, "<a", 2)], "path string, pos int, step string, overlap int")
    assert pairs(G.spell(steps, seqs)) == [("p", "ACGTTT"), ("q", "AAACGT")]
    mapping = spark.createDataFrame([("u4", [">u3", "<x"]), ("u3", [">r1", "<r2"])], "name string, path array<string>")
    assert pairs(G.lineage_leaves(mapping, spark.createDataFrame([("u4",)], "name string"))) == [("u4", 0, ">r1"), ("u4", 1, "<r2"), ("u4", 2, "<x")]


def test_distances_and_coloring(spark):
    n = nodes(spark, a=10, b=20, c=30)
    g = links(spark, (">a", ">b"), (">b", ">c"), (">a", ">c"))
    start = spark.createDataFrame([(">a",)], "end string")
    assert pairs(G.bounded_distances(g, n, start, 100)) == [(">a", ">a", 0), (">a", ">b", 0), (">a", ">c", 0)]
    assert pairs(G.bounded_distances(links(spark, (">a", ">b"), (">b", ">c")), n, start, 100))[2] == (">a", ">c", 20)
    sides = {r[0]: r[1:] for r in pairs(G.two_coloring(spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "z"), ("x", "z")], "a string, b string")))}
    assert sides["a"] == sides["c"] == (0, False) and sides["b"] == (1, False) and sides["x"][1] and sides["z"][1]


BUBBLE = [(">s", ">a"), (">s", ">b"), (">a", ">t"), (">b", ">t")]


def test_bubbles(spark):
    n = spark.createDataFrame([("s", 1000, 20.0), ("a", 500, 18.0), ("b", 500, 2.0), ("t", 1000, 20.0)], "node string, length long, coverage double")
    g = links(spark, *BUBBLE)
    assert pairs(BU.superbubbles(n, g)) == [("<t", "<s"), (">s", ">t")]
    assert pairs(BU.popped(n, g, 20.0)) == [("node", "b", None)]
    comp = BU.Component([(">a", ">b")])
    assert comp.superbubble(">a") is None and comp.superbubble(">a", chain_steps=True) == ">b"
    assert BU.Component([*BUBBLE, (">t", ">s")]).superbubble(">s") is None
    assert BU.Component([*BUBBLE, (">a", ">x")]).superbubble(">s") is None


def test_tips_are_popped_but_one_branch_stays(spark):
    g = BU.Component([(">s", ">a"), (">s", ">b"), (">p", ">s")], {"a": 10, "b": 20}, {"a": 1.0, "b": 9.0, "s": 9.0})
    assert BU.pop_tips(g, ">s", 5.0, 100) == {"a"} and g.followers(">s") == [">b"]


def test_simple_loop_is_written_out(spark):
    n = spark.createDataFrame([("p", 9000, 10.0), ("r", 900, 20.0), ("l", 900, 10.0), ("q", 9000, 10.0)], "node string, length long, coverage double")
    g = links(spark, (">p", ">r"), (">r", ">l"), (">l", ">r"), (">r", ">q"))
    found = BU.simple_loops(n, g, 10.0)
    assert pairs(found) == [(">l", ">r", ">p", ">q")]
    new, arcs = BU.unrolled(n, g, found)
    assert pairs(new, "node") == [("l",), ("p",), ("q",), ("r_copy1",), ("r_copy2",)]
    assert {(">p", ">r_copy1"), (">r_copy1", ">l"), (">l", ">r_copy2"), (">r_copy2", ">q")} <= set(pairs(arcs, "u", "v")) and arcs.count() == 8


def test_tip_loop_copies(spark):
    g = links(spark, (">a", ">x"), (">x", ">x"), (">x", ">b"))
    p = spark.createDataFrame([([">a", ">x", ">x", ">x", ">b"],), ([">a", ">x", ">x", ">b"],), ([">a", ">x", ">b"],)], "path array<string>")
    cov = spark.createDataFrame([("x", 30.0)], "node string, coverage double")
    assert pairs(BU.tip_loops(g, p, cov, 10.0, 2)) == [("x", 2)]


def unique(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "node string")


def as_paths(spark, *paths, name="bridge"):
    return spark.createDataFrame([(p.replace(">", " >").replace("<", " <").split(),) for p in paths], f"{name} array<string>")


def test_bridges_majority_and_wrong_connections(spark):
    p = as_paths(spark, ">u>x>w>y>z", "<w<x<u", ">q>u", name="path")
    found = BR.bridges(p, unique(spark, "u", "w", "z"))
    assert pairs(found.selectExpr("array_join(bridge, '') AS b")) == [("<w<x<u",), ("<w<x<u",), ("<z<y<w",)]
    assert pairs(BR.bridge_counts(found)) == [("<w", "<u", 2), ("<z", "<w", 1)]
    many = as_paths(spark, *[">a>x>b"] * 4, *[">a>y>b"] * 2, ">a>z>b")
    assert [r[1] for r in pairs(BR.majority_bridges(many).selectExpr("n", "kept"))] == [False, True, True]
    conn = BR.right_connections(as_paths(spark, *[">a>b"] * 4, *[">a>c"] * 2, ">d>e"))
    assert sorted({("".join(r.bridge), r.kept) for r in conn.collect()}) == [(">a>b", True), (">a>c", False), (">d>e", False)]


def crossing(spark):
    return links(spark, (">a", ">m"), (">b", ">m"), (">m", ">c"), (">m", ">d")), nodes(spark, a=9, b=9, c=9, d=9, m=1), unique(spark, "a", "b", "c", "d")


def test_crosslinks_and_diploid_completion(spark):
    g, n, u = crossing(spark)
    counted = as_paths(spark, *[">a>m>c"] * 5, *[">b>m>d"] * 5, ">a>m>d")
    kept = BR.unambiguous_tangles(as_paths(spark, ">a>m>c", ">b>m>d", ">a>m>d"), counted, n, g, u)
    assert pairs(kept.selectExpr("array_join(bridge, '') AS b")) == [(">a>m>c",), (">b>m>d",)]
    one = as_paths(spark, ">a>m>c")
    whole = BR.completed_diploid(one, as_paths(spark, *[">a>m>c"] * 5), g, u, 3)
    assert pairs(whole.selectExpr("array_join(bridge, '') AS b")) == [("<c<m<a",), ("<d<m<b",)]
    three = BR.completed_diploid(as_paths(spark, ">a>m>c", ">b>m>d", ">a>m>d"), counted, g, u, 3)
    assert pairs(three.selectExpr("array_join(bridge, '') AS b")) == [("<c<m<a",), ("<d<m<b",)]


def test_connection_along_bridges(spark):
    g, n, u = crossing(spark)
    picked = as_paths(spark, ">a>m>c", ">b>m>d")
    none = spark.createDataFrame([], "end string")
    new, arcs = BR.connected(n, g, picked, none, u)
    assert pairs(new, "node") == [("a",), ("b",), ("c",), ("d",), ("m_1",), ("m_2",)]
    assert pairs(arcs.where("u LIKE '>%' AND v LIKE '>%'"), "u", "v") == [(">a", ">m_1"), (">b", ">m_2"), (">m_1", ">c"), (">m_2", ">d")]
    walked = spark.createDataFrame([([">a", ">m", ">c"],)] * 3, "path array<string>")
    ends = BR.forbidden_ends(walked, as_paths(spark, ">a>m>c"), unique(spark, "m"), unique(spark, "m"), n, g, u, 3)
    assert {r[0] for r in pairs(ends)} >= {">b", "<d"}
    merged = BR.merged_copies(new.select("node"), arcs.where("v NOT LIKE '%d' AND u NOT LIKE '%d' AND u NOT LIKE '%b' AND v NOT LIKE '%b'"), F.regexp_replace("node", "_[0-9]+$", ""))
    assert merged.count() == 6


def test_hairpin_and_diploid_uniques(spark):
    g = links(spark, (">h", "<x"), ("<h", "<x"))
    cov = spark.createDataFrame([("h", 10.0, 100), ("u", 10.0, 1000)], "node string, coverage double, length long")
    assert pairs(U.hairpin_unique(g, cov, unique(spark, "u"))) == [("h",)]
    g, n, _ = crossing(spark)
    p = spark.createDataFrame([([">a", ">m", ">c"],)] * 4 + [([">b", ">m", ">d"],)] * 4, "path array<string>")
    flat = spark.createDataFrame([(x, 10.0) for x in "abcdm"], "node string, coverage double")
    assert pairs(U.diploid_unique(g, p, unique(spark, "a"), flat, flat)) == [("a",), ("b",), ("c",), ("d",)]


def test_unique_nodes(spark):
    n = spark.createDataFrame([("s", 200_000), ("a", 20_000), ("b", 20_000), ("t", 200_000)], "node string, length long")
    cov = spark.createDataFrame([("s", 20.0, 200_000), ("a", 10.0, 20_000), ("b", 10.0, 20_000), ("t", 20.0, 200_000)], "node string, coverage double, length long")
    g = links(spark, *BUBBLE)
    none = spark.createDataFrame([([">a"],)], "path array<string>")
    bubbles = BU.superbubbles(n.withColumn("coverage", F.lit(1.0)), g, chain_steps=True)
    got = dict(pairs(U.unique_nodes(n, g, cov, none, bubbles, 100_000, 10**9)))
    assert got["s"] in ("long", "chain") and "a" not in got


def gaf(spark, *rows):
    return spark.createDataFrame([(r, 1000, s, e, p.replace(">", " >").replace("<", " <").split(), 500, ps, pe) for r, s, e, p, ps, pe in rows], "read string, rlen long, rstart long, rend long, path array<string>, plen long, pstart long, pend long")


def test_gaps_are_proposed_built_and_used(spark):
    n = spark.createDataFrame([("a", 8, "AAAACCCC"), ("b", 8, "GGGGTTTT")], "node string, length long, seq string")
    g = spark.createDataFrame([], "u string, v string, overlap int")
    reads = gaf(spark, *[(f"r{i}", s, e, p, 0, 500) for i, d in enumerate((5, 9, 12)) for s, e, p in ((0, 100, ">a"), (100 + d, 300, ">b"))])
    found = GA.proposed_gaps(reads, n, g, 3, 100, "both")
    assert pairs(found) == [("<b", ">a", 9, 3)]
    built = GA.gap_nodes(found, n, "gap")
    assert pairs(built, "node", "seq", "overlap") == [("gap-1-len-9-cov-3", "N" * 9, 0)]
    assert GA.gap_arcs(built).count() == 4
    joined = GA.joined_alignments(reads, built)
    assert joined.count() == 3 and joined.first().path == [">a", "<gap-1-len-9-cov-3", ">b"]
    zero = found.withColumn("gap", F.lit(0))
    assert GA.gap_nodes(zero, n, "g").first().overlap == 1
    negative = GA.gap_nodes(found.withColumn("gap", F.lit(-3)), n, "g").first()
    assert negative.overlap == 3 and len(negative.seq) == 5


def test_misassemblies_are_cut(spark):
    n = spark.createDataFrame([("a", 10_000), ("b", 10_000)], "node string, length long")
    g = spark.createDataFrame([], "u string, v string, overlap int")
    rows = [(f"r{i}", 1000, s, e, p, 10_000, ps, pe) for i in range(4) for s, e, p, ps, pe in ((0, 500, [">a"], 4000, 5000 + i), (500, 1000, [">b"], 6000 + i, 7000))]
    reads = spark.createDataFrame(rows, "read string, rlen long, rstart long, rend long, path array<string>, plen long, pstart long, pend long")
    cuts = GA.cut_places(reads, n, g, 3, 20)
    assert pairs(cuts) == [("a", 5002), ("b", 6002)]
    assert pairs(GA.cut_nodes(n, cuts.where("node = 'a'"))) == [("a", "a_cut1", 0, 5002), ("a", "a_cut2", 5002, 10_000)]


def test_alignment_coverage(spark):
    n = nodes(spark, a=100, b=100)
    aln = spark.createDataFrame([([">a"], 100, 10, 60), ([">a", "<b", ">a"], 300, 20, 270)], "path array<string>, plen long, pstart long, pend long")
    got = {r.node: r.coverage for r in C.alignment_coverage(aln, n).collect()}
    assert got == {"a": pytest.approx(0.5 + 0.8 + 0.7), "b": 1.0}
