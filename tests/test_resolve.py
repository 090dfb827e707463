from __future__ import annotations

from pyspark.sql import functions as F

from graftline.operators import finishing as FI
from graftline.operators import resolve as RS

from .test_graph import crossing, links, nodes, pairs, unique


def walks(spark, *paths):
    return spark.createDataFrame([(f"r{i}", p.replace(">", " >").replace("<", " <").split()) for i, p in enumerate(paths)], "read string, path array<string>")


def test_crossing_is_resolved_by_paths(spark):
    g, n, _ = crossing(spark)
    p = walks(spark, *[">a>m>c"] * 5, *["<d<m<b"] * 5, ">a>m>d")
    new, arcs, out = RS.resolve(n, g, p, 5, (3,))
    assert pairs(new.where("source = 'm'"), "node") == [("m{<x}".replace("<x", x),) for x in sorted([">a", ">b", ">c", ">d"])]
    inner = {(r.u, r.v) for r in arcs.collect() if r.overlap == 1}
    assert (">m{>a}", ">m{>c}") in inner and (">m{>a}", ">m{>d}") not in inner
    got = {"".join(r.path) for r in out.collect()}
    assert ">a>m{>a}>m{>c}>c" in got and "<d<m{>d}<m{>b}<b" in got and ">a" in got
    few = RS.resolve(n, g, walks(spark, ">a>m>c"), 5, (1,))
    assert few[0].where("source = 'm'").count() == 1


def test_paths_split_and_hairpins_unfold(spark):
    g = links(spark, (">a", ">b"), (">b", ">c"))
    p = walks(spark, ">a>b>c", ">a>c")
    assert sorted("".join(r.path) for r in RS.split_at_missing(p, g).collect()) == [">a", ">a>b>c", ">c"]
    assert pairs(RS.supported_graph(g, walks(spark, ">a>b", ">a>b"), 2, unique(spark)), "u", "v") == [("<b", "<a"), (">a", ">b")]
    h = links(spark, (">x", ">h"), (">h", "<h"))
    assert pairs(RS.hairpins(h)) == [(">h",)]
    new, arcs = RS.unfolded_hairpins(nodes(spark, x=5, h=2), h)
    assert pairs(new, "node") == [("h",), ("h_turn",), ("x",)] and (">h", "<h_turn") in set(pairs(arcs, "u", "v"))


def test_trimmed_alignments(spark):
    n = nodes(spark, a=100, b=100, c=100)
    g = links(spark, (">a", ">b"), (">b", ">c"), overlap=10)
    aln = spark.createDataFrame([("r", 300, 0, 250, [">a", ">b", ">c"], 280, 95, 200), ("s", 300, 0, 15, [">a"], 100, 0, 15)], "read string, rlen long, rstart long, rend long, path array<string>, plen long, pstart long, pend long")
    got = FI.trimmed_alignments(aln, n, g, 10).collect()
    assert [(r.read, r.path, r.rstart, r.rend, r.pstart, r.pend, r.plen) for r in got] == [("r", [">b", ">c"], 10, 240, 15, 100, 190)]
    none = spark.createDataFrame([], "read string")
    assert sorted(r.read for r in FI.maybe_trimmed(aln, n, g, 10, none).collect()) == ["r", "s"]
    # A repeated row stays repeated, and one that differs in its place on the path only is placed by itself.
    shifted = aln.where("read = 'r'").withColumn("pstart", F.lit(0).cast("long"))
    more = FI.trimmed_alignments(aln.union(aln).union(shifted), n, g, 10).collect()
    assert sorted(("".join(r.path), r.pstart, r.plen) for r in more) == [(">a>b>c", 10, 280), (">b>c", 15, 190), (">b>c", 15, 190)]


def test_lineage_and_trio(spark):
    mapping = spark.createDataFrame([("u1", [">r1", "<r2"]), ("u2", [">r2", ">r3"])], "name string, path array<string>")
    roots = spark.createDataFrame([("u1",), ("u2",)], "name string")
    raw = spark.createDataFrame([("r1", 10.0, 100), ("r2", 50.0, 100), ("r3", 20.0, 300)], "node string, coverage double, length long")
    assert pairs(FI.lineage_coverage(mapping, roots, raw)) == [("u1", 10.0, 200), ("u2", 20.0, 400)]
    assert pairs(FI.old_nodes(mapping, roots, "r")) == [("u1", "r1"), ("u1", "r2"), ("u2", "r2"), ("u2", "r3")]
    assert pairs(FI.homozygous_links(mapping, roots, raw, 100)) == [("u1", "u2")]
    marks = spark.createDataFrame([("n", 0, 10, "m"), ("n", 1500, 1510, "m"), ("n", 2000, 2010, "p"), ("n", 3400, 3410, "p")], "node string, s long, e long, hap string")
    assert pairs(FI.trio_pieces(marks, spark.createDataFrame([("n", 5000)], "node string, length long"), 1000)) == [("n", "n_cut1", 0, 1510), ("n", "n_cut2", 1510, 5000)]


def test_contained_uniques_go(spark):
    n = nodes(spark, a=9, x=1, b=9, c=1)
    g = links(spark, (">a", ">c"), (">c", ">x"), (">x", ">c"), (">c", ">b"))
    p = spark.createDataFrame([([">a", ">c", ">b"],)] * 3, "path array<string>")
    assert pairs(FI.without_contained(unique(spark, "a", "b", "x"), p, n, g)) == [("a",), ("b",)]


def test_paths_and_display(spark):
    steps = spark.createDataFrame([("p+", 0, ">a"), ("p+", 1, ">b"), ("q+", 0, ">d")], "path string, pos int, step string")
    g = links(spark, (">a", ">b"), (">b", ">c"), (">c", ">d"))
    assert pairs(FI.path_distances(steps, g, nodes(spark, a=1, b=1, c=7, d=1), 100)) == [("p+", "q+", 7)]
    ends = FI.telomeric_path_ends(steps, spark.createDataFrame([("<a",), (">d",)], "end string"))
    assert pairs(ends) == [("p+", True, False), ("q+", False, True)]
    colors = spark.createDataFrame([("a", 1), ("b", 2), ("d", 3)], "node string, color int")
    assert pairs(FI.path_colors(steps, colors)) == [("p+", 0), ("q+", 3)]
    new, arcs = FI.display_graph(nodes(spark, a=1, b=1, c=1, d=1), g, unique(spark, "d"), spark.createDataFrame([("<a",)], "end string"), unique(spark, "b", "c"))
    assert pairs(new) == [("a",), ("rDNA",), ("telomere_-a",)] and (">a", ">rDNA") in set(pairs(arcs))
    bubbles = spark.createDataFrame([(">a", ">b"), (">b", ">d"), (">x", ">y")], "s string, t string")
    assert pairs(FI.long_node_chains(bubbles, unique(spark, "a"))) == [("a",), ("b",), ("d",)]
    paths = spark.createDataFrame([("p", "m"), ("q", "f")], "path string, label string")
    swapped = FI.rephased(paths, spark.createDataFrame([("p", "q")], "p string, q string"), spark.createDataFrame([("p", "f")], "path string, label string"))
    assert pairs(swapped) == [("p", "f"), ("q", "m")]


def test_overlap_candidates(spark):
    import random

    rng = random.Random(3)
    base = "".join(rng.choice("ACGT") for _ in range(400))
    other = "".join(rng.choice("ACGT") for _ in range(300))
    turned = base[100:350][::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = spark.createDataFrame([("a", base[:250]), ("b", turned), ("c", other)], "read string, seq string")
    assert pairs(FI.overlap_candidates(FI.minimizers(reads)), "a", "b") == [("a", "b")]


def test_linear_alignments_replace_worse_ones(spark):
    schema = "read string, rstart long, rend long, mapq int, idy double"
    graph_based = spark.createDataFrame([("r", 0, 5000, 60, 0.99), ("s", 0, 9000, 60, 0.99)], schema)
    linear = spark.createDataFrame([("r", 0, 9000, 60, 0.98), ("s", 0, 6000, 60, 0.98)], schema)
    got = FI.chosen_alignments(graph_based, linear, spark.createDataFrame([], "read string"))
    assert pairs(got, "read", "rend") == [("r", 9000), ("s", 9000)]
    assert FI.new_names(unique(spark, "a", "unroll_a_1"), unique(spark, "a"), r"^unroll_(.*)_[0-9]+$").first().source == "a"
    assert FI.translated_uniques(unique(spark, "x"), unique(spark, "xnf_y", "z")).count() == 1
    assert F is not None
