"""Repeat resolution by read paths: nodes split into the ways that paths take through them.

A resolved node n gives one copy for each neighbour: (n, from a) for every predecessor a and (n, to b) for
every follower b, each with all of n's sequence, and an arc with overlap len(n) from (n, from a) to
(n, to b) for every supported triplet a n b. What is spelled along paths stays the same; unitigs then join
copies that are followed by one other only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from .iterate import saved
from .relations import triplet_support


def valid_triplets(graph: DataFrame, paths: DataFrame, targets: DataFrame, support: int) -> DataFrame:
    """(node, a, b, n): triplets a >node b walked at least `support` times, of targets (node) all of whose arcs are in one.

    Nodes with an arc to themselves or to their own reverse are left alone.
    """
    arcs = graph.select("u", "v").distinct()
    own = arcs.where(P.bare(F.col("u")) == P.bare(F.col("v"))).select(P.bare(F.col("u")).alias("node")).distinct()
    open_ = targets.select("node").distinct().join(own, "node", "left_anti")
    seen = triplet_support(paths).where(F.col("n") >= support).select(P.bare(F.col("m")).alias("node"), "a", "b", "n").join(open_, "node", "left_semi")
    seen = seen.join(arcs.select(F.col("u").alias("a"), P.bare(F.col("v")).alias("node"), F.col("v").alias("_v")), ["a", "node"]).where(F.col("_v").startswith(">")).drop("_v")
    seen = saved(seen.join(arcs.select(F.col("v").alias("b"), P.bare(F.col("u")).alias("node"), F.col("u").alias("_u")), ["b", "node"]).where(F.col("_u").startswith(">")).select("node", "a", "b", "n"))
    before = arcs.where(F.col("v").startswith(">")).select(P.bare(F.col("v")).alias("node"), F.col("u").alias("a"))
    behind = arcs.where(F.col("u").startswith(">")).select(P.bare(F.col("u")).alias("node"), F.col("v").alias("b"))
    missing = before.join(seen.select("node", "a"), ["node", "a"], "left_anti").select("node").union(behind.join(seen.select("node", "b"), ["node", "b"], "left_anti").select("node"))
    return seen.join(missing.distinct(), "node", "left_anti")


def independent(targets: DataFrame, graph: DataFrame) -> DataFrame:
    """Of targets (node, length) those without a neighbouring target that is shorter (or equal, and earlier by name)."""
    near = graph.select(P.bare(F.col("u")).alias("node"), P.bare(F.col("v")).alias("other")).where("node <> other").distinct()
    rank = lambda n: F.struct("length", n)
    t = targets.select("node", rank("node").alias("r"))
    beaten = near.join(t, "node").join(t.select(F.col("node").alias("other"), F.col("r").alias("q")), "other").where("q < r").select("node").distinct()
    return targets.join(beaten, "node", "left_anti")


def _from(node: Column, a: Column) -> Column:
    return F.concat(node, F.lit("{"), a, F.lit("}"))


def resolved(nodes: DataFrame, graph: DataFrame, paths: DataFrame, triplets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes: node, source, length; arcs; paths: read, path) after one round; triplets of independent nodes only.

    paths: read, path. A path that takes an unsupported way through a resolved node is split there.
    """
    t = saved(triplets.select("node", "a", "b"))
    names = t.select("node").distinct()
    left = t.select("node", "a").distinct().withColumn("copy", _from(F.col("node"), F.col("a")))
    right = t.select("node", "b").distinct().withColumn("copy", _from(F.col("node"), F.col("b")))
    copies = left.select("copy", "node").unionByName(right.select("copy", "node")).distinct()
    kept = nodes.join(names, "node", "left_anti").select("node", F.col("node").alias("source"), "length")
    out_nodes = kept.unionByName(copies.join(nodes.select("node", "length"), "node").select(F.col("copy").alias("node"), F.col("node").alias("source"), "length"))
    forward = lambda c: F.concat(F.lit(">"), F.col(c))
    overlap = graph.select(F.col("u").alias("_u"), F.col("v").alias("_v"), "overlap")
    enter = left.select(F.col("a").alias("u"), forward("copy").alias("v"), F.col("a").alias("_u"), forward("node").alias("_v")).join(overlap, ["_u", "_v"]).select("u", "v", "overlap")
    leave = right.select(forward("copy").alias("u"), F.col("b").alias("v"), forward("node").alias("_u"), F.col("b").alias("_v")).join(overlap, ["_u", "_v"]).select("u", "v", "overlap")
    size = nodes.select("node", F.col("length").cast("int").alias("overlap"))
    inner = t.join(size, "node").select(F.concat(F.lit(">"), _from(F.col("node"), F.col("a"))).alias("u"), F.concat(F.lit(">"), _from(F.col("node"), F.col("b"))).alias("v"), "overlap")
    new = enter.unionByName(leave).unionByName(inner)
    old = graph.select("u", "v", "overlap").join(names.select(F.col("node").alias("_n")), P.bare(F.col("u")) == F.col("_n"), "left_anti").join(names.select(F.col("node").alias("_n")), P.bare(F.col("v")) == F.col("_n"), "left_anti")
    arcs = old.unionByName(new).unionByName(new.select(P.flipped(F.col("v")).alias("u"), P.flipped(F.col("u")).alias("v"), "overlap")).distinct()
    return out_nodes, arcs, _walked(paths, t)


def _walked(paths: DataFrame, t: DataFrame) -> DataFrame:
    """paths with their steps through resolved nodes as copies, split where the way is not supported."""
    by = Window.partitionBy("read").orderBy("i")
    steps = paths.select("read", F.posexplode("path").alias("i", "step"))
    steps = steps.withColumn("prev", F.lag("step").over(by)).withColumn("next", F.lead("step").over(by))
    turned = F.col("step").startswith("<")
    steps = steps.withColumn("node", P.bare(F.col("step"))).withColumn("a", F.when(turned, P.flipped(F.col("next"))).otherwise(F.col("prev"))).withColumn("b", F.when(turned, P.flipped(F.col("prev"))).otherwise(F.col("next")))
    names = t.select("node", F.lit(True).alias("_res")).distinct()
    good = t.select("node", "a", "b", F.lit(True).alias("_ok")).distinct()
    joined = steps.join(names, "node", "left").join(good, ["node", "a", "b"], "left")
    la, lb = F.concat(F.lit(">"), _from(F.col("node"), F.col("a"))), F.concat(F.lit(">"), _from(F.col("node"), F.col("b")))
    pieces = F.array_compact(F.array(F.when(F.col("a").isNotNull(), la), F.when(F.col("b").isNotNull(), lb)))
    ended = F.col("a").isNull() | F.col("b").isNull()
    parts = F.when(F.col("_res").isNull(), F.array("step")).when(F.col("_ok").isNotNull() | ended, F.when(turned, P.reversed_path(pieces)).otherwise(pieces)).otherwise(F.array().cast("array<string>"))
    cut = (F.col("_res").isNotNull() & F.col("_ok").isNull() & ~ended).cast("int")
    runs = joined.withColumn("parts", parts).withColumn("_run", F.sum(cut).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    grouped = runs.groupBy("read", "_run").agg(F.array_sort(F.collect_list(F.struct("i", "parts"))).alias("x"))
    return grouped.select("read", F.flatten(F.transform("x", lambda e: e["parts"])).alias("path")).where(F.size("path") > 0)


def resolve(nodes: DataFrame, graph: DataFrame, paths: DataFrame, max_length: int, supports: tuple[int, ...] = (20, 10, 5)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rounds of resolution of nodes up to max_length, shortest first, for ever less support, until none is left to resolve."""
    nodes, graph, paths = nodes.select("node", F.col("node").alias("source"), "length"), graph.select("u", "v", "overlap"), paths.select("read", "path")
    for support in supports:
        while True:
            targets = nodes.where((F.col("length") <= max_length) & ~F.contains("node", F.lit("{"))).select("node", "length")
            able = valid_triplets(graph, paths, targets, support)
            ready = independent(targets.join(able.select("node").distinct(), "node", "left_semi"), graph)
            chosen = saved(able.join(ready.select("node"), "node", "left_semi"))
            if chosen.isEmpty():
                break
            new, arcs, walks = resolved(nodes.select("node", "length"), graph, paths, chosen)
            origin = nodes.select(F.col("node").alias("_n"), F.col("source").alias("_s"))
            nodes = saved(new.join(origin, F.col("source") == F.col("_n")).select("node", F.col("_s").alias("source"), "length"))
            graph, paths = saved(arcs), saved(walks)
    return nodes, graph, paths


def split_at_missing(paths: DataFrame, graph: DataFrame) -> DataFrame:
    """paths (read, path) cut between steps that no arc joins any more."""
    by = Window.partitionBy("read").orderBy("i")
    steps = paths.select("read", F.posexplode("path").alias("i", "v")).withColumn("u", F.lag("v").over(by))
    joined = steps.join(graph.select("u", "v", F.lit(0).alias("_k")).distinct(), ["u", "v"], "left").withColumn("_run", F.sum(F.coalesce("_k", F.lit(1))).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    grouped = joined.groupBy("read", "_run").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("x"))
    return grouped.select("read", F.transform("x", lambda e: e["v"]).alias("path"))


def supported_graph(graph: DataFrame, paths: DataFrame, least: int, safe: DataFrame) -> DataFrame:
    """arcs walked at least `least` times, or between nodes of safe (node), which are never taken away."""
    walked = paths.select(F.explode(P.steps(F.col("path"), 2)).alias("s")).select(P.canonical_edge(F.col("s")[0], F.col("s")[1]).alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("e")
    edge = graph.withColumn("e", P.canonical_edge(F.col("u"), F.col("v")))
    s = safe.select("node").distinct()
    kept = edge.join(walked, "e", "left_semi")
    firm = edge.join(s.withColumnRenamed("node", "_a"), P.bare(F.col("u")) == F.col("_a"), "left_semi").join(s.withColumnRenamed("node", "_b"), P.bare(F.col("v")) == F.col("_b"), "left_semi")
    return kept.unionByName(firm).select("u", "v", "overlap").distinct()


def hairpins(graph: DataFrame) -> DataFrame:
    """Oriented nodes whose only follower is their own reverse."""
    one = graph.groupBy("u").agg(F.countDistinct("v").alias("n"), F.min("v").alias("v")).where("n = 1")
    return one.where(F.col("v") == P.flipped(F.col("u"))).select(F.col("u").alias("end"))


def unfolded_hairpins(nodes: DataFrame, graph: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: node, source; arcs): a hairpin that one node alone leads into is written out: in, turn and back as a second copy."""
    ends = hairpins(graph)
    into = graph.join(ends.select(F.col("end").alias("v")), "v", "left_semi").where(P.bare(F.col("u")) != P.bare(F.col("v")))
    single = into.groupBy("v").agg(F.countDistinct("u").alias("n"), F.min("u").alias("u")).where("n = 1").select(F.col("v").alias("end"), "u")
    chosen = saved(single.select("end", P.bare(F.col("end")).alias("node"), "u"))
    copy = F.concat("node", F.lit("_turn"))
    out_nodes = nodes.select("node", F.col("node").alias("source")).unionByName(chosen.select(copy.alias("node"), F.col("node").alias("source")))
    own = chosen.select(F.col("end").alias("u"), P.flipped(F.col("end")).alias("v")).join(graph, ["u", "v"])
    new = own.select("u", F.concat(F.substring("v", 1, 1), P.bare(F.col("v")), F.lit("_turn")).alias("v"), "overlap")
    rest = graph.join(chosen.select(F.col("end").alias("u"), P.flipped(F.col("end")).alias("v")), ["u", "v"], "left_anti")
    arcs = rest.select("u", "v", "overlap").unionByName(new).unionByName(new.select(P.flipped(F.col("v")).alias("u"), P.flipped(F.col("u")).alias("v"), "overlap")).distinct()
    return out_nodes, arcs
