"""Single-copy nodes: by length, path consistency, chains, hairpins and diploid propagation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from . import coverage as C
from .graph import tangles
from .iterate import components, hinted, saved
from .relations import triplet_support

# Thresholds of length, and coverage relative to one copy, for single nodes and for chains.
NODE_STEPS = ((1_000, 0.95, 1.01), (10_000, 0.85, 1.02), (20_000, 0.75, 1.10), (30_000, 0.70, 1.20), (50_000, 0.40, 1.30), (100_000, 0.40, 1.40))
CHAIN_STEPS = ((5_000, 0.95, 1.01), (20_000, 0.85, 1.02), (35_000, 0.70, 1.10), (50_000, 0.40, 1.20), (75_000, 0.40, 1.25), (100_000, 0.40, 1.30), (200_000, 0.40, 1.40))


def in_steps(length: Column, ratio: Column, steps: tuple[tuple[int, float, float], ...]) -> Column:
    out = F.lit(False)
    for least, low, high in steps:
        out = out | ((length > least) & (ratio > low) & (ratio < high))
    return out


def own_lengths(nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """(node, own): length without the largest overlap at each end, 1 at least."""
    over = graph.groupBy("u").agg(F.max("overlap").alias("o")).groupBy(P.bare(F.col("u")).alias("node")).agg(F.sum("o").alias("o"))
    return nodes.join(over, "node", "left").select("node", F.greatest(F.col("length") - F.coalesce("o", F.lit(0)), F.lit(1)).alias("own"))


def path_unique(paths: DataFrame, long_nodes: DataFrame) -> DataFrame:
    """Nodes whose paths all agree on both sides: of any two continuations one is a prefix of the other."""
    steps = paths.select("path", F.posexplode("path").alias("i", "step"))
    ahead = steps.select(F.when(F.col("step").startswith(">"), F.slice("path", F.col("i") + 2, F.size("path"))).otherwise(P.reversed_path(F.slice("path", F.lit(1), F.col("i")))).alias("p"), P.bare(F.col("step")).alias("node"), F.lit(">").alias("side"))
    behind = steps.select(F.when(F.col("step").startswith("<"), F.slice("path", F.col("i") + 2, F.size("path"))).otherwise(P.reversed_path(F.slice("path", F.lit(1), F.col("i")))).alias("p"), P.bare(F.col("step")).alias("node"), F.lit("<").alias("side"))
    both = ahead.unionByName(behind)
    longest = both.groupBy("node", "side").agg(F.max_by("p", F.size("p")).alias("l"))
    judged = both.join(longest, ["node", "side"]).groupBy("node").agg(F.min((F.slice("l", F.lit(1), F.size("p")) == F.col("p")).cast("int")).alias("ok"))
    return judged.where("ok = 1").join(long_nodes.select("node"), "node", "left_semi").select("node")


def chains(graph: DataFrame, bubbles: DataFrame, normalised: DataFrame, ratio: float = 1.5) -> DataFrame:
    """(node, chain): nodes joined by superbubbles (s, t) whose ends have coverages within the ratio."""
    cov = normalised.select(F.col("node").alias("_n"), F.col("normalised").alias("c"))
    pairs = bubbles.select(P.bare(F.col("s")).alias("a"), P.bare(F.col("t")).alias("b"))
    pairs = pairs.join(cov.select(F.col("_n").alias("a"), F.col("c").alias("ca")), "a").join(cov.select(F.col("_n").alias("b"), F.col("c").alias("cb")), "b")
    near = pairs.where((F.col("ca") <= F.col("cb") * ratio) & (F.col("cb") <= F.col("ca") * ratio)).select("a", "b")
    found = components(near)
    return normalised.select("node").join(found, "node", "left").select("node", F.coalesce("label", "node").alias("chain"))


def unique_nodes(nodes: DataFrame, graph: DataFrame, cov: DataFrame, paths: DataFrame, bubbles: DataFrame, long_length: int = 100_000, consistent_length: int = 5_000) -> DataFrame:
    """(node, why): long nodes, path-consistent ones, members of unique chains and well covered ones.

    Coverage is normalised by the tangle around a node: the weighted mean of its long nodes.
    """
    own = saved(own_lengths(nodes, graph))
    mean = C.mean_coverage(cov, long_length)
    long_nodes = nodes.where(F.col("length") >= long_length).select("node")
    ends = tangles(nodes, graph, long_nodes)
    weights = ends.select(P.bare(F.col("end")).alias("node"), "tangle").distinct().join(cov, "node").join(hinted(long_nodes), "node", "left_semi")
    local = weights.groupBy("tangle").agg(C.weighted_mean(F.col("coverage"), F.col("length")).alias("m"))
    near = ends.select(P.bare(F.col("end")).alias("node"), "tangle").distinct().join(local, "tangle").groupBy("node").agg(F.avg("m").alias("near_mean"))
    normalised = saved(C.local_normalised(cov, near, mean))
    chain = chains(graph, bubbles, normalised)
    sums = chain.join(normalised, "node").join(own, "node")
    total = sums.groupBy("chain").agg(F.sum(F.col("normalised") * F.col("own")).alias("length"), C.weighted_mean(F.col("normalised"), F.col("own")).alias("ratio"))
    good = total.where(in_steps(F.col("length"), F.col("ratio"), CHAIN_STEPS))
    of_chain = sums.join(good.select("chain", "ratio"), "chain").where((F.col("normalised") / F.col("ratio") > 0.4) & (F.col("normalised") / F.col("ratio") < 1.4)).select("node")
    of_length = normalised.select("node", "normalised").join(own, "node").where(in_steps(F.col("own"), F.col("normalised"), NODE_STEPS)).select("node")
    consistent = path_unique(paths, nodes.where(F.col("length") >= consistent_length))
    named = [(long_nodes, "long"), (consistent, "paths"), (of_chain, "chain"), (of_length, "coverage")]
    out = None
    for rows, why in named:
        part = rows.select("node", F.lit(why).alias("why"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("node").agg(F.min("why").alias("why"))


def hairpin_unique(graph: DataFrame, cov: DataFrame, unique: DataFrame, low: float = 0.5, high: float = 1.5) -> DataFrame:
    """Nodes whose two ends both lead to the same single oriented node, covered like the unique ones."""
    mean = cov.join(unique.select("node").distinct(), "node", "left_semi").agg(C.weighted_mean(F.col("coverage"), F.col("length")).alias("mean"))
    one = graph.groupBy("u").agg(F.countDistinct("v").alias("n"), F.min("v").alias("v")).where("n = 1")
    fw = one.where(F.col("u").startswith(">")).select(P.bare(F.col("u")).alias("node"), "v")
    bw = one.where(F.col("u").startswith("<")).select(P.bare(F.col("u")).alias("node"), F.col("v").alias("w"))
    found = fw.join(bw, "node").where("v = w").join(cov, "node").join(F.broadcast(mean))
    found = found.where((F.col("coverage") >= F.col("mean") * low) & (F.col("coverage") <= F.col("mean") * high)).select("node")
    return found.join(unique.select("node"), "node", "left_anti")


def _even_sides(graph: DataFrame, covs: list[DataFrame], ratio: float) -> DataFrame:
    """Ends all of whose followers have no other predecessor and similar coverage in every table."""
    back = graph.groupBy("v").agg(F.countDistinct("u").alias("n_in"))
    sides = graph.join(back, "v").groupBy("u").agg(F.max("n_in").alias("most")).where("most = 1").select("u")
    for i, cov in enumerate(covs):
        near = graph.join(cov.select(F.col("node").alias("_n"), "coverage"), P.bare(F.col("v")) == F.col("_n"), "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))
        even = near.groupBy("u").agg(F.min("coverage").alias("lo"), F.max("coverage").alias("hi")).where(F.col("hi") <= F.col("lo") * ratio).select("u")
        sides = sides.join(even, "u", "left_semi")
    return sides


def diploid_unique(graph: DataFrame, paths: DataFrame, unique: DataFrame, ont: DataFrame, hifi: DataFrame, ratio: float = 1.5) -> DataFrame:
    """unique with the neighbours of nodes that are passed one to one by their triplets, spread until nothing is new.

    A node that is next to a unique one counts if it has as many followers as predecessors, all private to it
    and evenly covered, and its best supported triplets pair them up, the worst of those at
    least half as often as the best and twice as often as the next one.
    """
    even = _even_sides(graph, [ont, hifi], ratio)
    degree = graph.groupBy("u").agg(F.countDistinct("v").alias("n"))
    fw = degree.where(F.col("u").startswith(">")).join(even, "u").select(P.bare(F.col("u")).alias("node"), "n")
    bw = degree.where(F.col("u").startswith("<")).join(even, "u").select(P.bare(F.col("u")).alias("node"), F.col("n").alias("m"))
    able = fw.join(bw, "node").where("n = m AND n >= 2").select("node", "n")
    t = triplet_support(paths).select(P.bare(F.col("m")).alias("node"), "a", "b", F.col("n").alias("times")).join(able, "node")
    per = t.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("times", "a", "b")), asc=False).alias("s")).where(F.size("s") >= F.col("n"))
    top = F.slice("s", F.lit(1), F.col("n").cast("int"))
    worst = F.element_at("s", F.col("n").cast("int"))["times"]
    following = F.try_element_at("s", (F.col("n") + 1).cast("int"))["times"]
    paired = (F.size(F.array_distinct(F.transform(top, lambda x: x["a"]))) == F.col("n")) & (F.size(F.array_distinct(F.transform(top, lambda x: x["b"]))) == F.col("n"))
    passed = saved(per.where(paired & (F.col("s")[0]["times"] <= worst * 2) & (following.isNull() | (worst >= following * 2))).select("node"))
    near = saved(graph.join(passed, P.bare(F.col("u")) == F.col("node"), "left_semi").select(P.bare(F.col("u")).alias("core"), P.bare(F.col("v")).alias("node")).distinct())
    known = saved(unique.select("node").distinct())
    while True:
        cores = near.join(known, "node", "left_semi").select("core").distinct().join(known.withColumnRenamed("node", "core"), "core", "left_anti")
        new = saved(near.join(cores, "core", "left_semi").select("node").distinct().join(known, "node", "left_anti"))
        if new.isEmpty():
            break
        known = saved(known.union(new))
    return known
