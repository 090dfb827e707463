"""Node coverage: from alignments, weighted means and medians, thresholds, tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P


def alignment_coverage(alignments: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, coverage, length): how often alignments (path, plen, pstart, pend) pass each node.

    A node alone in its path counts the aligned share of the path. In longer paths inner nodes
    count 1 and both ends the share that is not clipped; a node that is both ends counts twice.
    """
    n = F.size("path")
    parts = alignments.where(n > 0).select(n.alias("n"), "plen", "pstart", (F.col("plen") - F.col("pend")).alias("clip"), F.posexplode("path").alias("i", "step"))
    parts = parts.withColumn("node", P.bare(F.col("step"))).join(nodes.select("node", "length"), "node")
    share = (
        F.when(F.col("n") == 1, (F.col("plen") - F.col("pstart") - F.col("clip")) / F.col("plen"))
        .when(F.col("i") == 0, (F.col("length") - F.col("pstart")) / F.col("length"))
        .when(F.col("i") == F.col("n") - 1, (F.col("length") - F.col("clip")) / F.col("length"))
        .otherwise(F.lit(1.0))
    )
    sums = parts.groupBy("node").agg(F.sum(share.cast("double")).alias("coverage"))
    return nodes.select("node", "length").join(sums, "node", "left").select("node", F.coalesce("coverage", F.lit(0.0)).alias("coverage"), "length")


def weighted_mean(coverage: Column, length: Column) -> Column:
    """Length-weighted mean; 0 where there is no length."""
    return F.coalesce(F.sum(coverage * length) / F.nullif(F.sum(length), F.lit(0)), F.lit(0.0))


def mean_coverage(cov: DataFrame, min_length: int = 0) -> DataFrame:
    """One row: the weighted mean over nodes of at least min_length."""
    return cov.where(F.col("length") >= min_length).agg(weighted_mean(F.col("coverage"), F.col("length")).alias("mean"))


def refined_mean(cov: DataFrame, min_length: int, low: float = 0.5, high: float = 1.5) -> DataFrame:
    """The mean again, over the nodes whose coverage is within low..high times the first mean."""
    first = mean_coverage(cov, min_length).withColumnRenamed("mean", "_first")
    near = cov.join(F.broadcast(first)).where((F.col("coverage") >= F.col("_first") * low) & (F.col("coverage") <= F.col("_first") * high))
    return mean_coverage(near, min_length)


def group_mean(cov: DataFrame, group: str, long_node: int = 0) -> DataFrame:
    """Per component or chain: weighted mean, total length, number of nodes and of long ones."""
    return cov.groupBy(group).agg(
        weighted_mean(F.col("coverage"), F.col("length")).alias("mean"),
        F.sum("length").alias("length"),
        F.count(F.lit(1)).alias("nodes"),
        F.sum((F.col("length") >= long_node).cast("long")).alias("long_nodes"),
    )


def weighted_median(cov: DataFrame, group: str) -> DataFrame:
    """Per group, the first coverage at which the summed length exceeds half of all."""
    by = Window.partitionBy(group)
    upto = by.orderBy("coverage").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = cov.groupBy(group, "coverage").agg(F.sum("length").alias("length"))
    marked = sums.withColumn("_upto", F.sum("length").over(upto)).withColumn("_all", F.sum("length").over(by))
    return marked.where(2 * F.col("_upto") > F.col("_all")).groupBy(group).agg(F.min("coverage").alias("median"))


def solid_threshold(cov: DataFrame, fraction: float = 0.5, min_length: int = 100_000) -> DataFrame:
    """One row: the whole part of a fraction of the mean coverage of long nodes."""
    return mean_coverage(cov, min_length).select(F.floor(F.col("mean") * fraction).alias("threshold"))


def solid_nodes(cov: DataFrame, fraction: float = 0.5, min_length: int = 100_000) -> DataFrame:
    return cov.join(F.broadcast(solid_threshold(cov, fraction, min_length))).where(F.col("coverage") >= F.col("threshold")).select("node", "coverage", "length")


def unique_by_steps(length: Column, coverage: Column, mean: Column, steps: tuple[tuple[int, float, float], ...] = ((200_000, 0.25, 2.0), (100_000, 0.5, 1.5), (50_000, 0.75, 1.25))) -> Column:
    """Whether a node is single-copy: the longer it is, the further its coverage may be from the mean."""
    out = F.lit(False)
    for least, low, high in steps:
        out = out | ((length >= least) & (coverage >= mean * low) & (coverage <= mean * high))
    return out


def local_normalised(cov: DataFrame, near: DataFrame, mean: DataFrame) -> DataFrame:
    """coverage over the mean of the neighbourhood (node, near_mean), or over the global mean where that is 10 times off or absent."""
    joined = cov.join(near, "node", "left").join(F.broadcast(mean))
    usable = (F.col("near_mean") >= F.col("mean") * 0.1) & (F.col("near_mean") <= F.col("mean") * 10)
    return joined.select("node", "coverage", "length", (F.col("coverage") / F.when(usable, F.col("near_mean")).otherwise(F.col("mean"))).alias("normalised"))


def latest_coverage(rounds: DataFrame) -> DataFrame:
    """Of several rows (node, coverage, length, round) of a node, the one of the last round."""
    return rounds.groupBy("node").agg(F.max_by("coverage", "round").alias("coverage"), F.max_by("length", "round").alias("length"))


def with_coverage_tag(nodes: DataFrame, cov: DataFrame, allow_absent: bool = True) -> DataFrame:
    """nodes with their coverage as a tag of one decimal; absent ones without, or an error."""
    joined = nodes.join(cov.select("node", "coverage"), "node", "left")
    tag = F.concat(F.lit("ll:f:"), F.format_string("%.1f", "coverage"))
    if not allow_absent:
        tag = F.when(F.col("coverage").isNull(), F.raise_error(F.concat(F.lit("no coverage for "), F.col("node")))).otherwise(tag)
    return joined.withColumn("tag", F.when(F.col("coverage").isNotNull() | F.lit(not allow_absent), tag)).drop("coverage")


def degree_statistics(links: DataFrame) -> DataFrame:
    """Mean, standard deviation and mean + 5 deviations of the nodes' numbers of neighbours, over links (a, b)."""
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a")).distinct()
    degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    return degree.agg(F.avg("degree").alias("mean"), F.stddev_pop("degree").alias("deviation"), (F.avg("degree") + 5 * F.stddev_pop("degree")).alias("limit"))
