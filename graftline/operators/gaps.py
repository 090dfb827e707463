"""Gaps and cuts: nodes inserted where reads bridge tips, haplotype gaps mended, misassemblies cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .iterate import numbered
from ..functions import paths as P
from ..functions import sequences as S
from .graph import tips as graph_tips
from .relations import consecutive, gap_lengths, position_clusters, supported_gaps


def with_ends(alignments: DataFrame) -> DataFrame:
    """alignments with first and last node of their path, and clips lclip and rclip."""
    return alignments.select("*", F.col("path")[0].alias("first"), F.element_at("path", -1).alias("last"), F.col("pstart").alias("lclip"), (F.col("plen") - F.col("pend")).alias("rclip"))


def proposed_gaps(alignments: DataFrame, nodes: DataFrame, graph: DataFrame, least: int, max_clip: int, tips: str = "one") -> DataFrame:
    """(a, b, gap, support): ends to be joined. tips: 'both' ends have to be tips, 'one' of them, or 'any' ends."""
    gaps = gap_lengths(with_ends(alignments), max_clip)
    known = graph.select(P.canonical_ends(F.col("u"), P.flipped(F.col("v"))).alias("e")).distinct().select(F.col("e")[0].alias("a"), F.col("e")[1].alias("b"))
    gaps = gaps.join(known, ["a", "b"], "left_anti")
    if tips != "any":
        dead = graph_tips(nodes, graph).select("end").distinct()
        for c in ("a", "b"):
            gaps = gaps.join(dead.select(F.col("end").alias(c), F.lit(True).alias(f"_{c}")), c, "left")
        both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
        gaps = gaps.where(both if tips == "both" else F.col("_a").isNotNull() | F.col("_b").isNotNull()).drop("_a", "_b")
    return supported_gaps(gaps, least)


def gap_nodes(gaps: DataFrame, nodes: DataFrame, prefix: str) -> DataFrame:
    """gaps with the new node's name, sequence and overlap with its neighbours; nodes: node, seq.

    Positive gaps are runs of N. Where the ends touch, the new node has the last base before and the first one
    behind; where they overlap, it spells the overlap and one base on either side, as long as the nodes allow.
    """
    gaps = numbered(gaps, ["a", "b"], "_number")
    name = F.concat_ws("-", F.lit(prefix), (F.col("_number") + 1).cast("string"), F.lit("len"), F.col("gap").cast("string"), F.lit("cov"), F.col("support").cast("string"))
    seq = nodes.select(F.col("node").alias("_n"), F.col("seq").alias("_s"))
    both = gaps.withColumn("node", name).drop("_number")
    for c, s in (("a", "sa"), ("b", "sb")):
        both = both.join(seq, P.bare(F.col(c)) == F.col("_n")).withColumn(s, F.col("_s")).drop("_n", "_s")
    before = F.when(F.col("a").startswith("<"), S.reverse_complement(F.col("sa"))).otherwise(F.col("sa"))
    behind = F.when(F.col("b").startswith(">"), S.reverse_complement(F.col("sb"))).otherwise(F.col("sb"))
    overlap = F.when(F.col("gap") > 0, 0).when(F.col("gap") == 0, 1).otherwise(F.least(-F.col("gap"), F.length("sa") - 2, F.length("sb") - 2)).cast("int")
    both = both.withColumn("_x", before).withColumn("_y", behind).withColumn("overlap", overlap)
    spelled = F.when(F.col("gap") > 0, S.n_gap(F.greatest(F.col("gap"), F.lit(0))))
    spelled = spelled.when(F.col("gap") == 0, F.concat(F.right("_x", F.lit(1)), F.left("_y", F.lit(1))))
    spelled = spelled.otherwise(F.concat(F.right("_x", F.col("overlap") + 1), F.substring("_y", F.col("overlap") + 1, F.lit(1))))
    return both.select("a", "b", "gap", "support", "node", spelled.alias("seq"), "overlap")


def gap_arcs(gaps: DataFrame) -> DataFrame:
    """Arcs from either end into the new node (u, v, overlap), mirrors included."""
    one = gaps.select(F.col("a").alias("u"), F.concat(F.lit(">"), "node").alias("v"), "overlap").union(gaps.select(F.concat(F.lit(">"), "node"), P.flipped(F.col("b")), "overlap"))
    return one.union(one.select(P.flipped(F.col("v")), P.flipped(F.col("u")), "overlap"))


def joined_alignments(alignments: DataFrame, gaps: DataFrame) -> DataFrame:
    """(read, rstart, rend, path): consecutive alignments that meet in one of gaps (a, b, node) become one record."""
    rows = with_ends(alignments)
    marked = consecutive(rows, "read", ["rstart", "rend", "first", "last"], ["last"])
    pair = P.canonical_ends(F.col("prev_last"), P.flipped(F.col("first")))
    g = gaps.select("a", "b", "node")
    joined = marked.withColumn("_pair", pair).join(g, (F.col("_pair")[0] == F.col("a")) & (F.col("_pair")[1] == F.col("b")), "left")
    through = F.when(F.col("node").isNull(), F.array().cast("array<string>")).when(F.col("prev_last") == F.col("a"), F.array(F.concat(F.lit(">"), "node"))).otherwise(F.array(F.concat(F.lit("<"), "node")))
    by = Window.partitionBy("read").orderBy("rstart", "rend", "first", "last")
    islands = joined.withColumn("_p", F.concat(through, "path")).withColumn("_i", F.sum(F.col("node").isNull().cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    grouped = islands.groupBy("read", "_i").agg(F.min("rstart").alias("rstart"), F.max("rend").alias("rend"), F.array_sort(F.collect_list(F.struct("rstart", "rend", "_p"))).alias("s"))
    return grouped.select("read", "rstart", "rend", F.flatten(F.transform("s", lambda x: x["_p"])).alias("path"))


def haplotype_gaps(nodes: DataFrame, graph: DataFrame, support: DataFrame) -> DataFrame:
    """(tip, behind, other): dead ends beside a sister branch that goes on to `behind`.

    The tip and its sister `other` follow the same node; only the sister has a follower. support (tip,
    behind, n) counts reads that go from the tip to that follower; the best supported one is taken.
    """
    dead = graph_tips(nodes, graph).select(F.col("end").alias("tip"))
    before = graph.select(F.col("u").alias("shared"), F.col("v").alias("tip")).join(dead, "tip")
    sister = graph.select(F.col("u").alias("shared"), F.col("v").alias("other"))
    onward = graph.select(F.col("u").alias("other"), F.col("v").alias("behind"))
    found = before.join(sister, "shared").where("tip <> other").join(onward, "other").select("tip", "other", "behind").distinct()
    ranked = found.join(support, ["tip", "behind"]).withColumn("_r", F.row_number().over(Window.partitionBy("tip").orderBy(F.col("n").desc(), "behind", "other")))
    return ranked.where("_r = 1").drop("_r")


def cut_places(alignments: DataFrame, nodes: DataFrame, graph: DataFrame, least: int, window: int, from_end: int = 1000) -> DataFrame:
    """(node, at): where at least `least` reads jump between places inside nodes.

    Jumps between consecutive alignments are clustered by both places; a cluster's upper-median
    places are cuts unless they are near an end, inside an overlap, or at most one base behind the cut before.
    """
    both = consecutive(with_ends(alignments), "read", ["rstart", "rend", "first", "last"], ["last", "rclip"]).where("prev_last IS NOT NULL")
    length = nodes.select(F.col("node").alias("_n"), F.col("length").alias("_len"))
    both = both.join(length, P.bare(F.col("prev_last")) == F.col("_n")).withColumn("_la", F.col("_len")).drop("_n", "_len")
    both = both.join(length, P.bare(F.col("first")) == F.col("_n")).withColumn("_lb", F.col("_len")).drop("_n", "_len")
    out_at = F.when(F.col("prev_last").startswith(">"), F.col("_la") - F.col("prev_rclip")).otherwise(F.col("prev_rclip"))
    in_at = F.when(F.col("first").startswith(">"), F.col("lclip")).otherwise(F.col("_lb") - F.col("lclip"))
    key = P.canonical_ends(F.col("prev_last"), P.flipped(F.col("first")))
    same = key[0] == F.col("prev_last")
    pairs = both.select(key[0].alias("x"), key[1].alias("y"), F.when(same, out_at).otherwise(in_at).alias("pa"), F.when(same, in_at).otherwise(out_at).alias("pb"))
    counted = pairs.groupBy(F.concat_ws(",", "x", "y").alias("key"), "pa", "pb").agg(F.count(F.lit(1)).alias("n"), F.first("x").alias("x"), F.first("y").alias("y"))
    clusters = counted.join(position_clusters(counted, window), ["key", "pa", "pb"]).groupBy("key", "cluster", "x", "y", "mid_a", "mid_b").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    cuts = clusters.select(P.bare(F.col("x")).alias("node"), F.col("mid_a").alias("at")).union(clusters.select(P.bare(F.col("y")), "mid_b")).distinct()
    over = graph.groupBy("u").agg(F.max("overlap").alias("o"))
    cuts = cuts.join(nodes.select("node", "length"), "node")
    cuts = cuts.join(over.select(F.col("u").alias("_u"), F.col("o").alias("left")), F.concat(F.lit("<"), "node") == F.col("_u"), "left").drop("_u")
    cuts = cuts.join(over.select(F.col("u").alias("_u"), F.col("o").alias("right")), F.concat(F.lit(">"), "node") == F.col("_u"), "left").drop("_u")
    fine = (F.col("at") >= from_end) & (F.col("at") <= F.col("length") - 1 - from_end) & (F.col("at") > F.coalesce("left", F.lit(0))) & (F.col("at") < F.col("length") - F.coalesce("right", F.lit(0)))
    kept = cuts.where(fine).withColumn("_run", F.col("at") - F.row_number().over(Window.partitionBy("node").orderBy("at")))
    # Of a run of neighbouring places every second one, from the first, is more than one behind the last kept.
    place = F.row_number().over(Window.partitionBy("node", "_run").orderBy("at"))
    return kept.withColumn("_k", place).where("_k % 2 = 1").select("node", "at")


def cut_nodes(nodes: DataFrame, cuts: DataFrame) -> DataFrame:
    """(node, piece, start, end): nodes in pieces between their cuts, named node_cut1, node_cut2, ..."""
    places = cuts.groupBy("node").agg(F.array_sort(F.collect_list("at")).alias("at"))
    both = nodes.join(places, "node").withColumn("_from", F.concat(F.array(F.lit(0).cast("long")), F.col("at").cast("array<bigint>"))).withColumn("_to", F.concat(F.col("at").cast("array<bigint>"), F.array(F.col("length").cast("long"))))
    return both.select("node", F.posexplode(F.arrays_zip("_from", "_to")).alias("i", "z")).select("node", F.concat("node", F.lit("_cut"), F.col("i") + 1).alias("piece"), F.col("z._from").alias("start"), F.col("z._to").alias("end"))
