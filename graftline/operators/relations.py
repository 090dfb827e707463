"""Joins, ranks and grouped filters on reads, contacts, placements and names."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import sequences as S
from .iterate import components, hinted, saved


def upper_median(values: Column) -> Column:
    """The value in the upper middle of an array."""
    return F.element_at(F.array_sort(values), F.floor(F.size(values) / 2).cast("int") + 1)


def members_only(rows: DataFrame, names: DataFrame, column: str, invert: bool = False) -> DataFrame:
    """Rows whose column is (or is not) in names (name)."""
    return rows.join(names.select(F.col("name").alias("_name")).distinct(), F.col(column) == F.col("_name"), "left_anti" if invert else "left_semi")


def paths_with(rows: DataFrame, names: DataFrame, invert: bool = False, key: str = "read", path: str = "path") -> DataFrame:
    """Alignments with (or without) a node of names (name) anywhere in their path."""
    hits = rows.select(key, path, F.explode(path).alias("_step")).withColumn("_node", P.bare(F.col("_step")))
    hits = hits.join(names.select(F.col("name").alias("_node")).distinct(), "_node", "left_semi").select(key, path).distinct()
    return rows.join(hits, [key, path], "left_anti" if invert else "left_semi")


def well_aligned(rows: DataFrame, mapq: int = 20, share: float = 0.0) -> DataFrame:
    """Alignments (rstart, rend, rlen, mapq) of that quality over at least that share of the read."""
    return rows.where((F.col("mapq") >= mapq) & (F.col("rend") - F.col("rstart") >= F.col("rlen") * share))


def near_end_reads(rows: DataFrame, distance: int, mapq: int = 20) -> DataFrame:
    """Distinct reads that align within `distance` of an end of their path."""
    return rows.where((F.col("mapq") >= mapq) & ((F.col("pstart") < distance) | (F.col("pend") + distance > F.col("plen")))).select("read").distinct()


def unused_reads(candidates: DataFrame, used: DataFrame, cut_nodes: DataFrame) -> DataFrame:
    """Candidate alignments of reads that were not used and that touch no cut node."""
    free = candidates.join(used.select("read").distinct(), "read", "left_anti")
    return paths_with(free, cut_nodes, invert=True)


def consecutive(rows: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """rows with the columns of the row before within the key, null for the first."""
    by = Window.partitionBy(key).orderBy(*order)
    return rows.select("*", *[F.lag(c).over(by).alias(prefix + c) for c in columns])


def gap_lengths(alignments: DataFrame, max_clip: int = 100) -> DataFrame:
    """(read, a, b, gap): ends that meet between consecutive alignments (read, rstart, rend, first, last, lclip, rclip) of a read.

    Alignments that begin where the one before begins, or end no later, make no gap; nor do long
    clips and meetings of a node with itself.
    """
    both = consecutive(alignments, "read", ["rstart", "rend", "first", "last"], ["rstart", "rend", "last", "rclip"])
    both = both.where("prev_rstart IS NOT NULL AND rstart <> prev_rstart AND rend > prev_rend").where((F.col("prev_rclip") <= max_clip) & (F.col("lclip") <= max_clip))
    ends = P.canonical_ends(F.col("prev_last"), P.flipped(F.col("first")))
    gap = (F.col("rstart") - F.col("lclip")) - (F.col("prev_rend") + F.col("prev_rclip"))
    return both.where(P.bare(F.col("prev_last")) != P.bare(F.col("first"))).select("read", ends[0].alias("a"), ends[1].alias("b"), gap.alias("gap"))


def supported_gaps(gaps: DataFrame, least: int) -> DataFrame:
    """(a, b, gap, support): the upper median length of gaps with enough reads."""
    return gaps.groupBy("a", "b").agg(upper_median(F.collect_list("gap")).alias("gap"), F.count(F.lit(1)).alias("support")).where(F.col("support") >= least)


def within_read_pairs(rows: DataFrame, read: str = "read", node: str = "node") -> DataFrame:
    """Distinct pairs a < b of nodes that a read touches."""
    own = rows.select(read, node).distinct()
    other = own.select(F.col(read).alias("_read"), F.col(node).alias("b"))
    return own.join(other, (F.col(read) == F.col("_read")) & (F.col(node) < F.col("b"))).select(F.col(read).alias("read"), F.col(node).alias("a"), "b")


def contact_weights(pairs: DataFrame) -> DataFrame:
    """(a, b, w) with a <= b: summed weights of contacts in either order."""
    return pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("w").alias("w"))


def filtered_contacts(contacts: DataFrame, homology: DataFrame) -> DataFrame:
    """Contacts (a, b, ca, cb) without those where both places lie in one homologous interval pair (a, b, as, ae, bs, be)."""
    h = homology.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "as", "ae", "bs", "be")
    inside = (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")) & F.col("ca").between(F.col("as"), F.col("ae")) & F.col("cb").between(F.col("bs"), F.col("be"))
    return contacts.where("a <> b").join(h, inside, "left_anti")


def bucketed_contacts(contacts: DataFrame, width: int = 40_000) -> DataFrame:
    """Contacts (a, b, ca, cb, w) with places rounded to the nearest multiple of width, summed."""
    near = lambda c: (F.floor((F.col(c) + width // 2) / width) * width).cast("long").alias(c)
    return contacts.select("a", "b", near("ca"), near("cb"), "w").groupBy("a", "b", "ca", "cb").agg(F.sum("w").alias("w"))


def best_with_ties(rows: DataFrame, key: str, score: str) -> DataFrame:
    """Rows with their key's best score, all of them where they tie."""
    return rows.withColumn("_r", F.rank().over(Window.partitionBy(key).orderBy(F.col(score).desc()))).where("_r = 1").drop("_r")


def hashed_choice(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One of each key's rows, chosen by a hash of the key: repeatable, in place of a random draw."""
    by = Window.partitionBy(key)
    numbered = rows.withColumn("_i", F.row_number().over(by.orderBy(*order)) - 1).withColumn("_n", F.count(F.lit(1)).over(by))
    return numbered.where(F.col("_i") == F.pmod(F.xxhash64(F.col(key)), F.col("_n"))).drop("_i", "_n")


def best_and_second(rows: DataFrame, key: str, candidate: str, score: str) -> DataFrame:
    """(key, best, best_score, second_score, ratio): ties go to the smaller candidate; no second gives a null ratio."""
    by = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(candidate))
    top = rows.withColumn("_r", F.row_number().over(by)).where("_r <= 2")
    pick = lambda c, r: F.max(F.when(F.col("_r") == r, F.col(c)))
    out = top.groupBy(key).agg(pick(candidate, 1).alias("best"), pick(score, 1).alias("best_score"), pick(score, 2).alias("second_score"))
    return out.withColumn("ratio", F.col("best_score") / F.nullif(F.col("second_score"), F.lit(0)))


def mutual_best(scores: DataFrame) -> DataFrame:
    """Pairs (a, b, w) that are each other's strictly best partner, a < b; ties void a side."""
    sides = scores.select(F.col("a").alias("x"), F.col("b").alias("y"), "w").union(scores.select("b", "a", "w"))
    top = sides.groupBy("x").agg(F.max("w").alias("_top"))
    best = sides.join(top, "x").where("w = _top").groupBy("x").agg(F.count(F.lit(1)).alias("_n"), F.min("y").alias("y"), F.min("w").alias("w")).where("_n = 1")
    back = best.select(F.col("x").alias("_y"), F.col("y").alias("_x"))
    return best.join(back, (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y"))).where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b"), "w")


def copy_guard(rows: DataFrame, key: str, most: int) -> DataFrame:
    """Rows of keys that occur at most so often; the keys over the limit are counted before any join."""
    over = rows.groupBy(key).count().where(F.col("count") > most).select(F.col(key).alias("_k"))
    return rows.join(over, F.col(key) == F.col("_k"), "left_anti")


def identity_spread(rows: DataFrame, key: str = "read", value: str = "idy") -> DataFrame:
    """(key, median, mad): the median and the mean absolute deviation from the mean."""
    mean = rows.withColumn("_mean", F.avg(value).over(Window.partitionBy(key)))
    return mean.groupBy(key).agg(F.median(value).alias("median"), F.avg(F.abs(F.col(value) - F.col("_mean"))).alias("mad"))


def near_own_identity(rows: DataFrame, deviations: float = 1.5, key: str = "read", value: str = "idy") -> DataFrame:
    """Rows not further below their read's median identity than so many deviations."""
    return rows.join(identity_spread(rows, key, value), key).where(F.col(value) >= F.col("median") - deviations * F.col("mad")).drop("median", "mad")


def majority_side(weights: DataFrame, ratio: float = 2.5) -> DataFrame:
    """(node, side): of weights (node, side 0 or 1, w), the side that outweighs the other by the ratio, else 2."""
    w = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("w"))), F.lit(0))
    sums = weights.groupBy("node").agg(w(0).alias("w0"), w(1).alias("w1"))
    return sums.withColumn("side", F.when(F.col("w0") > F.col("w1") * ratio, 0).when(F.col("w1") > F.col("w0") * ratio, 1).otherwise(2))


def renamed(rows: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """rows with their name replaced by names (old, new), by itself where there is none."""
    return rows.join(names.select(F.col("old").alias("_old"), F.col("new").alias("_new")), F.col(column) == F.col("_old"), "left").withColumn(column, S.replaced_name(F.col(column), F.col("_new"))).drop("_old", "_new")


def containing(sequences: DataFrame, patterns: DataFrame, k: int = 15) -> DataFrame:
    """(id, pattern): sequences (id, seq) that contain patterns (pattern, pseq) of at least k characters.

    A pattern's first k characters find the candidates by an equality join.
    """
    seeds = sequences.select("id", F.explode(F.array_distinct(F.flatten(S.windows(F.array("seq"), k)))).alias("seed"))
    found = patterns.where(F.length("pseq") >= k).withColumn("seed", F.substring("pseq", 1, k)).join(seeds, "seed")
    return found.join(sequences, "id").where(F.contains("seq", "pseq")).select("id", "pattern").distinct()


def next_on_reference(places: DataFrame) -> DataFrame:
    """(a, b): pairs of placements (name, ref, s, e) that follow each other on a reference with none wholly in between."""
    by = Window.partitionBy("ref").orderBy("s", "e", "name")
    return places.select(F.col("name").alias("a"), F.lead("name").over(by).alias("b"), "ref", F.col("e").alias("_e"), F.lead("s").over(by).alias("_s")).where("b IS NOT NULL").select("ref", "a", "b", (F.col("_s") - F.col("_e")).alias("distance"))


def chunked(rows: DataFrame, size: str, order: Sequence[str], limit: int, buckets: int = 1024) -> DataFrame:
    """rows with `chunk`: the running sum of sizes over the limit, whole.

    The sum runs in two levels, over buckets of the hashed first order column and inside them, so
    no task sees all rows; the order is by bucket and then `order`.
    """
    placed = rows.withColumn("_b", F.pmod(F.xxhash64(order[0]), F.lit(buckets)))
    sums = placed.groupBy("_b").agg(F.sum(size).alias("_sum"))
    before = sums.select(F.col("_b").alias("_bb"), F.coalesce(F.sum("_sum").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum(size).over(Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("_in", inside).join(F.broadcast(before), F.col("_b") == F.col("_bb")).withColumn("chunk", F.floor((F.col("_before") + F.col("_in")) / limit)).drop("_b", "_bb", "_in", "_before")


def chunked_by_range(rows: DataFrame, size: str, order: str, limit: int) -> DataFrame:
    """rows with `chunk`: the whole part of the running sum before a row, in order, over the limit.

    Rows are dealt out by ranges; sums of the ranges, one row each, carry over.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = saved(rows.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy("_part").agg(F.sum(size).alias("_sum"))
    before = sums.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum(size).over(Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranged.withColumn("_in", inside).join(F.broadcast(before), F.col("_part") == F.col("_p")).withColumn("chunk", F.floor((F.col("_before") + F.col("_in")) / limit)).drop("_part", "_p", "_in", "_before")


def greedy_chunks(rows: DataFrame, size: str, order: Sequence[str], limit: int) -> DataFrame:
    """rows of one file with `chunk`: a chunk closes once it exceeds the limit. One ordered pass, for files only."""

    def run(batches):
        chunk, held = 0, 0
        for batch in batches:
            numbers = []
            for n in batch[size]:
                numbers.append(chunk)
                held += n
                if held > limit:
                    chunk, held = chunk + 1, 0
            yield batch.assign(chunk=pd.Series(numbers, index=batch.index, dtype="int64"))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", chunk long"
    return rows.repartition(1).sortWithinPartitions(*order).mapInPandas(run, schema)


def position_clusters(pairs: DataFrame, window: int = 100) -> DataFrame:
    """pairs (key, pa, pb) with `cluster` and its upper-median places: links between pairs close in both places make clusters.

    Each pair is linked with the pairs behind it in order of pa that both windows hold, by grid cells, and
    clusters are the components.
    """
    rows = pairs.select("key", "pa", "pb").distinct()
    rows = rows.withColumn("id", F.concat_ws("/", "key", "pa", "pb"))
    cell = lambda c: F.floor(F.col(c) / window)
    left = rows.select("key", F.col("id").alias("a"), F.col("pa").alias("x1"), F.col("pb").alias("y1"), cell("pa").alias("_i"), cell("pb").alias("_j"))
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    right = rows.select("key", F.col("id").alias("b"), F.col("pa").alias("x2"), F.col("pb").alias("y2"), cell("pa").alias("_i"), cell("pb").alias("_j")).withColumn("_o", around).withColumn("_i", F.col("_i") + F.col("_o.i")).withColumn("_j", F.col("_j") + F.col("_o.j")).drop("_o")
    links = left.join(right, ["key", "_i", "_j"]).where((F.col("a") < F.col("b")) & (F.abs(F.col("x1") - F.col("x2")) <= window) & (F.abs(F.col("y1") - F.col("y2")) <= window)).select("a", "b")
    label = components(links)
    named = rows.join(hinted(label), F.col("id") == F.col("node"), "left").withColumn("cluster", F.coalesce("label", "id"))
    mid = named.groupBy("key", "cluster").agg(upper_median(F.collect_list("pa")).alias("mid_a"), upper_median(F.collect_list("pb")).alias("mid_b"), F.count(F.lit(1)).alias("support"))
    return named.select("key", "pa", "pb", "cluster").join(mid, ["key", "cluster"])


def duplicate_ids(rows: DataFrame, column: str = "name") -> DataFrame:
    return rows.groupBy(column).count().where("count > 1")


def edge_multiplicity(paths: DataFrame, path: str = "path") -> DataFrame:
    """(a, b, n): how often each canonical edge is walked."""
    pairs = paths.select(F.explode(P.steps(F.col(path), 2)).alias("s"))
    edge = P.canonical_edge(F.col("s")[0], F.col("s")[1])
    return pairs.select(edge[0].alias("a"), edge[1].alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def triplet_support(paths: DataFrame, path: str = "path") -> DataFrame:
    """(a, m, b, n): how often a node m is passed from a to b, counted with m forward."""
    threes = paths.select(F.explode(P.steps(F.col(path), 3)).alias("s"))
    forward = F.when(F.col("s")[1].startswith(">"), F.col("s")).otherwise(P.reversed_path(F.col("s")))
    return threes.select(forward.alias("s")).groupBy(F.col("s")[0].alias("a"), F.col("s")[1].alias("m"), F.col("s")[2].alias("b")).agg(F.count(F.lit(1)).alias("n"))


def marker_counts(sequences: DataFrame, markers: DataFrame, k: int, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(id, label, hits): k-mers of both strands that are among markers (label, kmer)."""
    found = sequences.select(F.col(id_col).alias("id"), F.explode(S.both_strands(F.col(seq_col), k)).alias("kmer"))
    return found.join(markers.select("label", "kmer").distinct(), "kmer").groupBy("id", "label").agg(F.count(F.lit(1)).alias("hits"))


def prefix_consistent(paths: DataFrame, key: str = "node", path: str = "path") -> DataFrame:
    """(node, consistent): whether of any two of a node's paths one is a prefix of the other.

    That holds if every path is a prefix of the longest one.
    """
    longest = paths.groupBy(key).agg(F.max_by(path, F.struct(F.size(path), F.array_join(path, "\t"))).alias("_longest"))
    joined = paths.join(longest, key)
    return joined.groupBy(key).agg(F.min((F.slice(F.col("_longest"), F.lit(1), F.size(path)) == F.col(path)).cast("int")).alias("_ok")).select(key, (F.col("_ok") == 1).alias("consistent"))


def pair_prefilter(pairs: DataFrame, short: int = 10_000, ends: int = 10_000_000) -> DataFrame:
    """Read pairs that are worth clustering, of pairs with ref, pos, len, mapq, aligned and places, each for mate 1 and 2.

    `len` is the reference's length, `aligned` the aligned share of the read, `places` an array of (ref, pos, len) of its other
    placements. A pair needs mates that are mapped, to different references, each with half of its bases aligned, with a mapping
    quality or other places, and none of these on the mate's reference. If both mates have a mapping quality, that is enough. If not, no place of
    one may share a reference with one of the other, and each mate must have a place on a reference longer than `short`
    and a place that is less than `ends` away from both ends of its reference.
    """
    mapped = F.col("ref1").isNotNull() & F.col("ref2").isNotNull() & (F.col("ref1") != F.col("ref2"))
    more = {i: F.coalesce(F.col(f"places{i}"), F.array().cast(pairs.schema[f"places{i}"].dataType)) for i in (1, 2)}
    every = {i: F.concat(F.array(F.struct(F.col(f"ref{i}").alias("ref"), F.col(f"pos{i}").alias("pos"), F.col(f"len{i}").alias("len")).cast(pairs.schema[f"places{i}"].dataType.elementType)), more[i]) for i in (1, 2)}
    able = F.lit(True)
    apart = F.lit(True)
    for i, other in ((1, "ref2"), (2, "ref1")):
        able &= (F.col(f"aligned{i}") >= 0.5) & ((F.col(f"mapq{i}") > 0) | (F.size(more[i]) > 0)) & ~F.array_contains(F.transform(more[i], lambda x: x["ref"]), F.col(other))
        apart &= F.exists(every[i], lambda x: x["len"] > short) & F.exists(every[i], lambda x: (x["pos"] < ends) & (x["len"] - x["pos"] < ends))
    strangers = ~F.arrays_overlap(F.transform(every[1], lambda x: x["ref"]), F.transform(every[2], lambda x: x["ref"]))
    sure = (F.col("mapq1") > 0) & (F.col("mapq2") > 0)
    return pairs.where(mapped & able & (sure | (strangers & apart)))


def near_both_ends(pos: Column, length: Column, distance: int) -> Column:
    """Close to both ends at once, as in short nodes only."""
    return (pos < distance) & (length - pos < distance)
