"""A map of homology between whole sequences from sketches, without alignment.

Queries are cut into windows. A window's sketch is its sampled k-mers; the target places of these are gathered
in bins of a window's length, each place in two bins half a length apart, so that whatever lies within half a length of each other shares
a bin. The share of the sketch found in a bin is how much of the window is there. A k-mer survives only if none of its bases
changed, and is still a sample if about half of the w k-mers around it are as they were, so the root of degree k + (w - 1) / 2 of the share estimates the
identity: within 0.03 of that of an alignment down to 0.9 in the tests. Windows that follow each other on one diagonal are merged.

K-mers on more than `most` places of the targets are left out before the join and count for no window's sketch. Sequences shorter
than a window are one window; those without samples, nulls and empty ones have no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from .building import samples


def window_hits(queries: DataFrame, targets: DataFrame, k: int, w: int, length: int, most: int, identity: float) -> DataFrame:
    """(query, window, target, strand, qstart, qend, tstart, tend, identity): of each window the bin of each target and strand with the largest share of its sketch."""
    ours = samples(queries.withColumnRenamed("query", "read"), k, w, compress=False)
    theirs = samples(targets.withColumnRenamed("target", "read"), k, w, compress=False).select(P.bare(F.col("step")).alias("kmer"), F.col("read").alias("target"), F.col("pos").alias("t"), F.col("step").startswith(">").alias("tf"))
    over = theirs.groupBy("kmer").count().where(F.col("count") > most).select("kmer")
    theirs = theirs.join(over, "kmer", "left_anti")
    marks = ours.select(F.col("read").alias("query"), F.floor(F.col("pos") / length).alias("window"), F.col("pos").alias("q"), P.bare(F.col("step")).alias("kmer"), F.col("step").startswith(">").alias("qf"))
    marks = marks.join(over, "kmer", "left_anti")
    sketch = marks.groupBy("query", "window").agg(F.count_distinct("kmer").alias("sketch"))
    both = marks.join(theirs, "kmer").withColumn("strand", F.when(F.col("qf") == F.col("tf"), F.lit("+")).otherwise(F.lit("-")))
    bins = F.array(F.floor(F.col("t") / length) * 2, F.floor((F.col("t") + length / 2) / length) * 2 - 1)
    shared = both.withColumn("bin", F.explode(bins)).groupBy("query", "window", "target", "strand", "bin").agg(
        F.count_distinct("kmer").alias("shared"), F.min("q").alias("qstart"), (F.max("q") + k).alias("qend"), F.min("t").alias("tstart"), (F.max("t") + k).alias("tend")
    )
    found = shared.join(sketch, ["query", "window"]).withColumn("identity", F.pow(F.col("shared") / F.col("sketch"), F.lit(1.0 / (k + (w - 1) / 2)))).where((F.col("identity") >= identity) & (F.col("shared") >= 3))
    # a neighbouring bin holds part of the same places; the better of two is the window's
    near = Window.partitionBy("query", "window", "target", "strand").orderBy("bin")
    better = lambda d: F.when(F.abs(d("bin") - F.col("bin")) <= 1, F.struct(d("shared"), -d("bin")) > F.struct(F.col("shared"), -F.col("bin"))).otherwise(F.lit(False))
    worse = F.coalesce(better(lambda c: F.lag(c).over(near)), F.lit(False)) | F.coalesce(better(lambda c: F.lead(c).over(near)), F.lit(False))
    return found.withColumn("_worse", worse).where("NOT _worse").select("query", "window", "target", "strand", "qstart", "qend", "tstart", "tend", "identity")


def merged_hits(hits: DataFrame, length: int) -> DataFrame:
    """The hits of windows that follow each other (one may be missing) on about one diagonal, as one row with their mean identity by length."""
    diagonal = F.when(F.col("strand") == "+", F.col("tstart") - F.col("qstart")).otherwise(F.col("tstart") + F.col("qend"))
    rows = hits.withColumn("_d", diagonal).withColumn("_band", F.floor((F.col("_d") + length / 2) / length))
    # hits are taken in order of their diagonals' bands first, so those of another copy of the query's part don't come between
    by = Window.partitionBy("query", "target", "strand").orderBy("_band", "window", "tstart")
    apart = (F.col("_band") - F.lag("_band").over(by) > 0) | (F.col("window") - F.lag("window").over(by) > 2) | (F.abs(F.col("_d") - F.lag("_d").over(by)) > length / 2)
    rows = rows.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("_run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    size = F.col("qend") - F.col("qstart")
    return rows.groupBy("query", "target", "strand", "_run").agg(
        F.min("qstart").alias("qstart"), F.max("qend").alias("qend"), F.min("tstart").alias("tstart"), F.max("tend").alias("tend"), (F.sum(F.col("identity") * size) / F.sum(size)).alias("identity"), F.count(F.lit(1)).alias("windows")
    ).drop("_run")


def homology_map(queries: DataFrame, targets: DataFrame, k: int = 16, w: int = 10, length: int = 1000, most: int = 1000, identity: float = 0.8, least: int = 0) -> DataFrame:
    """(query, qlen, qstart, qend, strand, target, tlen, tstart, tend, identity, windows) of queries (query, seq) on targets (target, seq), at least so long on the query."""
    found = merged_hits(window_hits(queries, targets, k, w, length, most, identity), length).where(F.col("qend") - F.col("qstart") >= least)
    out = found.join(queries.select("query", F.length("seq").alias("qlen")), "query").join(targets.select("target", F.length("seq").alias("tlen")), "target")
    return out.select("query", "qlen", "qstart", "qend", "strand", "target", "tlen", "tstart", "tend", "identity", "windows")
