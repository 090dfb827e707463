"""Exact duplicates by a tree-merge of sorted digest runs, in DataFrame operations only.

Rows fall into 2**levels runs by a hash of their identifier. A leaf run is sorted by digest and holds one entry for
each digest in it: the smallest identifier and the number of rows. Then runs are exchanged in
binomial rounds: in a round, the 2**bits runs whose numbers differ in the round's bits deal their entries out to each other by
the same bits of the digest. Each run receives as many sorted slices, which are merged in the order of digests; entries
with one digest become one, with the smallest identifier and the sum of the counts. After levels / bits rounds, a run's
number is the head of its digests, so no digest is in two runs, and no run is larger than its share of
the digests. A digest that a third of all rows share has one entry in each leaf run, and 2**bits times fewer after each round.

Verified: an entry's key is the SHA-256 digest together with the text's byte length and a second, independent
64-bit hash of the text; entries merge only when all three agree. At every level the number of rows is counted
again and each run is checked to hold a digest once (`checked`).

Defined results: null text counts as empty; a null identifier stays only where no row of its
group has one; rows that repeat both identifier and text are all reported as kept by `exact_groups`
and reduced to one by `exact_dedup`, the first by its other columns as text. Very long texts are only hashed. Other columns are not read
and may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, fresh, saved, table, without

KEY = ("digest", "n_bytes", "guard")
#: 2**LEVELS runs at least, and so many more that a run has about RUN_ROWS rows; merged 2**FAN_IN at a time.
LEVELS, FAN_IN, RUN_ROWS = 6, 3, 2_000_000


def normalised(text: Column) -> Column:
    """The text with every run of ASCII white space replaced by one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, n_bytes, guard) of every row: the only pass over the texts."""
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    return rows.select("id", F.unhex(F.sha2("norm", 256)).alias("digest"), F.octet_length("norm").alias("n_bytes"), F.xxhash64("norm").alias("guard"))


def levels_for(rows: int) -> int:
    """How many levels of runs so many rows take."""
    return max(LEVELS, (max(0, rows - 1) // RUN_ROWS).bit_length())


def leaf_rows(rows: DataFrame, levels: int) -> DataFrame:
    """rows with the run that they are dealt to by their identifier, and with home, the last run of their digest."""
    first = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    return rows.select("id", F.pmod(F.xxhash64("id"), F.lit(1 << levels)).cast("int").alias("run"), F.pmod(first, F.lit(1 << levels)).cast("int").alias("home"), *KEY)


def sorted_runs(entries: DataFrame) -> DataFrame:
    """The entries dealt out by run, every run in one partition and in the order of its digests."""
    return entries.repartition("run").sortWithinPartitions("run", *KEY, F.col("keep_id").asc_nulls_last())


def merge_runs(runs: DataFrame) -> DataFrame:
    """Sorted slices merged: of neighbouring entries with one digest the first, which has the smallest identifier, and the sum of their counts.

    Partitions and order are those of `sorted_runs`, so this is one pass over the merged slices without another exchange or sort.
    """
    same = Window.partitionBy("run", *KEY)
    ordered = same.orderBy(F.col("keep_id").asc_nulls_last())
    ranked = runs.withColumn("turn", F.row_number().over(ordered)).withColumn("n", F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return ranked.where("turn = 1").drop("turn")


def checked(runs: DataFrame, level: int, rows: int) -> DataFrame:
    """The runs, if they hold all rows and each digest once in a run; a fault in a level shows here and not in the result."""
    told = runs.groupBy("run", "digest").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("m")).agg(F.sum("n"), F.max("m")).first()
    if (told[0] or 0) != rows or (told[1] or 1) > 1:
        raise RuntimeError(f"level {level} holds {told[0]} of {rows} rows, a digest {told[1]} times")
    return runs


def tree_merge(rows: DataFrame, levels: int, fan_in: int) -> tuple[DataFrame, DataFrame]:
    """The leaf runs and the last ones, over the columns run, home, KEY, keep_id, n."""
    total = rows.count()
    leaves = rows.groupBy("run", "home", *KEY).agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    leaves = checked(saved(leaves), 0, total)
    runs, done = leaves, 0
    while done < levels:
        step = min(fan_in, levels - done)
        bits = ((1 << step) - 1) << done
        partner = F.col("run").bitwiseAND(F.lit(~bits)).bitwiseOR(F.col("home").bitwiseAND(F.lit(bits)))
        runs, done = merge_runs(sorted_runs(runs.withColumn("run", partner))), done + step
        runs = checked(saved(runs), done, total)
    return leaves, runs


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", levels: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """One row for every row of docs: id, keep_id, group_size, kept, digest. Without `levels` there are as many as the counted rows take.

    The result travels down the way it came up: from the last runs to the leaf runs, then from
    each leaf run to its own rows, so no join key has more than 2**levels entries or one
    leaf's share of a group.
    """
    found = saved(digests(docs, id_col, text_col))
    levels = levels_for(found.count()) if levels is None else levels
    rows = leaf_rows(found, levels)
    leaves, last = tree_merge(rows, levels, fan_in)
    last = last.select(*KEY, F.col("keep_id").alias("root_id"), F.col("n").alias("group_size"))
    down = leaves.select("run", *KEY).join(last, list(KEY))
    out = rows.join(down, ["run", *KEY])
    return out.select("id", F.col("root_id").alias("keep_id"), "group_size", F.col("id").eqNullSafe(F.col("root_id")).alias("kept"), "digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows whose text an earlier identifier has; columns unchanged."""
    groups = saved(exact_groups(docs, id_col, text_col).select("id", "kept", F.lower(F.hex("digest")).alias("digest")))
    # An identifier may stand on several rows; it is lost only together with its text.
    twice = saved(groups.groupBy("id").count().where("count > 1").select("id"))
    lost = groups.where("NOT kept").select("id")
    if twice.isEmpty():
        return without(docs, id_col, lost)
    single = without(docs, id_col, lost.union(twice).distinct())
    name, digest, own, turn = (fresh(docs, n) for n in ("twice", "digest", "own", "turn"))
    repeated = docs.join(twice.toDF(name), F.col(id_col).eqNullSafe(F.col(name)), "left_semi").withColumn(own, F.sha2(normalised(F.col(text_col)), 256))
    kept = groups.where("kept").select("id", "digest").distinct().toDF(name, digest)
    marked = repeated.join(kept, F.col(id_col).eqNullSafe(F.col(name)) & (F.col(own) == F.col(digest)), "left_semi")
    others = [F.col(c).cast("string").asc_nulls_last() for c in docs.columns if c != id_col]
    first = marked.withColumn(turn, F.row_number().over(Window.partitionBy(id_col, own).orderBy(*others))).where(F.col(turn) == 1)
    return single.unionByName(first.select(*docs.columns))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""
