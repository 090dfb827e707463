"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graftline.operators.iterate import components, hinted, saved, shared_dir, small, written

__all__ = ["SPACE", "WORD", "components", "fresh", "hinted", "neighbours", "running_sum", "tidied", "saved", "shared_dir", "small", "table", "without", "word_count", "written"]

#: A word is a run of anything but ASCII white space; a space is a run of that.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as it takes to clash with no column of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, id_col: str, lost: DataFrame) -> DataFrame:
    """docs without the rows whose identifier is in the one column of `lost`; a null stays unless null is in it."""
    name = fresh(docs, "lost")
    return docs.join(hinted(lost.toDF(name)), F.col(id_col).eqNullSafe(F.col(name)), "left_anti")


def word_count(text: Column) -> Column:
    """Number of words; null counts as none. A word begins wherever the split leaves a non-empty part."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACE}|{SPACE}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: str, value: str, out: str) -> DataFrame:
    """Adds the sum of `value` over the rows before each row, in (bucket, order) order within its group.

    Two levels: sums by bucket first, then rows within one bucket; so a group that holds most
    rows is spread over its buckets. The order has to be total for the result to be repeatable.
    """
    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(c).alias(f"_{c}") for c in group], F.col(bucket).alias("_bucket"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group] + [F.col(bucket) == F.col("_bucket")]
    joined = rows.join(offsets, same, "left")
    return joined.withColumn(out, F.col("_offset") + F.col("_within")).drop(*[f"_{c}" for c in group], "_bucket", "_offset", "_within")


def neighbours(keys: DataFrame, order: Sequence[str], parts: int) -> DataFrame:
    """keys with `prev` and `next`: structs of the neighbouring rows' order columns, null at the ends.

    The rows are dealt out by ranges and kept in the shared folder with their range's number;
    only the first and last row of every range cross to a neighbour, one row for each range.
    """
    ranged = saved(keys.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    by, parts_by = Window.partitionBy("_part").orderBy(*order), Window.orderBy("_at")
    row = F.struct(*[F.col(c) for c in order])
    inner = ranged.withColumn("_next", F.lead(row).over(by)).withColumn("_prev", F.lag(row).over(by))
    ends = ranged.groupBy(F.col("_part").alias("_at")).agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
    across = ends.select("_at", F.lead("_first").over(parts_by).alias("_after"), F.lag("_last").over(parts_by).alias("_before"))
    joined = inner.join(F.broadcast(across), F.col("_part") == F.col("_at"), "left")
    return joined.withColumn("prev", F.coalesce("_prev", "_before")).withColumn("next", F.coalesce("_next", "_after")).drop("_part", "_at", "_next", "_prev", "_after", "_before")


def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; at their end a worker hands the memory that it has freed back to the system.

    Workers are used again for later stages, and what their allocators keep would add up.
    """
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)
