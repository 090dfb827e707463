"""A store of read overlaps that lasts between sessions: a table dealt out by ranges of read numbers, sorted inside.

Each overlap stands with either of its reads first, so all overlaps of a read lie together. A slice of
read numbers reads the folders of its ranges only, and inside them what the sorted files' statistics leave over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Read numbers in one range.
SLICE_READS = 100_000


def mirrored(overlaps: DataFrame, turned: dict[str, Column] | None = None) -> DataFrame:
    """The overlaps (a, b, ...) and the same with b first; `turned` says what other columns are then (the same, if not)."""
    swapped = overlaps.withColumns({"a": F.col("b"), "b": F.col("a"), **(turned or {})})
    return overlaps.unionByName(swapped.select(overlaps.columns))


def write_overlaps(overlaps: DataFrame, path: str, order: Sequence[str] = ("a", "b"), slice_reads: int = SLICE_READS) -> None:
    """Writes (a, b, ...) with whole numbers for reads; one range of reads is one folder, a large one several files.

    Rows are dealt out by ranges of the order, so a read of very many overlaps is spread over tasks and its rows stay in order from file to file.
    """
    rows = overlaps.withColumn("slice", F.floor(F.col("a") / slice_reads).cast("long"))
    parts = max(1, int(overlaps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows.repartitionByRange(parts, "slice", *order).sortWithinPartitions("slice", *order).write.partitionBy("slice").parquet(path)


def overlaps_of(spark: SparkSession, path: str, low: int | None = None, high: int | None = None, slice_reads: int = SLICE_READS) -> DataFrame:
    """The overlaps of the reads low to high, both included; None is no bound. slice_reads as at writing."""
    rows = spark.read.parquet(path)
    if low is not None:
        rows = rows.where((F.col("slice") >= low // slice_reads) & (F.col("a") >= low))
    if high is not None:
        rows = rows.where((F.col("slice") <= high // slice_reads) & (F.col("a") <= high))
    return rows.drop("slice")
