"""Edge coverage over a stream of alignments: counts that grow as files of walks arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P
from ..operators.relations import edge_multiplicity

SCHEMA = "read string, path string, at timestamp"


def walk_stream(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """(read, path, at) of JSON lines that arrive in a folder."""
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_trigger).json(folder)
    return rows.withColumn("path", P.tokens(F.col("path")))


def edge_counts(walks: DataFrame) -> DataFrame:
    """(a, b, n): running counts of canonical edges; for update or complete output."""
    return edge_multiplicity(walks)


def windowed_edge_counts(walks: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window, a, b, n): counts by event time; rows later than the watermark allows are dropped by it."""
    steps = walks.withWatermark("at", late).select("at", F.explode(P.steps(F.col("path"), 2)).alias("s"))
    edge = P.canonical_edge(F.col("s")[0], F.col("s")[1])
    return steps.select("at", edge[0].alias("a"), edge[1].alias("b")).groupBy(F.window("at", window), "a", "b").agg(F.count(F.lit(1)).alias("n"))
