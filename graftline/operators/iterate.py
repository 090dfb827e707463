"""What iterative operators share: durable intermediate tables, size-checked broadcasts, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a few numbers that a join side may hold to be broadcast: 16 MB or so.
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; set here only for a local session without one."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="graftline-"))
    return sc.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder, so that a lost executor costs nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows as a compressed table in the shared folder: for what is too large to checkpoint as it is."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows; reads no more than are needed to tell."""
    return df.limit(most + 1).count() <= most


def hinted(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df for a join: broadcast if its counted size is small, shuffled if not."""
    return F.broadcast(df) if small(df, most) else df.hint("merge")


def numbered(rows: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """rows with their number in order, from 0. Rows are dealt out by ranges; only the sizes of the ranges, one row each, meet.

    The order has to be total for the numbers to be repeatable.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order)])
    ranged = saved(rows.withColumn("_order", key).repartitionByRange(parts, "_order").withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy(F.col("_part").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_at", F.coalesce(F.sum("_n").over(Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_order")) - 1
    joined = ranged.withColumn("_inside", inside).join(F.broadcast(before), F.col("_part") == F.col("_at"))
    return joined.withColumn(name, (F.col("_before") + F.col("_inside")).cast("long")).drop("_order", "_part", "_inside", "_at", "_before")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (a, b): the smallest node that it is connected with.

    Each round takes the smallest label among the neighbours, combined before the shuffle, and
    then the label of one's label; a hub's links meet one row of labels, never each other.
    """
    both = saved(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct())
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(hinted(labels.select(F.col("node").alias("b"), "label")), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        new = saved(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        parent = new.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = saved(new.join(hinted(parent), "label", "left").select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label")))
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels


def node_components(nodes: DataFrame, links: DataFrame, node: str = "node") -> DataFrame:
    """(node, component) for all nodes, those without a link in components of their own."""
    found = components(links).withColumnRenamed("label", "component")
    return nodes.select(F.col(node).alias("node")).distinct().join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
