"""The driver's tables as the relations that the operators work on, in Spark and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K = 9


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bases(text: str) -> F.Column:
    return F.regexp_replace(F.upper(text), "[^ACGT]", "")


def seqs(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select(F.col("doc_id").alias("id"), _bases("text").alias("seq"))


def marker_seqs(spark: SparkSession, sf: str) -> DataFrame:
    """(label 1 or 2, seq): even and odd benchmark items."""
    return read(spark, sf, "benchmark").select((F.col("item_id") % 2 + 1).cast("int").alias("label"), _bases("text").alias("seq"))


def paths(spark: SparkSession, sf: str) -> DataFrame:
    """(user_id, day, path): a user's day as a walk over event types, in order of time."""
    e = read(spark, sf, "events")
    step = F.concat(F.when(F.col("value") >= 50, F.lit(">")).otherwise(F.lit("<")), "event_type")
    grouped = e.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", step.alias("step")))).alias("s"))
    return grouped.select("user_id", "day", F.transform("s", lambda x: x["step"]).alias("path"))


def cov(spark: SparkSession, sf: str) -> DataFrame:
    """(node, coverage, length, brand): parts, covered by their sold quantities."""
    sums = read(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    p = read(spark, sf, "part").select("p_partkey", "p_size", "p_brand")
    return p.join(sums, F.col("p_partkey") == F.col("l_partkey")).select(F.col("p_partkey").cast("string").alias("node"), (F.col("q") / F.col("p_size")).alias("coverage"), (F.col("p_size") * 1000).cast("long").alias("length"), F.col("p_brand").alias("brand"))


def ivals(spark: SparkSession, sf: str) -> DataFrame:
    """(key, owner, s, e): ship dates and quantities as intervals on parts, owned by suppliers."""
    s = F.datediff("l_shipdate", F.lit("1992-01-01"))
    return read(spark, sf, "lineitem").select(F.col("l_partkey").alias("key"), F.col("l_suppkey").alias("owner"), s.cast("long").alias("s"), (s + F.col("l_quantity").cast("int")).cast("long").alias("e"))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("node"))


def links(spark: SparkSession, sf: str) -> DataFrame:
    """(a, b): p<part> - s<supplier>, a sparse graph of many components."""
    rows = read(spark, sf, "lineitem").where("l_quantity >= 50 AND l_discount >= 0.09")
    return rows.select(F.concat(F.lit("p"), "l_partkey").alias("a"), F.concat(F.lit("s"), "l_suppkey").alias("b")).distinct()


def all_links(spark: SparkSession, sf: str) -> DataFrame:
    """(a, b): as links, of all rows: one component, with a hub for each supplier."""
    return read(spark, sf, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("a"), F.concat(F.lit("s"), "l_suppkey").alias("b")).distinct()


def placements(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("contig"), F.col("l_extendedprice").alias("score"))


SEQS = r"seqs AS (SELECT doc_id AS id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS seq FROM documents)"
MARKERS = r"marker_seqs AS (SELECT CAST(item_id % 2 + 1 AS INTEGER) AS label, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS seq FROM benchmark)"
PATHS = """paths AS (
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
    list(CASE WHEN value >= 50 THEN '>' ELSE '<' END || event_type ORDER BY ts, event_id) AS path
  FROM events GROUP BY user_id, strftime(ts, '%Y-%m-%d'))"""
FLIP = "(CASE WHEN {0}[1] = '>' THEN '<' ELSE '>' END || {0}[2:])"
COV = """cov AS (
  SELECT CAST(p_partkey AS VARCHAR) AS node, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / p_size AS coverage,
    CAST(p_size * 1000 AS BIGINT) AS length, p_brand AS brand
  FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey, p_size, p_brand)"""
IVALS = """ivals AS (
  SELECT l_partkey AS key, l_suppkey AS owner, date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS s,
    date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS INTEGER) AS e
  FROM lineitem)"""
LINKS = """links AS (SELECT DISTINCT 'p' || l_partkey AS a, 's' || l_suppkey AS b FROM lineitem WHERE l_quantity >= 50 AND l_discount >= 0.09)"""
