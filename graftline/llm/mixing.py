"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are shuffled (by MD5 of the identifier) into one stream of words, played
twice because no source is taken more than twice. Streams are cut into blocks of equally many
words. Sources own consecutive cells on a line, as many as their target has blocks: these are
the cumulative weights. Van der Corput points (bit-reversed counters) visit the cells, each
once, which spreads every source's slots evenly over the schedule. Slots are ranked per source;
slot r takes block r of the source's stream, and the last slot of a source is cut where the
target is reached. What a document gives to the mix, and when, is read off its slots: `mix` tells the first slot of each
time that a document is taken, and `mixed` returns the documents in the order of the schedule, so any stretch of the
mix has the sources in about their target shares.

Scale: documents are read once, to (id, source, size). The running sum inside a source goes over
hash buckets in two levels, so a source with most rows is spread out. The table of sources holds
one row each. A slot has about BLOCK_WORDS words, or a SLOTS-th of the mix if that is less; the schedule has one row a slot.

Defined results: null text has size 0 and is taken 0 times; a null source is a source of its
own, last in order; null identifiers come first in their stream; rows that repeat
identifier, source and size are separate documents (`mixed` evens out the times of rows that repeat identifier and source);
other columns are not read and may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, hinted, running_sum, saved, table, word_count

WEIGHTS = (5, 2, 1)
#: The mix takes this share of all words, and of no source more than MOST times its size.
SHARE = (3, 2)
MOST = 2
SLOTS, BLOCK_WORDS = 4096, 1_000_000
#: Leading hex digits of the shuffle key that make a bucket of a source's stream.
BUCKET_DIGITS = 3


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """sizes (source, source_size) with sid, weight, target.

    Sharing the excess again and again until no source is above its limit is water-filling:
    in order of limit by weight, the first source that the remaining level does not fill ends
    the capped ones. All sums are of whole numbers; a target is one division.
    """
    everything = Window.partitionBy()
    up = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("sid", F.row_number().over(up)).withColumn("weight", w.cast("long"))
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), "sid")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    num, den = share
    s = s.withColumn("_k", F.row_number().over(filled))
    s = s.withColumn("_left", F.lit(num) * F.sum("source_size").over(everything) - F.lit(den * most) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    s = s.withColumn("_w", F.lit(den) * (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    free = F.col("_left") * F.col("weight") <= F.col("_w") * F.lit(most) * F.col("source_size")
    s = s.withColumn("_level", F.min(F.when(free, F.struct("_k", "_left", "_w"))).over(everything))
    level = (F.col("weight") * F.col("_level._left")).cast("double") / F.col("_level._w").cast("double")
    target = F.when(F.col("_level").isNull() | (F.col("_k") < F.col("_level._k")), (F.lit(most) * F.col("source_size")).cast("double")).otherwise(level)
    return s.withColumn("target", target).select("source", "sid", "weight", "source_size", "target")


def bit_reversed(x: Column, bits: Column) -> Column:
    """Van der Corput's permutation: the counter whose reversed bits are x."""
    return F.conv(F.reverse(F.expr("lpad(bin(_cell), _bits, '0')")), 2, 10).cast("long")


def schedule(targets: DataFrame, slots: int = SLOTS) -> DataFrame:
    """One row for each slot: sid, slot (its place in the order), block (its rank in the source), from, to (words of the stream)."""
    everything, before = Window.partitionBy(), Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    t = targets.withColumn("_words", F.floor("target"))
    words = F.sum("_words").over(everything)
    t = t.withColumn("block_words", F.greatest(F.lit(1), F.floor(words / F.greatest(F.lit(slots), F.ceil(words / F.lit(BLOCK_WORDS))))))
    t = t.withColumn("_n", F.ceil(F.col("_words") / F.col("block_words")))
    t = t.withColumn("_lo", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    t = t.withColumn("_bits", F.length(F.bin(F.greatest(F.lit(1), F.sum("_n").over(everything) - 1))))
    cells = t.where("_n > 0").withColumn("_cell", F.explode(F.expr("sequence(_lo, _lo + _n - 1)")))
    cells = cells.withColumn("slot", bit_reversed(F.col("_cell"), F.col("_bits")))
    rank = F.row_number().over(Window.partitionBy("sid").orderBy("slot")).cast("long") - 1
    ranked = cells.withColumn("block", rank)
    return ranked.select("sid", "slot", "_bits", "block", "block_words", (F.col("block") * F.col("block_words")).alias("from"), F.least(F.col("_words"), (F.col("block") + 1) * F.col("block_words")).alias("to"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS, slots: int = SLOTS) -> DataFrame:
    """One row for each row of docs: id, source, size, source_size, target, taken, slots (the first slot of each time that it is taken, null where it isn't; as shares of the schedule)."""
    rows = saved(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = saved(source_targets(sizes, weights))
    plan = schedule(targets, slots)
    names = targets.select(F.col("source").alias("_source"), "sid", "source_size", "target")
    keyed = rows.join(hinted(names), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    keyed = keyed.withColumn("_key", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")))
    keyed = keyed.withColumn("_b", F.substring("_key", 1, BUCKET_DIGITS))
    placed = running_sum(keyed, ["sid"], ["_key", "id", "size"], "_b", "size", "start")
    width = plan.groupBy().agg(F.max("block_words").alias("_block_words"))
    some = placed.where("size > 0").join(F.broadcast(width))
    twice = some.withColumn("_pass", F.explode(F.array(*[F.lit(p) for p in range(MOST)])))
    twice = twice.withColumn("_from", F.col("start") + F.col("_pass") * F.col("source_size")).withColumn("_to", F.col("_from") + F.col("size"))
    pieces = twice.withColumn("block", F.explode(F.expr("sequence(_from div _block_words, (_to - 1) div _block_words)")))
    taken = pieces.join(plan.drop("block_words"), ["sid", "block"])
    words = F.greatest(F.lit(0), F.least("_to", "to") - F.greatest("_from", "from"))
    place = F.col("slot") / F.pow(F.lit(2.0), F.col("_bits"))
    slots_of = F.array(*[F.min(F.when((F.col("_pass") == p) & (words > 0), place)) for p in range(MOST)])
    taken = taken.groupBy(F.col("sid").alias("_sid"), F.col("start").alias("_start")).agg(F.sum(words).alias("taken"), slots_of.alias("slots"))
    full = some.join(taken, (F.col("sid") == F.col("_sid")) & (F.col("start") == F.col("_start")), "left")
    names = ["id", "source", "size", "source_size", "target"]
    full = full.select(*names, F.coalesce("taken", F.lit(0)).alias("taken"), "slots")
    empty = keyed.where("size = 0").select(*names, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("array<double>").alias("slots"))
    return full.unionByName(empty)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs in the order of the schedule, every row as many times as the mix takes it whole, a part counted by rounding; columns unchanged.

    Each partition holds a stretch of the schedule, in order; documents without a word come last.
    """
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    found = mix(docs, id_col, text_col, source_col).select("id", "source", times.alias("times"), "slots")
    both = found.groupBy("id", "source").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("rows"), F.array(*[F.min(F.col("slots")[p]) for p in range(MOST)]).alias("slots"))
    both = saved(both)
    key, source, total, rows, slots, turn, copy, slot = (fresh(docs, n) for n in ("key", "of", "total", "rows", "slots", "turn", "copy", "slot"))
    joined = docs.join(hinted(both.toDF(key, source, total, rows, slots)), F.col(id_col).eqNullSafe(F.col(key)) & F.col(source_col).eqNullSafe(F.col(source)))
    if both.where("rows > 1").isEmpty():
        joined = joined.withColumn(turn, F.lit(0))
    else:  # rows that repeat identifier and source share what these take
        numbered = joined.where(F.col(rows) > 1).withColumn(turn, F.row_number().over(Window.partitionBy(key, source).orderBy(F.length(text_col), F.xxhash64(text_col))) - 1)
        joined = joined.where(F.col(rows) == 1).withColumn(turn, F.lit(0)).unionByName(numbered)
    own = F.floor(F.col(total) / F.col(rows)) + (F.col(turn) < F.col(total) % F.col(rows)).cast("int")
    out = joined.withColumn(copy, F.explode(F.when(own > 0, F.sequence(F.lit(0), own.cast("int") - 1))))
    out = out.withColumn(slot, F.coalesce(F.get(F.col(slots), F.col(copy)), F.lit(1.0)))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    stretch = F.least(F.floor(F.col(slot) * parts), F.lit(parts - 1)).cast("int")
    return out.repartitionById(parts, stretch).sortWithinPartitions(slot, id_col, copy).select(*docs.columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", F.array_min("slots").alias("first_slot"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM s),
w AS (SELECT *, CASE (sid - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM r),
k AS (
  SELECT *, row_number() OVER o AS k,
    3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
    2 * (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS wl
  FROM w WINDOW o AS (ORDER BY source_size / weight, sid)),
f AS (SELECT k, lft, wl FROM k WHERE lft * weight <= wl * 2 * source_size ORDER BY k LIMIT 1),
t AS (
  SELECT k.source, k.source_size,
    CASE WHEN f.k IS NULL OR k.k < f.k THEN CAST(2 * k.source_size AS DOUBLE)
         ELSE CAST(k.weight * f.lft AS DOUBLE) / CAST(f.wl AS DOUBLE) END AS target
  FROM k LEFT JOIN f ON true),
p AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, floor(t.target) AS goal,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (
  SELECT *, greatest(1, CAST(floor(words / greatest(4096, ceil(words / 1000000))) AS BIGINT)) AS width
  FROM (SELECT w.sid, CAST(floor(t.target) AS BIGINT) AS goal, sum(CAST(floor(t.target) AS BIGINT)) OVER () AS words FROM w JOIN t ON w.source IS NOT DISTINCT FROM t.source)),
n AS (SELECT sid, width, CAST(ceil(goal / width) AS BIGINT) AS n FROM b),
o AS (SELECT *, CAST(coalesce(sum(n) OVER (ORDER BY sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS lo, length(bin(greatest(1, CAST(sum(n) OVER () AS BIGINT) - 1))) AS bits FROM n),
c AS (SELECT sid, bits, unnest(range(lo, lo + n)) AS cell FROM o),
v AS (SELECT sid, CAST(list_sum(list_transform(range(bits), lambda i: ((cell >> i) & 1) << (bits - 1 - i))) AS DOUBLE) / (1 << bits) AS slot FROM c),
l AS (SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS block FROM v),
q AS (SELECT p.*, w.sid, n.width FROM p JOIN w ON p.source IS NOT DISTINCT FROM w.source JOIN n ON n.sid = w.sid),
u AS (
  SELECT doc_id, sid, width, unnest([a, source_size + a]) AS x, unnest([least(a + size, goal), least(source_size + a + size, goal)]) AS y FROM q WHERE size > 0),
z AS (SELECT u.doc_id, min(l.slot) AS first_slot FROM u JOIN l ON u.sid = l.sid AND l.block BETWEEN u.x // u.width AND (CAST(u.y AS BIGINT) - 1) // u.width WHERE u.y > u.x GROUP BY u.doc_id)
SELECT p.doc_id, size, source_size, target,
  CAST(greatest(0, least(a + size, goal) - a) + greatest(0, least(source_size + a + size, goal) - (source_size + a)) AS BIGINT) AS taken, first_slot
FROM p LEFT JOIN z ON p.doc_id = z.doc_id
"""
