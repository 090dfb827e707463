"""Document fingerprints by spot signatures, in DataFrame operations only.

A common word (an anchor) and the next CHAIN content words behind it make a signature; a
document's fingerprint is its set of signatures as hashes, in order. A text also takes chains of CHAIN words from every place,
or its whole words if there are fewer, so that short texts and texts in other languages can be told apart and found again too.
No signature depends on words far from it, so an edit changes only the signatures near it.
Likeness is the Jaccard index of two fingerprints.

`near_pairs` finds all pairs from a likeness on: equal fingerprints are one class, classes fall
into partitions by set length such that only neighbouring partitions can hold partners, the
rarest signatures of each set (as many as a partner must share one of) are joined inside those,
and lengths prune the pairs before exact Jaccard.

Defined results: null text counts as empty; texts without a word have the empty fingerprint,
which is as likely as 1 to another empty one and 0 to any other; rows that repeat identifier and
text count once in the order of documents and give equal results; very long texts are taken whole; other columns are not read and may have
any name; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import neighbours, saved, table

CHAIN = 2
HASH_BITS = 48
SIMILAR = 0.8
# The most frequent function words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which will with you "
    "als am auf aus bei das dem den der des die ein eine einem einen einer er es für im ist mit nach nicht sich sie sind so um und von war wie zu zum zur "
    "au aux avec ce ces dans du elle en est et il la le les leur mais ne nous ou par pas pour qu que qui sa se ses son sont sur un une vous "
    "al como con de del el ella ellos entre esta este fue hay las lo los más muy no para pero por sin sobre su sus también todo una unos y ya"
).split()


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def short_hash(*parts: Column) -> Column:
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The ordered set of signatures.

    The content words before an anchor are its position less the number of anchors before it,
    so each anchor finds its chain in the array of content words. Anchors with too few content
    words behind them are the last ones, so leaving them out changes no other's number.
    """
    common = lambda w: w.isin(*ANCHORS)
    # Lambdas are interpreted for every word: positions go through without structs, and chains without slices.
    behind = lambda w, i: [F.get(w, i + j) for j in range(chain)]

    def split(w: Column) -> Column:
        places = F.array_remove(F.transform(w, lambda x, i: F.when(common(x), i).otherwise(-1)), -1)
        return F.struct(w.alias("w"), places.alias("places"), F.filter(w, lambda x: ~common(x)).alias("content"))

    def chosen(s: Column) -> Column:
        w, content = s["w"], s["content"]
        full = F.filter(s["places"], lambda p, k: p - k <= F.size(content) - chain)
        found = F.transform(full, lambda p, k: short_hash(F.get(w, p), *behind(content, p - k)))
        starts = F.slice(w, 1, F.greatest(F.lit(1), F.size(w) - chain + 1))
        return F.concat(found, F.transform(starts, lambda _, i: short_hash(*behind(w, i))))

    # Arrays of one element hand each step's result on, so that nothing is computed for every anchor anew.
    steps = F.array(words(text))
    for step in (split, chosen):
        steps = F.transform(steps, step)
    return F.sort_array(F.array_distinct(F.element_at(steps, 1)))


def fingerprint(signs: Column) -> Column:
    """The signatures as text: hexadecimal numbers with a space between."""
    return F.lower(F.array_join(F.transform(signs, F.hex), " "))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index; 1 for two empty sets."""
    union = F.size(F.array_union(a, b))
    both = F.size(a) + F.size(b) - union
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """(members: id, class_id) and (pairs: a, b, likeness) of classes, with a <= b and likeness of at least `similar`.

    A class, texts with one fingerprint, is named by its smallest identifier; two classes have one name where an identifier has two texts.
    """
    signed = docs.select(F.col(id_col).alias("id"), signatures(F.col(text_col)).alias("signs")).withColumn("key", F.sha2(fingerprint(F.col("signs")), 256))
    signed = saved(signed)
    classes = saved(signed.groupBy("key").agg(F.min("id").alias("class_id")))
    members = signed.select("id", "key").join(classes, "key").select("id", "class_id")
    sets = saved(signed.dropDuplicates(["key"]).select("key", "signs", F.size("signs").alias("n")).where("n > 0"))
    one = sets.select("key", "n", F.explode("signs").alias("s"))
    often = one.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    ordered = one.join(often, "s").groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("by_df"))
    head = F.slice("by_df", 1, (F.col("n") - F.ceil(F.col("n") * similar - 1e-9) + 1).cast("int"))
    part = F.floor(F.log(F.col("n")) / F.log(F.lit(1 / similar)) + 1e-9)
    heads = ordered.select("key", "n", part.alias("part"), F.explode(head).alias("h")).select("key", "n", "part", F.col("h.s").alias("s"))
    left = heads.select(F.col("key").alias("a"), F.col("n").alias("na"), "s", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    right = heads.select(F.col("key").alias("b"), F.col("n").alias("nb"), "s", "part")
    fits = (F.col("nb") * similar <= F.col("na") + 1e-9) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    found = left.join(right, ["s", "part"]).where(fits).select("a", "b").distinct()
    found = found.join(sets.select(F.col("key").alias("a"), F.col("signs").alias("sa")), "a").join(sets.select(F.col("key").alias("b"), F.col("signs").alias("sb")), "b")
    near = found.select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness")).where(F.col("likeness") >= similar - 1e-12)
    named = [classes.select(F.col("key").alias(c), F.col("class_id").alias(f"{c}_id")) for c in "ab"]
    near = near.join(named[0], "a").join(named[1], "b")
    return members, near.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"), "likeness")


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows id, text, n_chars, tail (the next document's first n_chars / 4 code points), next_text.

    The texts are shuffled once, by identifier, and once more to their predecessors: a text takes less
    space than its signatures.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    keys = saved(rows.select("id", "h", F.length("text").cast("long").alias("n_chars")).groupBy("id", "h").agg(F.first("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("n")))
    repeated = not keys.where("n > 1").isEmpty()
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    linked = neighbours(keys, ["id", "h"], parts).drop("prev")
    first = keys.agg(F.min(F.struct("id", "h")).alias("_first"))
    linked = linked.join(F.broadcast(first)).withColumn("next", F.coalesce("next", "_first"))
    wanted = linked.select(F.col("id").alias("own_id"), F.col("h").alias("own_h"), F.floor(F.col("n_chars") / 4).cast("int").alias("need"), F.col("next.id").alias("next_id"), F.col("next.h").alias("next_h"))
    keyed = rows.hint("merge")
    given = keyed.join(wanted, keyed["id"].eqNullSafe(F.col("next_id")) & (keyed["h"] == F.col("next_h")))
    given = given.select("own_id", "own_h", F.col("text").alias("next_text"), "need")
    if repeated:
        given = given.dropDuplicates(["own_id", "own_h"])
    out = keyed.join(given, keyed["id"].eqNullSafe(F.col("own_id")) & (keyed["h"] == F.col("own_h")))
    return out.select("id", "text", F.length("text").cast("long").alias("n_chars"), F.expr("left(next_text, need)").alias("tail"), "next_text")


def op9_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited_and_next(table(spark, sf_dir, "documents"))
    edited = F.concat(F.expr("left(text, cast(n_chars - floor(n_chars / 4) as int))"), F.col("tail"))
    rows = rows.withColumn("edited", edited)
    signed = rows.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), signatures(F.col("text")).alias("own"), signatures(F.col("edited")).alias("other"), signatures(F.col("next_text")).alias("next_signs"))
    return signed.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_signs")).alias("near_next"),
    )
