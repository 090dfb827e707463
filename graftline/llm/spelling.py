"""Groups of spelling variants: words that differ by one inserted, deleted or replaced code point.

Words are split into bigrams with their positions. One edit leaves all but two of the longer word's bigrams whole and
moves none by more than one place, so of any three bigrams of a word at least one is a bigram of a near word, at most one place
further. All bigrams are put into one order, the rarest first, and each word keeps its three rarest (and
further places of the third one's bigram, as places don't count in the order). Of two near words, that one whose third
bigram comes first in the order finds the shared bigram among the other's three, too. So words are joined on these only, at
equal places if they are equally long and at places that one edit allows if not. What is joined is verified
by edit distance within the join.

Words are counted in the tasks that read the texts, so that a row for each word and chunk of text is shuffled, not one for each
occurrence. A form is the most frequent near word that is so many times as frequent; roots follow the forms by doubling.

Defined results: null and empty texts have no words; texts of any length are taken whole; ties between forms go to
the first word in code-point order; repeated rows count as often as they stand there; with `typos` a null identifier reads as
an empty one; words of fewer than four code points, which three bigrams don't have, are near none; other columns are left out, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graftline.operators.iterate import saved

from .common import hinted, table, tidied
from .importance import CRC_OF, CRC_TABLE

#: A run of Latin letters in UTF-8, lower-cased.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: Words that a task counts before it passes them on.
COUNTED = 200_000


def typed(run: bytes, prefix: int, one_in: int) -> bytes:
    """The run with the typo that its document's hash gives it; prefix is the CRC of what stands before the run."""
    h = zlib.crc32(run, prefix)
    if h % one_in:
        return run
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 6, least_n: int = 5, typos: int | None = None) -> DataFrame:
    """(word, n): words of so many code points and occurrences. `typos` plants a deletion in one of so many (document, word) pairs."""
    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            some = [(w, n) for raw, n in counts.items() if len(w := raw.decode()) >= least_chars]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                own = Counter(RUN.findall((text.as_py() or "").encode("utf-8", "surrogatepass").lower()))
                if typos:
                    prefix = zlib.crc32(f"{'' if doc.as_py() is None else doc.as_py()}:".encode())
                    for word, n in own.items():
                        counts[typed(word, prefix, typos)] += n
                else:
                    counts.update(own)
                if len(counts) > COUNTED:
                    yield out()
        yield out()

    parts = rows.mapInArrow(lambda it: tidied(run(it)), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def rare_bigrams(words: DataFrame) -> DataFrame:
    """(word, size, gram, at): the three rarest bigrams of each word of four code points or more and their places, from 1; all places of the third one."""
    at = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.where(F.length("word") >= 4).select("word", F.explode(F.transform(at, lambda i: F.struct(F.substring("word", i, F.lit(2)).alias("gram"), i.alias("at")))).alias("g")).select("word", "g.gram", "g.at")
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    placed = grams.join(hinted(often), "gram").groupBy("word").agg(F.array_sort(F.collect_list(F.struct("often", "gram", "at"))).alias("g"))
    third = F.element_at("g", 3)
    upto = F.filter("g", lambda x: F.struct(x["often"], x["gram"]) <= F.struct(third["often"], third["gram"]))
    return placed.select("word", F.length("word").alias("size"), F.explode(upto).alias("g")).select("word", "size", "g.gram", "g.at")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): the pairs of words, both ways, that one edit makes equal.

    Pairs of one length join on bigram, place and length; a shorter word looks for a longer one at the same place or the next.
    An edit leaves what is before or what is behind the shorter word's middle as it is, so hashes of these halves, for either role of
    the second word, spare most candidates the edit distance, which decides on the rest.
    """
    rare = saved(rare_bigrams(words))
    half = F.floor(F.col("size") / 2).cast("int")
    short_half = F.floor((F.col("size") - 1) / 2).cast("int")
    part = lambda c, start, n: F.hash(F.substring(c, start, n))
    own = [part(F.col("word"), F.lit(1), half).alias("head"), part(F.col("word"), half + 1, F.col("size")).alias("rest")]
    left = rare.select(F.col("word").alias("a"), F.col("size"), F.col("gram"), F.col("at"), F.lit(0).alias("more"), *own)
    longer = rare.select(F.col("word").alias("a"), (F.col("size") + 1).alias("size"), "gram", F.explode(F.array("at", F.col("at") + 1)).alias("at"), F.lit(1).alias("more"), *own)
    same = F.struct(*own)
    grown = F.struct(part(F.col("word"), F.lit(1), short_half).alias("head"), part(F.col("word"), short_half + 2, F.col("size")).alias("rest"))
    right = rare.select(F.col("word").alias("b"), "size", "gram", "at", F.array(same, grown).alias("parts"))
    role = F.col("parts")[F.col("more")]
    halves = (role["head"] == F.col("head")) | (role["rest"] == F.col("rest"))
    near = halves & ((F.col("more") == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    found = left.union(longer).hint("merge").join(right, ["gram", "at", "size"]).where(near).select("a", "b").distinct()
    return found.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("p")).select("p.word", "p.near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the rows of (word, form): the last form on the way. Ways have no rings, as a form is more frequent."""
    way = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        # a way twice as long each round, so a few rounds for any way
        new = saved(way.join(way.select(F.col("word").alias("root"), F.col("root").alias("on")), "root", "left").select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")))
        way = new.select("word", "root")
        if new.where("moved").isEmpty():
            return way


def spelling_groups(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, n, form, root, n_near, form_n) of each row of (word, n), whose words differ."""
    words = saved(words.select("word", "n"))
    pairs = near_words(words).join(words.withColumnRenamed("word", "near").withColumnRenamed("n", "near_n"), "near")
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    formed = F.col("best").isNotNull() & (-F.col("best.less") >= times * F.col("n"))
    rows = saved(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.form")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")))
    found = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(found, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(word_counts(table(spark, sf_dir, "documents"), typos=199))


#: Near words by what is left when one code point goes: at one place for replaced ones, at any for inserted ones.
OP11_SQL = rf"""WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents) GROUP BY ALL),
hashed AS (SELECT r, n, {CRC_OF.format(w="own")} AS h FROM (SELECT r, n, doc_id || ':' || r AS own FROM runs), crc_table),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (
  SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS near FROM less x JOIN less y ON x.i = y.i AND x.d = y.d AND x.word <> y.word
  UNION SELECT l.word, w.word FROM less l JOIN words w ON l.d = w.word
  UNION SELECT w.word, l.word FROM less l JOIN words w ON l.d = w.word),
best AS (SELECT near.word, count(*) AS n_near, arg_min(near.near, (-o.n, near.near)) AS near, max(o.n) AS near_n FROM near JOIN words o ON near.near = o.word GROUP BY near.word),
formed AS (SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 5 * words.n THEN near END AS form, CASE WHEN near_n >= 5 * words.n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS root FROM formed UNION ALL SELECT ways.word, formed.form FROM ways JOIN formed ON ways.root = formed.word WHERE formed.form IS NOT NULL)
SELECT formed.word, formed.form, ways.root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN ways ON formed.word = ways.word JOIN formed AS f ON ways.root = f.word AND f.form IS NULL"""
