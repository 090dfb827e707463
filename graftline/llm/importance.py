"""Resampling by importance for a target distribution, over hashed n-grams.

Runs of one to n words are the features. A feature's bucket is the CRC-32 of its words joined by spaces, which no one
ever joins: each word's CRC is computed once, in whole arrays of words, and the CRC of a longer run follows from it
by the algebra of CRCs. Behind a prefix, `crc(prefix + word) = crc(prefix) * x^(8 * length) + crc(word)` over
GF(2), where the product with the power of x is a matrix of 32 x 32 bits; the matrices of the powers of two
are kept as tables by byte, and a length applies those of its bits.

All documents and all target texts are counted by bucket: each task adds up its own histogram, so what is shuffled is a row for
each bucket and task. A bucket's gain is its smoothed log ratio; a document's weight is the mean gain of its
features. Documents are then drawn without replacement by Gumbel noise from a hash of their identifier: the highest
sums are drawn and numbered over ranges.

Defined results: null text counts as empty, has no features, weight 0 and is drawn only if `least_words` is 0; texts of any
length are taken whole; ties in score go to the smaller identifier, then fewer features and the smaller weight, so repeated rows
are interchangeable; a null identifier hashes as an empty one and comes first among ties; other columns are left
out, whatever their names; with an empty target table the gains follow from the documents alone; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graftline.operators.iterate import numbered

from .common import table, tidied

#: Bytes of text worked on at a time, and words that are hashed together up to so many bytes.
CHUNK_BYTES = 1_000_000
LONG = 64
_CHAR = np.zeros(256, bool)
_CHAR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Buckets of a histogram: the size of what is collected and sent along.
MOST_BUCKETS = 1_000_000


def _byte_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


_STEP = _byte_table()


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The product of a matrix, given as four tables by byte, with each number."""
    return tables[0, crc & 255] ^ tables[1, (crc >> 8) & 255] ^ tables[2, (crc >> 16) & 255] ^ tables[3, crc >> 24]


def _shifts(bits: int) -> list[np.ndarray]:
    """The matrices of 1, 2, 4, ... bytes of zeros behind a CRC; each is the square of the one before."""
    number = np.arange(256, dtype=np.uint32)
    one = np.stack([_STEP, *(number << np.uint32(8 * k - 8) for k in (1, 2, 3))])
    found = [one]
    while len(found) < bits:
        before = found[-1]
        found.append(np.stack([_apply(before, before[k]) for k in range(4)]))
    return found


_SHIFTS = _shifts(31)


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC moved left by so many bytes."""
    out, bit = crc.copy(), 0
    while (length >> bit).any():
        some = np.flatnonzero((length >> bit) & 1)
        out[some] = _apply(_SHIFTS[bit], out[some])
        bit += 1
    return out


def combined(first: np.ndarray, second: np.ndarray, second_length: np.ndarray) -> np.ndarray:
    """The CRC of two strings, one behind the other, from theirs."""
    return shifted(first, second_length) ^ second


def word_crcs(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRC-32 of each word, byte by byte for all words at once; long words one by one."""
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    begin, left = start[order], size[order]
    short = int(np.searchsorted(-left, -LONG, side="left"))
    for k in range(int(left[short]) if short < len(left) else 0):
        upto = int(np.searchsorted(-left, -k, side="left"))
        c = crc[short:upto]
        crc[short:upto] = _STEP[(c ^ raw[begin[short:upto] + k]) & 255] ^ (c >> 8)
    crc = ~crc
    for i in range(short):
        crc[i] = zlib.crc32(raw[begin[i] : begin[i] + left[i]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lowered bytes of some texts, and the start, the size and the text of each word."""
    raw = _LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    edge = np.diff(np.r_[False, _CHAR[raw], False].astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return raw, start, stop - start, np.searchsorted(ends, start, side="right")


def features(texts: list[bytes], longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The CRC and the text of each run of one to `longest` words, and how many words each text has."""
    raw, start, size, text = words(texts)
    count = np.bincount(text, minlength=len(texts))
    crc = word_crcs(raw, start, size)
    found, owner, run = [crc], [text], crc
    spaced = combined(np.full(len(crc), zlib.crc32(b" "), np.uint32), crc, size) if longest > 1 else crc
    for n in range(1, longest):
        # a run of n words, and a space and the next word behind it
        run = combined(run[:-1], spaced[n:], size[n:] + 1)
        same = text[n:] == text[: len(text) - n]
        found.append(run[same])
        owner.append(text[n:][same])
    return np.concatenate(found), np.concatenate(owner), count


def chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the bytes of their texts, about CHUNK_BYTES or one text at a time."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "").cast(pa.binary())
        at = 0
        while at < len(texts):
            some: list[bytes] = []
            total = 0
            while at + len(some) < len(texts) and total < CHUNK_BYTES:
                some.append(texts[at + len(some)].as_py())
                total += len(some[-1])
            yield batch.slice(at, len(some)), some
            at += len(some)


def bucket_counts(docs: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be from 1 to {MOST_BUCKETS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for _, texts in chunks(batches, 0):
            n += np.bincount(features(texts, longest)[0] % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["bucket", "n"])

    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(lambda it: tidied(run(it)), "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_text_col: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, gain) of each bucket: floor(1000 * ln of its share in the target over its share in the documents), both smoothed by one."""
    s, t = bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_text_col, longest, buckets)
    both = s.withColumnRenamed("n", "s").join(t.withColumnRenamed("n", "t"), "bucket", "full")
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(F.broadcast(both), "bucket", "left").fillna(0, ["s", "t"])
    total = both.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("all_s"), F.coalesce(F.sum("t"), F.lit(0)).alias("all_t"))
    ratio = ((F.col("t") + 1) * (F.col("all_s") + buckets)).cast("double") / ((F.col("s") + 1) * (F.col("all_t") + buckets)).cast("double")
    return every.join(F.broadcast(total)).select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def weights(docs: DataFrame, gain: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(id, n_features, n_words, weight) of each row of docs: the floored mean gain of its features, 0 without any.

    The gains, one number for each bucket and so bounded by MOST_BUCKETS, are collected and go along with the tasks. No shuffle.
    """
    of = np.zeros(buckets, np.int64)
    for row in gain.collect():
        of[row["bucket"]] = row["gain"]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches, 1):
            crc, owner, count = features(texts, longest)
            n = np.bincount(owner, minlength=len(texts))
            total = np.zeros(len(texts), np.int64)
            np.add.at(total, owner, of[crc % np.uint32(buckets)])
            columns = [rows.column(0), pa.array(n), pa.array(count), pa.array(total // np.maximum(n, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_features", "n_words", "weight"])

    return rows.mapInArrow(lambda it: tidied(run(it)), f"id {rows.schema['id'].dataType.simpleString()}, n_features long, n_words long, weight long")


def noise(key: Column, seed: int | str) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of the SHA-256 of seed and key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 10, seed: int | str = 2024, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", longest: int = 1, buckets: int = 10_000
) -> DataFrame:
    """(id, n_features, weight, score, rank) of each row of docs; `rank` numbers the drawn ones from 1 and is null for all others.

    Of the rows with `least_words` words or more so many percent are drawn, rounded down. Texts are read twice and never shuffled.
    """
    gain = gains(docs, target, text_col, target_text_col, longest, buckets)
    scored = weights(docs, gain, id_col, text_col, longest, buckets).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    fit = F.col("n_words") >= least_words
    ranked = numbered(scored.withColumn("_unfit", ~fit), ["_unfit", -F.col("score"), "id", "n_features", "weight"], "_number")
    drawn = ranked.where(fit).count() * percent // 100
    rank = F.when(fit & (F.col("_number") < drawn), F.col("_number") + 1).cast("long")
    return ranked.select("id", "n_features", "weight", "score", rank.alias("rank"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


#: CRC-32 of the bytes of `w` in SQL, by a table of its steps.
CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)))"""
CRC_OF = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({w}))), lambda k: ('0x' || substr(hex(encode({w})), 2 * k + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""
OP13_SQL = rf"""WITH {CRC_TABLE},
doc_words AS (SELECT doc_id, w, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents) GROUP BY ALL),
target_words AS (SELECT w, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark) GROUP BY ALL),
buckets AS (SELECT w, {CRC_OF.format(w="w")} % 10000 AS bucket FROM (SELECT w FROM doc_words UNION SELECT w FROM target_words), crc_table),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM doc_words JOIN buckets USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS t FROM target_words JOIN buckets USING (w) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::BIGINT AS all_s, coalesce((SELECT sum(t) FROM t), 0)::BIGINT AS all_t),
gains AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (all_s + 10000))::DOUBLE / ((coalesce(s, 0) + 1) * (all_t + 10000))::DOUBLE))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket), totals),
sums AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total FROM doc_words JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce(CASE WHEN total >= 0 THEN total // n_features ELSE -((-total + n_features - 1) // n_features) END, 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM documents d LEFT JOIN sums USING (doc_id)),
fit AS (SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.doc_id, n_features, weight, weight + noise AS score, CASE WHEN r <= n * 10 // 100 THEN r END AS rank
FROM scored LEFT JOIN fit USING (doc_id)"""
