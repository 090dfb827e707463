"""Exact substring dedup over a compacted de Bruijn graph of word k-mers.

Every word that lies in a window of `window` words which also starts earlier (in a smaller document, or
earlier in the same one) is removed. Windows are the edges of a de Bruijn graph: equal windows are one edge,
and following windows of a text are following edges.

1. Edges travel as paths: of each window the k-mer of `edge` words with the smallest hash is the anchor, and following
   windows with one anchor (up to window - edge + 1) are one row. Equal paths fall together, combined
   before the shuffle; the path keeps the source coordinates (document, word) of its first copy.
2. An anchor with one distinct path does not branch. Where an anchor has several, joins find the branching
   paths, and only their windows, of the first copies, become edges of their own.
3. Joins give every later copy of a path or window the source coordinates of the first. What follows in a
   document as it follows in its source (one document, source and distance) is a nonbranching path of
   the graph and is compacted to one long span.
4. Source coordinates verify the spans: the document's words and the words at the source's coordinates must have the same
   SHA-256 digest. If a span fails, hashes have collided, and all is done again with other hashes.
   So what is removed rests on text. Words that no verified span covers stay.

Scale: a path, about 6 words, is one row of 28 bytes; a passage that most documents share is combined inside each
task first. Only later copies and windows of branching paths are joined with their sources, a source being one row, so
a hot passage is the large side of a join, which adaptive execution splits. Texts meet lists of spans, by broadcast
below a counted size and by a shuffled join above it; documents without repeats never travel. A document that is
the source of many different spans is asked for them in lists of ASKED.

Defined results: null and wordless texts have 0 words; texts shorter than a window lose none; documents
are ordered by identifier, null first, and rows with one identifier by a hash of the text; rows that
repeat both are one document, with the same result each; other columns are not read and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hinted, saved, table, tidied, written
from .word_hashes import RunHashes, Words, chunks

WINDOW, EDGE = 20, 8
#: Longs in lists of coordinates, and rows, that a broadcast may hold: 3 MB, so that tables of any size but tiny ones have one plan.
BROADCAST_LONGS, BROADCAST_ROWS = 400_000, 20_000
#: Added to hashes of windows, which are never compared with those of paths.
_SINGLE = np.uint64(0x5851F42D4C957F2D)
#: Spans of one source that one row asks for.
ASKED = 4096
#: Times that all is done again with other hashes after a collision.
SEEDS = 8


class Paths:
    """The windows of some texts, grouped by anchor; one text behind the other."""

    def __init__(self, texts: list[bytes], window: int, edge: int, seed: int):
        w = self.words = Words(texts, seed=seed)
        n = len(w.hash)
        self.runs = RunHashes(w.hash, 2 * window - edge)
        own = np.maximum(0, w.count - window + 1)
        start = np.repeat(w.first[:-1] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        text = np.repeat(np.arange(len(texts)), own)
        if len(start):
            hashes = self.runs.at(np.arange(n - edge + 1), edge)
            anchor = start + np.lib.stride_tricks.sliding_window_view(hashes, window - edge + 1).argmin(1)[start]
            first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
        else:
            hashes, anchor, first = np.zeros(0, np.uint64), start, start
        #: First window, number of windows and text of each path, and the anchor's and the whole path's hash.
        self.start, self.text = start[first], text[first]
        self.size = np.diff(np.r_[first, len(start)])
        self.anchor = hashes[anchor[first]]
        self.path = self.runs.at(self.start, self.size + window - 1) ^ (anchor[first] - self.start).astype(np.uint64)
        #: Word number inside its text.
        self.place = self.start - w.first[self.text]
        self.count = np.bincount(self.text, minlength=len(texts))

    def packed(self) -> np.ndarray:
        return (self.place << 9) | (self.size << 1)


def _short(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _earliest(text: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of equal rows inside each text, in order, and how many equal rows there are."""
    order = np.lexsort((np.arange(len(text)), *keys, text))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in (text, *keys):
        new[1:] |= x[order][1:] != x[order][:-1]
    first, count = order[new], np.diff(np.r_[np.flatnonzero(new), len(order)])
    back = np.argsort(first)
    return first[back], count[back]


def _summary(batches: Iterator[pa.RecordBatch], window: int, edge: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in chunks(batch.column(1)):
            p = Paths(texts, window, edge, seed)
            digests = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(p.words.count), pa.array(p.count), pa.array(digests)], names=["key", "n_words", "n_paths", "whole"])


def _path_rows(batches: Iterator[pa.RecordBatch], window: int, edge: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in chunks(batch.column(1)):
            p = Paths(texts, window, edge, seed)
            keep, n = _earliest(p.text, p.path)
            at = p.packed()[keep] | (n > 1)
            keys = batch.column(0).take(pa.array(first + p.text[keep]))
            yield pa.RecordBatch.from_arrays([keys, pa.array(_short(p.anchor[keep])), pa.array(p.path[keep].view(np.int64)), pa.array(at)], names=["key", "anchor", "path", "at"])


def _listed(column: pa.Array, i: int) -> np.ndarray:
    value = column[i].values
    return np.zeros(0, np.int64) if value is None else value.to_numpy(zero_copy_only=False)


def _wanted(p: Paths, column: pa.Array, first: int) -> np.ndarray:
    """Which paths are on their text's list; a path is known by its first word."""
    lists = [_listed(column, first + i) >> 9 for i in range(len(p.count))]
    offset = p.words.first[:-1]
    at = np.concatenate([np.zeros(0, np.int64), *(x + o for x, o in zip(lists, offset.tolist(), strict=True))])
    return np.isin(p.start, at)


def _later_rows(batches: Iterator[pa.RecordBatch], window: int, edge: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Of (key, text, original, branching): the paths on neither list, and the windows of the branching ones.

    `at` holds place, number of windows, and two bits: for windows, and for the first of equal ones in a text.
    """
    for batch in batches:
        for first, texts in chunks(batch.column(1)):
            p = Paths(texts, window, edge, seed)
            original, branching = (_wanted(p, batch.column(c), first) for c in (2, 3))
            later = np.flatnonzero(~original & ~branching)
            size = p.size[branching]
            start = np.repeat(p.start[branching] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            text = np.r_[p.text[later], np.repeat(p.text[branching], size)]
            words = np.r_[p.path[later], p.runs.at(start, window) + _SINGLE]
            at = np.r_[p.place[later], start - p.words.first[text[len(later) :]]]
            lead = _earliest(text[len(later) :], words[len(later) :])[0]
            packed = (at << 10) | np.r_[p.size[later], np.ones(len(start), np.int64)] << 2
            packed[len(later) :] |= 2
            packed[len(later) + lead] |= 1
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + text)), pa.array(words.view(np.int64)), pa.array(packed)], names=["key", "words", "at"])


def _kept(w: Words, i: int, spans: list[tuple[int, int]]) -> tuple[int, int, str, list[list[int]]]:
    """Of text i: number of words, removed ones, digest of the words that stay, and the removed stretches."""
    a, b = int(w.first[i]), int(w.first[i + 1])
    edges = np.zeros(b - a + 1, np.int64)
    for x, n in spans:
        edges[x] += 1
        edges[x + n] -= 1
    gone = np.cumsum(edges)[:-1] > 0
    turn = np.diff(np.r_[False, gone, False].astype(np.int8))
    out = np.stack([np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)], 1).tolist()
    bounds = [0, *(x for pair in out for x in pair), b - a]
    kept = b" ".join(s for x, y in zip(bounds[::2], bounds[1::2], strict=True) if (s := w.spelled(a + x, a + y)))
    return b - a, int(gone.sum()), hashlib.sha256(kept).hexdigest(), out


_JUDGED = "key long, own boolean, first array<long>, n array<long>, source array<long>, source_at array<long>, digests array<binary>, n_words long, n_removed long, kept_sha256 string, spans array<array<long>>"


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, text, own, first, n, source, source_at): the spans' digests; where they are the text's own, also what stays without them."""
    kinds = {"digests": pa.list_(pa.binary()), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "spans": pa.list_(pa.list_(pa.int64()))}
    for batch in batches:
        for at, texts in chunks(batch.column(1)):
            w, rows = Words(texts), []
            for i in range(len(texts)):
                spans = list(zip(*(_listed(batch.column(c), at + i).tolist() for c in (3, 4)), strict=True))
                a = int(w.first[i])
                digests = [hashlib.sha256(w.spelled(a + x, a + x + n)).digest() for x, n in spans]
                rows.append((digests, *(_kept(w, i, spans) if batch.column(2)[at + i].as_py() else (0, 0, None, None))))
            told = [batch.column(c).slice(at, len(texts)) for c in (0, 2, 3, 4, 5, 6)]
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*told, *made], names=["key", "own", "first", "n", "source", "source_at", *kinds])


def _by_size(df: DataFrame, longs: Column) -> DataFrame:
    """df for a join: broadcast while its lists are counted small."""
    total = df.agg(F.sum(longs)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_LONGS and df.count() <= BROADCAST_LONGS // 8 else df.hint("merge")


def _ranked(rows: DataFrame) -> DataFrame:
    """(id, h, key): keys in the order of identifiers where these are null or repeat."""
    keys = rows.select("id", "h").distinct()
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = saved(keys.repartitionByRange(parts, F.col("id").asc_nulls_first(), "h").withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy(F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(F.col("id").asc_nulls_first(), "h"))
    return ranged.join(F.broadcast(before), F.col("_part") == F.col("_p")).select("id", "h", (F.col("_before") + rank).cast("long").alias("key"))


def compacted(later: DataFrame, window: int) -> DataFrame:
    """Long spans of (key, at, size, source, source_at): key, first word, n (words), source, source_at.

    Edges that follow each other in a document and in its source alike are one nonbranching path.
    """
    way = ["key", "source", "ahead"]
    rows = later.withColumn("ahead", F.col("at") - F.col("source_at"))
    by = Window.partitionBy(*way).orderBy("at", "size")
    reach = F.max(F.col("at") + F.col("size") + F.lit(window - 1)).over(by.rowsBetween(Window.unboundedPreceding, -1))
    opened = rows.withColumn("turn", F.when(F.col("at") <= reach, 0).otherwise(1)).withColumn("turn", F.sum("turn").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.min("at").alias("first")
    spans = opened.groupBy(*way, "turn").agg(first, (F.max(F.col("at") + F.col("size")) + F.lit(window - 1) - F.min("at")).alias("n"))
    return spans.select("key", "first", "n", "source", (F.col("first") - F.col("ahead")).alias("source_at"))


def repeated_spans(keyed: DataFrame, counts: DataFrame, window: int, edge: int, seed: int) -> DataFrame:
    """Long spans of keyed (key, text) whose edges are elsewhere earlier, by their hashes; counts has the paths of each text."""
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    bit = lambda n: F.col("at").bitwiseAND(F.lit(n)) > 0
    paths = keyed.mapInArrow(lambda it: tidied(_path_rows(it, window, edge, seed)), "key long, anchor int, path long, at long")
    repeats = (F.count(F.lit(1)) > 1) | F.max(bit(1))
    firsts = written(paths.groupBy("anchor", "path").agg(F.min("key").alias("key"), F.min_by("at", "key").alias("at"), repeats.alias("repeats")))
    branch = saved(firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("anchor").alias("_anchor")))
    marked = firsts.select("anchor", "key", "at").join(hinted(branch, BROADCAST_ROWS), F.col("anchor") == F.col("_anchor"), "left")
    branching = F.col("_anchor").isNotNull()
    lists = written(marked.groupBy("key").agg(F.collect_list(F.when(~branching, F.col("at"))).alias("original"), F.collect_list(F.when(branching, F.col("at"))).alias("branching")))

    info = counts.where("n_paths > 0").join(lists, "key", "left").where((size("branching") > 0) | (size("original") < F.col("n_paths")))
    info = written(info.select(F.col("key").alias("_key"), "original", "branching"))
    texts = keyed.join(_by_size(info, size("original") + size("branching") + 1), F.col("key") == F.col("_key")).select("key", "text", "original", "branching")
    found = written(texts.mapInArrow(lambda it: tidied(_later_rows(it, window, edge, seed)), "key long, words long, at long"))

    windows = found.where(bit(2)).groupBy("words").agg(F.min("key").alias("source"), F.min_by("at", F.when(bit(1), F.col("key"))).alias("at"), F.count(F.lit(1)).alias("m"))
    sources = firsts.where("repeats").select(F.col("path").alias("words"), F.col("key").alias("source"), F.shiftright("at", 9).alias("source_at"))
    sources = saved(sources.unionByName(windows.where("m > 1").select("words", "source", F.shiftright("at", 10).alias("source_at"))))
    later = found.select("key", "words", F.shiftright("at", 10).alias("at"), F.shiftright("at", 2).bitwiseAND(F.lit(255)).alias("size")).join(hinted(sources, BROADCAST_ROWS), "words")
    return compacted(later.where("key <> source OR at <> source_at").select("key", "at", "size", "source", "source_at"), window)


def _verified(keyed: DataFrame, spans: DataFrame) -> tuple[DataFrame, bool]:
    """What stays of each text of keyed that has spans, and whether all spans equal the words at their sources."""
    own = spans.groupBy("key").agg(*[F.collect_list(c).alias(c) for c in ("first", "n", "source", "source_at")]).withColumn("own", F.lit(True))
    asked = saved(spans.select(F.col("source").alias("key"), F.col("source_at").alias("first"), "n").distinct())
    many = asked.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > ASKED)
    part = F.pmod(F.xxhash64("first", "n"), F.coalesce(F.ceil(F.col("m") / ASKED), F.lit(1)))
    dealt = asked.join(hinted(saved(many), BROADCAST_ROWS), F.col("key") == F.col("_key"), "left").groupBy("key", part.alias("part"))
    theirs = dealt.agg(F.collect_list("first").alias("first"), F.collect_list("n").alias("n")).withColumn("own", F.lit(False)).drop("part")
    none = F.array().cast("array<bigint>")
    lists = written(own.unionByName(theirs.withColumn("source", none).withColumn("source_at", none)).withColumnRenamed("key", "_key"))
    texts = keyed.join(_by_size(lists, F.size("first") * 4 + 1), F.col("key") == F.col("_key")).select("key", "text", "own", "first", "n", "source", "source_at")
    judged = written(texts.mapInArrow(lambda it: tidied(_judged(it)), _JUDGED))
    each = judged.select("key", "own", F.explode(F.arrays_zip("first", "n", "digests", "source", "source_at")).alias("x")).select("key", "own", "x.*")
    claims = each.where("own").select("source", "source_at", "n", "digests").distinct()
    proofs = each.where("NOT own").select(F.col("key").alias("source"), F.col("first").alias("source_at"), "n", "digests")
    good = claims.join(proofs, ["source", "source_at", "n", "digests"], "left_anti").isEmpty()
    return judged.where("own").select("key", "n_words", "n_removed", "kept_sha256", "spans"), good


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, edge: int = EDGE) -> DataFrame:
    """One row for each row of docs: id, n_words, n_removed, kept_sha256, spans (removed words, from and to)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = rows.select("id")
    plain = rows.schema["id"].dataType.simpleString() in ("bigint", "int") and ids.groupBy("id").count().where("count > 1 OR id IS NULL").isEmpty()
    if plain:
        keyed, names = rows.select(F.col("id").cast("long").alias("key"), "text"), None
    else:
        hashed = rows.withColumn("h", F.xxhash64("text"))
        names = saved(_ranked(hashed))
        once = hashed.dropDuplicates(["id", "h"]).alias("x").join(names.alias("y"), F.expr("x.id <=> y.id AND x.h = y.h"))
        keyed = written(once.select("key", "text"))

    for seed in range(SEEDS):
        summary = written(keyed.mapInArrow(lambda it, s=seed: tidied(_summary(it, window, edge, s)), "key long, n_words long, n_paths long, whole string"))
        changed, good = _verified(keyed, written(repeated_spans(keyed, summary.select("key", "n_paths"), window, edge, seed)))
        if good:
            break
    else:
        raise RuntimeError("spans differ from their sources under every hash")
    same = summary.join(hinted(changed.select(F.col("key").alias("_key")), BROADCAST_ROWS), F.col("key") == F.col("_key"), "left_anti")
    same = same.select("key", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("whole").alias("kept_sha256"), F.array().cast("array<array<bigint>>").alias("spans"))
    out = changed.unionByName(same)
    if names is None:
        return out.withColumnRenamed("key", "id")
    each = hashed.select("id", "h").alias("x").join(names.alias("y"), F.expr("x.id <=> y.id AND x.h = y.h")).select("x.id", "key")
    return each.join(out, "key").select("id", "n_words", "n_removed", "kept_sha256", "spans")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans").withColumnRenamed("id", "doc_id")
