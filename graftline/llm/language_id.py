"""Language ID by unigrams over vocabulary pieces, marginalised over all segmentations.

Each language has one probability per piece of a fixed public vocabulary. The probability of a
word is the sum over all ways to cut it into pieces, computed by the forward algorithm; a text's
is the product over its words, runs of letters in lower case with a space mark in front. The
piece probabilities come from expectation-maximisation (forward and backward sums over all
segmentations) on the words of a sample of labelled rows.

The sample is the only bounded thing: about TRAIN_DOCS rows a language, chosen by a hash of the
identifier; its distinct words are what the driver sees. Scoring covers every row and whole texts. It
needs no shuffle; the model (pieces x languages) travels to the executors.

Defined results: null text or text without letters gives `und` and score 0; without any labelled
row all texts are `und`; ties go to the first language by code point; extra columns and repeated rows don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import fresh, table, tidied
from .sentence_pieces import MARK, public_model

UNDEFINED = "und"
PREDICTED, SCORE = "_lang_pred", "_lang_score"
#: Labelled rows of each language that are learnt from, about.
TRAIN_DOCS = 400
ROUNDS = 2
#: Prior counts of a piece, and the probability of a character that no piece has.
PRIOR = 0.01
UNKNOWN = 1e-7
#: Words longer than this are scored one by one with rescaling.
LONG_WORD = 48
KEPT_WORDS = 200_000
CHUNK_CHARS = 1_000_000
#: Python's \w without digits and underscore: letters of any script.
LETTERS = re.compile(r"[^\W\d_]+")


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def vocabulary(path: str) -> list[str]:
    """The pieces of a SentencePiece model that spell text, lower case ones only."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(len(sp)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    return [p for p in pieces if p == p.lower()]


class Lattices:
    """All pieces inside words, by the words' lengths."""

    def __init__(self, pieces: Sequence[str]):
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.unknown, self.none = len(pieces), len(pieces) + 1

    def groups(self, words: Sequence[str]) -> Iterator[tuple[np.ndarray, int, dict[tuple[int, int], np.ndarray]]]:
        """For each length: the words' numbers, the length, and piece ids by (from, to)."""
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        get, none, unknown = self.ids.get, self.none, self.unknown
        for n in np.unique(size[size <= LONG_WORD]).tolist():
            at = np.flatnonzero(size == n)
            own = [MARK + words[i] for i in at.tolist()]
            cells = {}
            for i in range(n):
                for j in range(i + 1, min(n, i + self.longest) + 1):
                    miss = unknown if j == i + 1 else none
                    ids = np.array([get(w[i:j], miss) for w in own], np.int32)
                    if j == i + 1 or (ids != none).any():
                        cells[i, j] = ids
            yield at, n, cells


def forward(cells: dict, n: int, p: np.ndarray) -> list[np.ndarray]:
    """Sums over the segmentations of each prefix: n + 1 arrays of words x languages."""
    count = len(next(iter(cells.values())))
    alpha = [np.ones((count, p.shape[1]))] + [np.zeros((count, p.shape[1])) for _ in range(n)]
    for (i, j), ids in sorted(cells.items(), key=lambda x: x[0][1]):
        alpha[j] += alpha[i] * p[ids]
    return alpha


def backward(cells: dict, n: int, p: np.ndarray) -> list[np.ndarray]:
    count = len(next(iter(cells.values())))
    beta = [np.zeros((count, p.shape[1])) for _ in range(n)] + [np.ones((count, p.shape[1]))]
    for (i, j), ids in sorted(cells.items(), key=lambda x: -x[0][0]):
        beta[i] += beta[j] * p[ids]
    return beta


def fit(pieces: Sequence[str], words: Sequence[str], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities, (pieces + 2) x languages; the last two rows: unknown character, no piece."""
    lattices, langs = Lattices(pieces), counts.shape[1]
    p = np.full((len(pieces) + 2, langs), 1.0 / max(1, len(pieces)))
    p[-2], p[-1] = UNKNOWN, 0
    groups = list(lattices.groups(words))
    for _ in range(rounds):
        total = np.zeros_like(p)
        for at, n, cells in groups:
            alpha, beta = forward(cells, n, p), backward(cells, n, p)
            weight = counts[at] / np.maximum(alpha[n], 1e-300)
            for (i, j), ids in cells.items():
                expected = alpha[i] * p[ids] * beta[j] * weight
                for k in range(langs):
                    total[:, k] += np.bincount(ids, expected[:, k], len(total))
        total = total[:-2] + PRIOR
        p[:-2] = total / total.sum(0)
    return p


class Scorer:
    """Log probabilities of words for each language, with a bounded table of known words."""

    def __init__(self, pieces: Sequence[str], p: np.ndarray):
        self.lattices, self.p = Lattices(pieces), p
        self.number: dict[str, int] = {}
        self.logs = np.zeros((0, p.shape[1]))

    def long_word(self, word: str) -> np.ndarray:
        w, get, longest = MARK + word, self.lattices.ids.get, self.lattices.longest
        alpha: list[np.ndarray] = [np.ones(self.p.shape[1])]
        log = np.zeros(self.p.shape[1])
        for j in range(1, len(w) + 1):
            now = np.zeros(self.p.shape[1])
            for back in range(1, min(j, longest) + 1):
                if (k := get(w[j - back : j], self.lattices.unknown if back == 1 else -1)) >= 0:
                    now = now + alpha[-back] * self.p[k]
            alpha.append(now)
            alpha = alpha[-longest:]
            scale = np.maximum(now, 1e-300)
            if j % 16 == 0:
                log += np.log(scale)
                alpha = [a / scale for a in alpha]
        return log + np.log(np.maximum(alpha[-1], 1e-300))

    def learn(self, words: set[str]) -> None:
        if len(self.number) > KEPT_WORDS:
            self.number, self.logs = {}, self.logs[:0]
        new = [w for w in words if w not in self.number]
        logs = np.zeros((len(new), self.p.shape[1]))
        for at, n, cells in self.lattices.groups(new):
            logs[at] = np.log(np.maximum(forward(cells, n, self.p)[n], 1e-300))
        for i, w in enumerate(new):
            if len(w) + 1 > LONG_WORD:
                logs[i] = self.long_word(w)
        self.number.update(zip(new, range(len(self.logs), len(self.logs) + len(new)), strict=True))
        self.logs = np.concatenate([self.logs, logs])

    def score(self, words: list[str]) -> np.ndarray:
        """Posterior of each language, all equally likely before."""
        total = self.logs[np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))].sum(0)
        odds = np.exp(total - total.max())
        return odds / odds.sum()


def scored(batches: Iterator[pa.RecordBatch], langs: Sequence[str], scorer: Scorer, text_at: int, kept: Sequence[int], added: Sequence[str] = (PREDICTED, SCORE)) -> Iterator[pa.RecordBatch]:
    """The kept columns of each batch, then language and score of the column of texts, a few MB at a time."""
    for batch in batches:
        texts, at = batch.column(text_at), 0
        while at < len(texts):
            rows, chars = [], 0
            while at + len(rows) < len(texts) and (not rows or chars < CHUNK_CHARS):
                text = texts[at + len(rows)].as_py() or ""
                chars += len(text)
                rows.append(words_of(text) if langs else [])
            scorer.learn(set().union(*rows))
            best, score = [], []
            for words in rows:
                odds = scorer.score(words) if words else None
                k = 0 if odds is None else int(odds.argmax())
                best.append(UNDEFINED if odds is None else langs[k])
                score.append(0.0 if odds is None else float(odds[k]))
            columns = [batch.column(c).slice(at, len(rows)) for c in kept]
            names = [batch.schema.names[c] for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(best, pa.string()), pa.array(score, pa.float64())], names=[*names, *added])
            at += len(rows)


def training_words(rows: DataFrame, most: int) -> DataFrame:
    """(lang, word, n) over about `most` rows of each language: those with the smallest hashes."""
    unit = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    some = F.lit(False)
    for lang, n in sizes.items():
        some = some | ((F.col("lang") == lang) & (unit < most / n))
    # A superset of the letters that Python's pattern takes; every word is cut again on the driver.
    words = F.explode(F.split(F.lower("text"), r"[^\p{L}\p{M}\p{N}_]+"))
    return rows.where(some).select("lang", words.alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, path: str, most: int = TRAIN_DOCS) -> tuple[list[str], list[str], np.ndarray]:
    """Languages, pieces and probabilities, learnt from labelled rows that are not held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held_out(F.col("id")), F.lit(False)))
    found = sorted(training_words(rows, most).collect())
    langs = sorted({r.lang for r in found})
    number: dict[str, int] = {}
    cells = [(number.setdefault(w, len(number)), langs.index(r.lang), r.n) for r in found for w in words_of(r.word)]
    counts = np.zeros((len(number), len(langs)))
    for i, k, n in cells:
        counts[i, k] += n
    pieces = vocabulary(path)
    short = [i for i, w in enumerate(number) if len(w) < LONG_WORD]
    names = list(number)
    return langs, pieces, fit(pieces, [names[i] for i in short], counts[short])


def _predicted(docs: DataFrame, rows: DataFrame, kept: Sequence[str], columns: tuple[str, str, str], path: str | None, most: int) -> DataFrame:
    """rows (with a column of texts as in docs) reduced to `kept`, with PREDICTED and SCORE, or names like these that no column has."""
    added = [fresh(rows, PREDICTED), fresh(rows, SCORE)]
    id_col, text_col, lang_col = columns
    langs, pieces, p = train(docs, id_col, text_col, lang_col, path or public_model(), most)
    sent = docs.sparkSession.sparkContext.broadcast((langs, pieces, p))
    text_at, kept_at = rows.columns.index(text_col), [rows.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vocab, probabilities = sent.value
        return tidied(scored(batches, own, Scorer(vocab, probabilities), text_at, kept_at, added))

    return rows.mapInArrow(run, StructType([*(rows.schema[c] for c in kept), StructField(added[0], StringType()), StructField(added[1], DoubleType())]))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", path: str | None = None, most: int = TRAIN_DOCS) -> DataFrame:
    """One row for each row of docs: id, held_out, lang_pred, score."""
    rows = docs.select(F.col(id_col).alias(fresh(docs.select(text_col), "_id")), F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias(fresh(docs.select(text_col), "_held_out")), F.col(text_col))
    out = _predicted(docs, rows, rows.columns[:2], (id_col, text_col, lang_col), path, most).toDF("_id", "_held_out", PREDICTED, SCORE)
    return out.select(F.col("_id").alias("id"), F.col("_held_out").alias("held_out"), F.col(PREDICTED).alias("lang_pred"), F.col(SCORE).alias("score"))


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = 0.5, path: str | None = None, most: int = TRAIN_DOCS) -> DataFrame:
    """docs without the rows that have no language or none with a score of `least`; columns unchanged, no shuffle."""
    out = _predicted(docs, docs, docs.columns, (id_col, text_col, lang_col), path, most)
    predicted, score = out.columns[-2:]
    return out.where((F.col(predicted) != UNDEFINED) & (F.col(score) >= least)).select(*docs.columns)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
