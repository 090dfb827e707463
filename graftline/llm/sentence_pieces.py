"""SentencePiece encoding and decoding by vectorised merge rounds.

The words of a batch that are not known yet lie one behind the other in flat numpy arrays of
symbols. In each round the smallest pair rank of every word is found (a segmented minimum), all
its occurrences merge, leftmost first, in all words at once, and the arrays are compacted, until
no pair is left. Merging several occurrences in one round equals the library's order, one merge
after the other, as long as no merge creates a pair of the same or a smaller rank; where one
does, that word is encoded anew by single merges.

Texts are cut into words only where the vocabulary can't merge: before a space mark that follows
another character, and around white space that no piece contains. Words are encoded once and kept in a bounded table.

Defined results: null text counts as empty; an empty text has begin and end ids only; texts of
any length are encoded whole; rows are independent, so repeated rows and columns with other
names don't matter.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, tidied

MARK = "▁"
NONE = np.int32(2**31 - 1)
#: Words whose ids are kept between batches, and text that is encoded at a time.
KEPT_WORDS = 200_000
CHUNK_CHARS = 1_500_000


class PieceModel:
    """A BPE model with byte fallback, as numpy tables of pairs."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = len(sp)
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)}
        self.byte_ids = np.zeros(256, np.int32)
        self.byte_of: dict[int, int] = {}
        for i in range(n):
            if sp.is_byte(i):
                self.byte_of[i] = int(self.pieces[i][1:-1], 16)
                self.byte_ids[self.byte_of[i]] = i
        normal = {p: i for i, p in enumerate(self.pieces) if i not in self.special and i not in self.byte_of}
        scores = {i: sp.get_score(i) for i in normal.values()}
        rank = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.char_id = np.arange(n, n + 0x110000, dtype=np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        pair: dict[tuple[int, int], tuple[int, int]] = {}
        part = lambda p: normal.get(p, n + ord(p) if len(p) == 1 else -1)
        for p, i in normal.items():
            for at in range(1, len(p)):
                a, b = part(p[:at]), part(p[at:])
                if a >= 0 and b >= 0:
                    pair[a, b] = rank[scores[i]], i
        keys = np.array([a << 32 | b for a, b in pair], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks, self.merged = (np.array(x, np.int32)[order] for x in zip(*pair.values(), strict=True))
        self._hash()
        self.texts = [""] * n
        for i, p in enumerate(self.pieces):
            self.texts[i] = "" if i in self.special else p.replace(MARK, " ")
        # A space mark behind another character starts a word unless some piece has it inside.
        inside = any(re.search(f"[^{MARK}]{MARK}", p) for p in normal)
        used = set("".join(normal))
        gaps = "".join(c for c in "\t\n\x0b\x0c\r" if c not in used)
        self.word = re.compile("(?s).+" if inside else f"{MARK}*[^{MARK}{gaps}]+|{MARK}+|[{gaps}]" if gaps else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.text_array = np.array(self.texts, object)
        self.is_byte = np.isin(np.arange(n), list(self.byte_of))
        self.ids_of: dict[str, bytes] = {}
        self.text_of: dict[str, str] = {}

    def _hash(self) -> None:
        """Open addressing over the pairs' keys."""
        self.bits = max(4, int(len(self.keys) * 4).bit_length())
        self.slot = np.full((1 << self.bits) + 64, -1, np.int64)
        self.where = np.zeros(len(self.slot), np.int32)
        for i, (k, h) in enumerate(zip(self.keys.tolist(), self._at(self.keys).tolist(), strict=True)):
            while self.slot[h] != -1:
                h += 1
            self.slot[h], self.where[h] = k, i
        filled = self.slot != -1
        self.probes, run = 1, 0
        for f in filled.tolist():
            run = run + 1 if f else 0
            self.probes = max(self.probes, run)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; NONE where there is none."""
        key = (a.astype(np.int64) << 32) | b
        h = self._at(key)
        found = np.full(len(key), -1, np.int32)
        left = np.arange(len(key))
        for _ in range(self.probes + 1):
            got = self.slot[h[left]]
            hit = got == key[left]
            found[left[hit]] = self.where[h[left[hit]]]
            left = left[~hit & (got != -1)]
            if not len(left):
                break
            h[left] += 1
        none = found < 0
        found[none] = 0
        rank, merged = self.ranks[found], self.merged[found]
        rank[none] = NONE
        return rank, merged

    def single(self, sym: list[int]) -> list[int]:
        """One word by single merges, best rank and then leftmost first."""
        n = len(sym)
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        flat = np.array(sym, np.int32)
        rank, merged = self.look_up(flat[:-1], flat[1:])
        heap = [(int(rank[i]), i, sym[i], sym[i + 1], int(merged[i])) for i in np.flatnonzero(rank != NONE).tolist()]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], alive[j], nxt[i] = new, False, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            around = [(x, y) for x, y in ((prv[i], i), (i, nxt[i])) if x >= 0 and y < n]
            rank, merged = self.look_up(np.array([sym[x] for x, _ in around], np.int32), np.array([sym[y] for _, y in around], np.int32))
            for (x, y), r, m in zip(around, rank.tolist(), merged.tolist(), strict=True):
                if r != NONE:
                    heapq.heappush(heap, (r, x, sym[x], sym[y], m))
        return [s for s, ok in zip(sym, alive, strict=True) if ok]

    def rounds(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words when no pair is left, one word behind the other, and how many each has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.char_id[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        first = sym
        sym = sym.copy()
        ends = np.cumsum(size)
        word = np.repeat(np.arange(len(words)), size)
        done_sym, done_word = [sym[:0]], [word[:0]]
        again: set[int] = set()

        def ranked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of the pairs that begin at `at`; the last symbol of a word begins none."""
            rank, merged = self.look_up(sym[at], sym[np.minimum(at + 1, len(sym) - 1)])
            rank[(at + 1 >= len(sym)) | (word[at] != word[np.minimum(at + 1, len(sym) - 1)])] = NONE
            return rank, merged

        rank, merged = ranked(np.arange(len(sym)))
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(sym)])
            done = best == NONE
            if done.any():
                keep = np.repeat(~done, lengths)
                done_sym.append(sym[~keep])
                done_word.append(word[~keep])
                sym, word, rank, merged = sym[keep], word[keep], rank[keep], merged[keep]
                best, lengths = best[~done], lengths[~done]
                if not len(sym):
                    break
            least = np.repeat(best, lengths)
            at = np.flatnonzero(rank == least)
            fresh = np.r_[True, np.diff(at) != 1]
            order = np.arange(len(at))
            at = at[(order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0]
            sym[at] = merged[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at = at - np.searchsorted(at, at)
            sym, word, rank, merged, least = sym[keep], word[keep], rank[keep], merged[keep], least[keep]
            mark = np.zeros(len(sym), bool)
            mark[at] = True
            left = at[at > 0] - 1
            mark[left[word[left] == word[left + 1]]] = True
            touched = np.flatnonzero(mark)
            rank[touched], merged[touched] = ranked(touched)
            early = touched[rank[touched] <= least[touched]]
            if len(early):
                redo = np.unique(word[early])
                again.update(redo.tolist())
                keep = ~np.isin(word, redo)
                sym, word, rank, merged = sym[keep], word[keep], rank[keep], merged[keep]
        for i in again:
            one = np.array(self.single(first[ends[i] - size[i] : ends[i]].tolist()), np.int32)
            done_sym.append(one)
            done_word.append(np.full(len(one), i))
        word = np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_sym)[order], np.bincount(word, minlength=len(words))

    def to_ids(self, sym: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number in each word; characters without a piece become the ids of their bytes."""
        odd = sym >= self.size
        if not odd.any():
            return sym, count
        spelled = [chr(c).encode("utf-8", "surrogatepass") for c in (sym[odd] - self.size).tolist()]
        times = np.ones(len(sym), np.int64)
        times[odd] = list(map(len, spelled))
        ids = np.repeat(sym, times)
        ids[np.repeat(odd, times)] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        total = np.r_[0, np.cumsum(times)]
        ends = np.cumsum(count)
        return ids, total[ends] - total[ends - count]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the ids, without the space that encoding puts in front."""
        out = self._spelled(ids)
        return out[1:] if out.startswith(" ") else out

    def _spelled(self, ids: Sequence[int]) -> str:
        if not any(i in self.byte_of for i in ids):
            return "".join([self.texts[i] for i in ids])
        parts: list[bytes] = [bytes([self.byte_of[i]]) if i in self.byte_of else self.texts[i].encode() for i in ids]
        return b"".join(parts).decode("utf-8", "replace")

    def learn(self, words: set[str]) -> None:
        """Puts the ids and the decoded text of new words into the table."""
        if len(self.ids_of) > KEPT_WORDS:
            self.ids_of, self.text_of = {}, {}
        new = list(words.difference(self.ids_of))
        if not new:
            return
        ids, count = self.to_ids(*self.rounds(new))
        raw, texts = ids.astype("<u4").tobytes(), self.text_array[ids].tolist()
        ends = np.cumsum(count)
        odd = np.r_[0, np.cumsum(self.is_byte[ids])]
        for w, a, b, o in zip(new, (ends - count).tolist(), ends.tolist(), (odd[ends] > odd[ends - count]).tolist(), strict=True):
            self.ids_of[w] = raw[4 * a : 4 * b]
            self.text_of[w] = self._spelled(ids[a:b].tolist()) if o else "".join(texts[a:b])

    def words(self, text: str) -> list[str]:
        return self.word.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text, with begin and end."""
        words = self.words(text or "")
        self.learn(set(words))
        ids = np.frombuffer(b"".join([self.ids_of[w] for w in words]), "<u4")
        return [self.bos, *ids.tolist(), self.eos]


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str, with_ids: bool = False) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, n_tokens, ids_sha256, decoded_sha256[, ids]), a few MB of text at a time."""
    m = model(path)
    ends = [np.array([x], "<u4").tobytes() for x in (m.bos, m.eos)]
    m.ids_of, m.text_of = {}, {}  # nothing is kept from one task to the next
    for batch in batches:
        texts = batch.column(1)
        at = 0
        while at < len(texts):
            rows, chars = [], 0
            while at + len(rows) < len(texts) and (not rows or chars < CHUNK_CHARS):
                rows.append(m.words(texts[at + len(rows)].as_py() or ""))
                chars += sum(map(len, rows[-1]))
            m.learn(set().union(*rows))
            ids_of, text_of = m.ids_of.__getitem__, m.text_of.__getitem__
            n, ids, texts_out, kept = [], [], [], []
            for words in rows:
                raw = b"".join([ends[0], *map(ids_of, words), ends[1]])
                text = "".join(map(text_of, words))
                text = text[1:] if text.startswith(" ") else text
                n.append(len(raw) // 4)
                ids.append(hashlib.sha256(raw).hexdigest())
                texts_out.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
                if with_ids:
                    kept.append(np.frombuffer(raw, "<u4").astype(np.int32))
            columns = [batch.column(0).slice(at, len(rows)), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts_out, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
            at += len(rows)
    m.ids_of, m.text_of = {}, {}


def public_model() -> str:
    """The file of the public 32k BPE vocabulary; found again on each executor."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row for each row of docs: id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids. No shuffle."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(lambda it: tidied(encoded(it, path or public_model(), with_ids)), schema)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
