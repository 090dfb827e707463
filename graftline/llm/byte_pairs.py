"""Byte-level BPE encoding and decoding by a dynamic programme over prefixes.

A sequence of tokens is the encoding of its bytes exactly if each two neighbours are: if the merges of
their bytes alone, lowest rank and then leftmost first, end in these two. (Up to the first merge across
some border, the merges inside the two tokens beside it come in the order they have alone, so that
merge comes there too.) Every prefix of a piece therefore has one valid last token: the one that ends it and
is a valid neighbour of the last token of the prefix before it. `Prefixes` stores it for each byte. Bytes
appended later go on from there; nothing before is looked at again. `EncodedText` keeps the pieces of a
text with their prefixes, so an append or an edit encodes anew only from the last piece that the change can
reach to the first old border behind it.

Whether two tokens are neighbours follows from the merges that made them: as merges come in the order of ranks,
the left one's last symbol and the right one's first symbol stand beside each other for a span of ranks,
and the border breaks if they merge within that span.

Defined results: null text counts as empty; an empty text has no ids; texts of any length are encoded whole, also as
one piece; special tokens in a text are ordinary text; rows are independent, so repeated rows, ties and columns with
other names don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, tidied

#: Entries of all tables that are kept within a task, and text that is encoded at a time.
KEPT_PIECES = 1_000_000
CHUNK_CHARS = 1_500_000
#: Pieces of up to so many bytes are encoded together, longer ones by themselves.
SHORT = 40
NEVER = 1 << 60
#: White space of several characters with a space or a line's end among them; other white space, whose presence is told first, as that is quicker.
BESIDE = re.compile(r"[ \n]\s|\s[ \n]")
TOGETHER = ("  ", " \n", "\n ", "\n\n")
OTHER_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
#: The public pattern's way to cut is known, so that a look-up by units holds for it.
KNOWN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Code points that Unicode counts as letters or numbers only after version 16, whose classes
# the library uses.
NEWER_LETTERS = (
    "՘ ֋-֌ ࢏ ౜ ೜ ₏ ₝-₟ ꟎-꟏ ꟒ ꟔ ꟝ ꟢ ꟱ ꭬-꭭ "
    "\U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb \U00011df1 "
    "\U00016ea0-\U00016eb8 \U00016ebb-\U00016ed3 \U00016ff2-\U00016ff3 \U000187f8-\U000187ff \U00018cd6-\U00018cda \U00018d09-\U00018d20 "
    "\U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 \U0001b123-\U0001b128 \U0001b168 \U0001d6a6 \U0001df1f-\U0001df24 "
    "\U0001df2b-\U0001df81 \U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de \U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 "
    "\U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff \U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead "
    "\U000323b0-\U00033479 \U0003d000-\U0003fc3f"
).replace(" ", "")
NEWER_NUMBERS = "\U00011de0-\U00011de9 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 \U00016ff4-\U00016ff6".replace(" ", "")


class Pieces:
    """Cuts a text into the matches of a pattern, with letters and numbers as Unicode 16 has them."""

    def __init__(self, pattern: str):
        classes = {
            r"[^\s\p{L}\p{N}]": rf"[[^\s\p{{L}}\p{{N}}]||[{NEWER_LETTERS}{NEWER_NUMBERS}]]",
            r"\p{L}": rf"[\p{{L}}--[{NEWER_LETTERS}]]",
            r"\p{N}": rf"[\p{{N}}--[{NEWER_NUMBERS}]]",
        }
        self.exact = regex.compile(re.sub("|".join(map(re.escape, classes)), lambda m: classes[m[0]], pattern), regex.V1)
        self.plain = regex.compile(pattern)
        self.known = pattern == KNOWN
        self.newer = regex.compile(f"[{NEWER_LETTERS}{NEWER_NUMBERS}]")

    def of(self, text: str) -> regex.Pattern:
        if text.isascii():
            return self.plain
        try:
            text.encode("latin-1")  # the newer ones are beyond
            return self.plain
        except UnicodeEncodeError:
            return self.exact if self.newer.search(text) else self.plain


def mixed_space(text: str) -> bool:
    """Whether a text begins or ends with white space or has spaces or line ends beside other white space."""
    return text[0].isspace() or text[-1].isspace() or any(x in text for x in TOGETHER) or any(x in text for x in OTHER_SPACE) and BESIDE.search(text) is not None


class Ranks:
    """A vocabulary of byte strings in the order of their merges."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        n = max(self.rank.values()) + 1
        self.bytes_of = [b""] * n
        for token, i in self.rank.items():
            self.bytes_of[i] = token
        self.longest = max(map(len, self.rank))
        self.pieces = Pieces(pattern)
        self.size_of = np.array(list(map(len, self.bytes_of)), np.int64)
        self.start_of = np.cumsum(self.size_of) - self.size_of
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._grow()
        self._walk()
        self.forget()

    def forget(self) -> None:
        #: Ids of units at the start of a line and behind a space, ids of pieces, and pairs of tokens that have been looked at.
        self.first: dict[str, bytes] = {}
        self.after: dict[str, bytes] = {}
        self.kept: dict[str, bytes] = {}
        self.known: dict[int, bool] = {}

    def _grow(self) -> None:
        """Adds the tokens in the order of ranks, each with its last symbols and its first symbols from the outermost in, and until which rank they last."""
        self.made: dict[bytes, int] = {}
        self.tail: dict[bytes, list[tuple[bytes, int]]] = {}
        self.head: dict[bytes, list[tuple[bytes, int]]] = {}
        self.ends = ahocorasick.Automaton()
        for token, rank in sorted(self.rank.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.made[token], self.tail[token], self.head[token] = rank, [(token, NEVER)], [(token, NEVER)]
            for at in range(1, len(token)):
                a, b = token[:at], token[at:]
                if a in self.made and b in self.made and self.beside(a, b):
                    ending = [(s, min(until, rank)) for s, until in self.tail[b]]
                    starting = [(s, min(until, rank)) for s, until in self.head[a]]
                    self.made[token], self.tail[token], self.head[token] = rank, [(token, NEVER), *ending], [(token, NEVER), *starting]
                    break
            if token in self.made:
                self.ends.add_word(token.decode("latin-1"), (len(token), rank))
        if any(bytes([i]) not in self.made for i in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.ends.make_automaton()

    def beside(self, a: bytes, b: bytes) -> bool:
        """Whether the bytes of both together encode as these two tokens."""
        ends, starts = self.tail[a], self.head[b]
        i, j = len(ends) - 1, len(starts) - 1
        while True:
            (x, x_until), (y, y_until) = ends[i], starts[j]
            rank = self.made.get(x + y, NEVER)
            if rank < x_until and rank <= y_until and rank != NEVER:
                return False
            if not i and not j:
                return True
            if x_until <= y_until:
                i -= 1
            if y_until <= x_until:
                j -= 1

    def pair(self, a: int, b: int) -> bool:
        found = self.known.get(a << 32 | b)
        if found is None:
            found = self.known[a << 32 | b] = self.beside(self.bytes_of[a], self.bytes_of[b])
        return found

    def _walk(self) -> None:
        """The tokens read from behind, as a tree: the children of the root and its children in a dense table, all others by sorted keys."""
        child: dict[int, int] = {}
        token_of = [-1, *(self.made[bytes([i])] for i in range(256))]
        for token, rank in self.made.items():
            node = 1 + token[-1]
            for byte in token[-2::-1]:
                new = child.setdefault(node << 8 | byte, len(token_of))
                if new == len(token_of):
                    token_of.append(-1)
                node = new
            token_of[node] = rank
        keys = np.array(sorted(child), np.int64)
        nodes = np.array([child[k] for k in keys.tolist()], np.int64)
        self.token_of = np.array(token_of, np.int64)
        self.dense = np.zeros(257 << 8, np.int64)
        near = keys < 257 << 8
        self.dense[keys[near]] = nodes[near]
        self.keys, self.nodes = np.r_[keys[~near], np.int64(NEVER)], np.r_[nodes[~near], 0]

    def candidates(self, flat: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """By their length, from 1: where tokens end and which, in the order of `at`, the place within a piece."""
        ends, node, found, size = np.arange(len(flat)), 1 + flat.astype(np.int64), [], 1
        while len(ends):
            token = self.token_of[node]
            hit = ends[token >= 0]
            order = np.argsort(at[hit], kind="stable")
            found.append((hit[order], token[token >= 0][order]))
            more = at[ends] >= size
            ends, node = ends[more], node[more]
            key = node << 8 | flat[ends - size]
            if size == 1:
                node = self.dense[key]
            else:
                near = np.searchsorted(self.keys, key)
                node = np.where(self.keys[near] == key, self.nodes[near], 0)
            ends, node = ends[node > 0], node[node > 0]
            size += 1
        return found

    def beside_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys, known = (a << 32 | b).tolist(), self.known
        found = list(map(known.get, keys))
        if None in found:
            for k in {k for k, f in zip(keys, found, strict=True) if f is None}:
                self.pair(k >> 32, k & 0xFFFFFFFF)
            found = list(map(known.__getitem__, keys))
        return np.array(found, bool)

    def encode_pieces(self, raws: list[bytes]) -> list[bytes]:
        """The ids of many pieces, all prefixes of one length at once."""
        size = np.fromiter(map(len, raws), np.int64, len(raws))
        flat, stop = np.frombuffer(b"".join(raws), np.uint8), np.cumsum(size)
        start = stop - size
        at = np.arange(len(flat)) - np.repeat(start, size)
        last = np.full(len(flat), -1, np.int64)
        found = self.candidates(flat, at)
        borders = [np.searchsorted(at[ends], np.arange(size.max(initial=0) + 1)) for ends, _ in found]
        for j in range(size.max(initial=0)):
            for k in range(min(j + 1, len(found)), 0, -1):
                lo, hi = borders[k - 1][j], borders[k - 1][j + 1]
                ends, token = found[k - 1][0][lo:hi], found[k - 1][1][lo:hi]
                free = last[ends] < 0
                ends, token = ends[free], token[free]
                if len(ends) and k <= j:
                    ok = self.beside_all(last[ends - k], token)
                    ends, token = ends[ok], token[ok]
                last[ends] = token
        word, cur, words, tokens = np.arange(len(raws)), stop - 1, [], []
        while len(word):
            token = last[cur]
            words.append(word)
            tokens.append(token)
            cur = cur - self.size_of[token]
            more = cur >= start[word]
            word, cur = word[more], cur[more]
        order = np.argsort(np.concatenate(words[::-1]), kind="stable") if words else np.zeros(0, np.int64)
        ids = (np.concatenate(tokens[::-1])[order] if tokens else order).astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(np.concatenate(words), minlength=len(raws))) * 4 if words else order
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)] if words else []

    def learn(self, pieces: set[str]) -> None:
        """Puts the ids of new pieces into the table; a token is itself, as in the library."""
        short, raws = [], []
        for piece in pieces.difference(self.kept):
            raw = piece.encode("utf-8", "surrogatepass")
            if raw in self.rank:
                self.kept[piece] = self.rank[raw].to_bytes(4, "little")
            elif len(raw) <= SHORT:
                short.append(piece)
                raws.append(raw)
            else:
                ids = Prefixes(self, raw).ids()
                self.kept[piece] = struct.pack(f"<{len(ids)}I", *ids)
        self.kept.update(zip(short, self.encode_pieces(raws), strict=True))

    def _whole(self, texts: Iterable[str]) -> dict[str, bytes]:
        found = {t: self.pieces.of(t).findall(t) for t in texts}
        self.learn({p for pieces in found.values() for p in pieces})
        return {t: b"".join(map(self.kept.__getitem__, pieces)) for t, pieces in found.items()}

    def encode_all(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text as little-endian numbers of 32 bits.

        A space or a line's end between two other characters that are no white space always starts a piece, so
        what lies between these is encoded once and looked up after that. Other texts are cut piece by piece.
        """
        if len(self.after) + len(self.first) + len(self.kept) + len(self.known) > KEPT_PIECES:
            self.forget()
        whole = {t for t in texts if t and (not self.pieces.known or mixed_space(t))}
        lines = [[line.split(" ") for line in t.split("\n")] if t and t not in whole else [] for t in texts]
        self.first |= self._whole({line[0] for text in lines for line in text}.difference(self.first) | {"\n"})
        units = list(set().union(*[line[1:] for text in lines for line in text]).difference(self.after))
        joined = "".join([" " + u for u in units])
        pieces = self.pieces.of(joined).findall(joined)
        self.learn(set(pieces))
        ids, starts = list(map(self.kept.__getitem__, pieces)), [i for i, p in enumerate(pieces) if p[0] == " "]
        self.after.update(zip(units, [ids[a] if b == a + 1 else b"".join(ids[a:b]) for a, b in zip(starts, [*starts, len(ids)][1:], strict=True)], strict=True))
        done, first, after, end = self._whole(whole), self.first.__getitem__, self.after.__getitem__, self.first["\n"]
        return [done[t] if t in done else end.join([b"".join([first(line[0]), *map(after, line[1:])]) for line in text]) if t else b"" for t, text in zip(texts, lines, strict=True)]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, gathered from one flat array of all tokens."""
        size = self.size_of[ids]
        total = int(size.sum())
        shift = self.start_of[ids] - (np.cumsum(size) - size)
        return self.flat[np.arange(total) + np.repeat(shift, size)].tobytes()


class Prefixes:
    """Of each prefix of some bytes the last token of its encoding; bytes can be appended."""

    def __init__(self, ranks: Ranks, raw: bytes = b""):
        self.ranks, self.raw, self.last = ranks, b"", []
        self.append(raw)

    def append(self, more: bytes) -> Prefixes:
        ranks, last, done = self.ranks, self.last, len(self.raw)
        known, pair = ranks.known, ranks.pair
        again = max(0, done - ranks.longest + 1)
        text = (self.raw[again:] + more).decode("latin-1")
        for at, (size, token) in ranks.ends.iter(text):  # at each place the longest token first
            end = at + 1 + again
            if end <= done:
                continue
            if end != size:
                before = last[end - size - 1]
                beside = known.get(before << 32 | token)
                if beside is None:
                    beside = pair(before, token)
                if not beside:
                    continue
            last.append(token)
            done = end
        self.raw += more
        return self

    def ids(self, size: int | None = None) -> list[int]:
        """The ids of the first `size` bytes (all, if not given), read from the end."""
        found, end, last, sizes = [], len(self.raw) if size is None else size, self.last, self.ranks.bytes_of
        while end:
            token = last[end - 1]
            found.append(token)
            end -= len(sizes[token])
        return found[::-1]


class EncodedText:
    """A text with the borders and prefixes of its pieces, for appends and edits."""

    #: A match can depend on so many characters behind its end.
    REACH = 2

    def __init__(self, ranks: Ranks, text: str = ""):
        self.ranks, self.text = ranks, ""
        self.starts: list[int] = []
        self.found: list[Prefixes] = []
        self.encoded_chars = 0
        self.replace(0, 0, text)

    def append(self, more: str) -> EncodedText:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> EncodedText:
        """The text with [start, end) replaced; `encoded_chars` says how much of it was encoded anew."""
        old, moved = self.text, len(new) - (end - start)
        text = old[:start] + new + old[end:]
        # pieces that end REACH before the change stay; where a later match begins at an old border behind it, the rest stays
        ends = [*self.starts[1:], len(old)] if self.starts else []
        kept = bisect_right(ends, start - self.REACH)
        at = ends[kept - 1] if kept else 0
        starts, found, tail, began = self.starts[:kept], self.found[:kept], len(self.starts), at
        pattern = self.ranks.pieces.exact
        while at < len(text):
            if at >= start + len(new):
                same = bisect_left(self.starts, at - moved)
                if same < len(self.starts) and self.starts[same] == at - moved:
                    tail = same
                    break
            match = pattern.match(text, at)
            piece = match.group()
            # what was encoded of the same piece before is a prefix to go on from
            before = self.found[kept] if len(found) == kept < len(self.found) and piece.encode("utf-8", "surrogatepass").startswith(self.found[kept].raw) else None
            raw = piece.encode("utf-8", "surrogatepass")
            if before is not None:
                grown = Prefixes(self.ranks)
                grown.raw, grown.last = before.raw, list(before.last)
                found.append(grown.append(raw[len(before.raw) :]))
            else:
                found.append(Prefixes(self.ranks, raw))
            starts.append(at)
            at = match.end()
        self.encoded_chars = at - began
        self.text, self.starts, self.found = text, starts + [s + moved for s in self.starts[tail:]], found + self.found[tail:]
        return self

    def ids(self) -> list[int]:
        rank = self.ranks.rank
        return [i for p in self.found for i in ([rank[p.raw]] if p.raw in rank else p.ids())]


@lru_cache(maxsize=2)
def ranks(path: str, pattern: str) -> Ranks:
    return Ranks(path, pattern)


def public_ranks() -> tuple[str, str]:
    """File and pattern of the public vocabulary of 50k tokens; found again on each executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encoded(batches: Iterator[pa.RecordBatch], path: str | None, pattern: str | None, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, n_tokens, ids_sha256, decoded_sha256[, ids]), a few MB of text at a time."""
    own = public_ranks()
    r = ranks(path or own[0], pattern or own[1])
    r.forget()  # nothing is kept from one task to the next
    for batch in batches:
        texts, at = batch.column(1), 0
        while at < len(texts):
            some: list[str] = []
            chars = 0
            while at + len(some) < len(texts) and chars < CHUNK_CHARS:
                some.append(texts[at + len(some)].as_py() or "")
                chars += len(some[-1])
            raws = r.encode_all(some)
            n, hashes, decoded, kept = [], [], [], []
            for raw in raws:
                ids = np.frombuffer(raw, "<u4")
                n.append(len(ids))
                hashes.append(hashlib.sha256(raw).hexdigest())
                decoded.append(hashlib.sha256(r.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(ids.astype(np.int32))
            columns = [batch.column(0).slice(at, len(n)), pa.array(n, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            at += len(n)
            yield pa.RecordBatch.from_arrays(columns, names=names)
    r.forget()


def encode_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row for each row of docs: id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids. No shuffle."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(lambda it: tidied(encoded(it, path, pattern, with_ids)), schema)


def decode_ids(rows: DataFrame, id_col: str = "id", ids_col: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """id and `decoded`, the bytes of a list of ids; null ids are an empty list. No shuffle."""
    kept = rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = public_ranks()
        r = ranks(path or own[0], pattern or own[1])
        for batch in batches:
            raw = [r.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["id", "decoded"])

    return kept.mapInArrow(lambda it: tidied(run(it)), f"id {kept.schema['id'].dataType.simpleString()}, decoded binary")


def encode_edits(rows: DataFrame, id_col: str = "id", text_col: str = "text", edits_col: str = "edits", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """id, ids and `encoded_chars` of texts after their edits: arrays of structs (start, end, new), applied one after the other.

    Only what an edit can reach is encoded anew; encoded_chars counts that, the first encoding not included.
    """
    kept = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(edits_col).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = public_ranks()
        r = ranks(path or own[0], pattern or own[1])
        for batch in batches:
            ids, again = [], []
            for text, edits in zip(batch.column(1), batch.column(2), strict=True):
                one, n = EncodedText(r, text.as_py() or ""), 0
                for e in edits.as_py() or []:
                    n += one.replace(e["start"], e["end"], e["new"]).encoded_chars
                ids.append(one.ids())
                again.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(again, pa.int64())], names=["id", "ids", "encoded_chars"])

    return kept.mapInArrow(lambda it: tidied(run(it)), f"id {kept.schema['id'].dataType.simpleString()}, ids array<int>, encoded_chars long")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_bytes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
