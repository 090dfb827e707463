"""Words, runs of words and their 64-bit hashes for many texts at once, in numpy.

A word's hash mixes its length and its bytes, eight at a time; words of more than LONG bytes are
hashed by BLAKE2b. Different words can still have equal hashes, so what decides on a result is compared as
text: `Words.agree` tells whether words with equal hashes are equal, `exact_shingles` numbers shingles by
their words where they are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at a time.
CHUNK_BYTES = 1_000_000
#: Words up to so many bytes are hashed together.
LONG = 64
_RANDOM = np.random.default_rng(20240229).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_FIRST, _SECOND, _THIRD = _RANDOM[:3]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: The lowest bytes of a number, by how many of them count.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray, key: np.uint64 = _FIRST) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = x ^ key
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts, one text behind the other."""

    def __init__(self, texts: Sequence[bytes], lower: bool = False, seed: int = 0):
        raw = np.frombuffer(b" ".join([*texts, b" " * 8]), np.uint8)
        if lower:
            raw = _LOWER[raw]
        edge = np.diff(np.r_[True, _SPACE[raw], True].astype(np.int8))
        #: First byte of each word, and the byte after its last.
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.raw = raw
        self._eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        #: A hash of each word's bytes.
        self.hash = self._hashes(np.uint64(seed))
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        #: First byte of each text, and the number of its first word.
        self.text_start = np.cumsum(sizes) - sizes
        self.first = np.searchsorted(self.start, np.r_[self.text_start, len(raw)])
        self.count = np.diff(self.first)

    def _part(self, words: np.ndarray, at: int) -> np.ndarray:
        """Eight bytes of each word from its byte `at` on, zeros behind its end."""
        return self._eight[self.start[words] + at] & _MASK[np.minimum(8, self.end[words] - self.start[words] - at)]

    def _hashes(self, seed: np.uint64) -> np.ndarray:
        size = self.end - self.start
        out = mix(size.astype(np.uint64) ^ (seed << np.uint64(32)), _THIRD)
        live = np.flatnonzero(size <= LONG)
        for at in range(0, LONG, 8):
            live = live[size[live] > at]
            if not len(live):
                break
            out[live] = mix(out[live] + self._part(live, at))
        for i in np.flatnonzero(size > LONG).tolist():
            digest = hashlib.blake2b(self.raw[self.start[i] : self.end[i]].tobytes(), digest_size=8, salt=int(seed).to_bytes(8, "little"))
            out[i] = int.from_bytes(digest.digest(), "little")
        return out | np.uint64(1)

    def agree(self) -> bool:
        """Whether words with equal hashes are equal, byte for byte."""
        order = np.argsort(self.hash, kind="stable")
        same = np.flatnonzero(self.hash[order[1:]] == self.hash[order[:-1]])
        a, b = order[same], order[same + 1]
        size = self.end - self.start
        if (size[a] != size[b]).any():
            return False
        for i, j in zip(*(x[size[a] > LONG].tolist() for x in (a, b)), strict=True):
            if not np.array_equal(self.raw[self.start[i] : self.end[i]], self.raw[self.start[j] : self.end[j]]):
                return False
        short = size[a] <= LONG
        a, b = a[short], b[short]
        for at in range(0, LONG, 8):
            live = size[a] > at
            a, b = a[live], b[live]
            if (self._part(a, at) != self._part(b, at)).any():
                return False
        return True

    def spelled(self, a: int, b: int) -> bytes:
        """Words a to b with one space between each two."""
        raw = self.raw[self.start[a] : self.end[b - 1]].tobytes() if b > a else b""
        return b" ".join(raw.split())

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of the first word, and hash, of each run of n words inside one text."""
        own = np.maximum(0, self.count - n + 1)
        at = np.repeat(self.first[:-1] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        return at, run_hash(self.hash, at, n)


def run_hash(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of runs of n words."""
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(3) + hashes[at + k], _SECOND)
    return out


class RunHashes:
    """Hashes of runs of any length up to `most`, from those of runs whose lengths are powers of two."""

    def __init__(self, hashes: np.ndarray, most: int):
        self.levels = [hashes]
        while 2 << (len(self.levels) - 1) <= most:
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(mix(last[:-half] * np.uint64(3) + last[half:], _SECOND) if len(last) > half else last[:0])

    def at(self, first: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Hashes of the runs of n words from word `first` on: two runs of a power of two cover each."""
        n = np.broadcast_to(np.asarray(n, np.int64), first.shape)
        out = np.zeros(len(first), np.uint64)
        for k, level in enumerate(self.levels):
            own = np.flatnonzero((n >= 1 << k) & (n < 2 << k))
            if len(own):
                a, m = first[own], n[own]
                out[own] = mix(mix(level[a] + m.astype(np.uint64), _SECOND) + level[a + m - (1 << k)], _THIRD)
        return out


def _shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word, number of words and hash of each shingle; one of all words where a text has fewer."""
    n = np.where(w.count >= size, size, w.count)
    own = np.where(w.count > 0, w.count - n + 1, 0)
    doc = np.repeat(np.arange(len(own)), own)
    at = np.repeat(w.first[:-1] - (np.cumsum(own) - own), own) + np.arange(own.sum())
    n = n[doc]
    h = np.zeros(len(at), np.uint64)
    for k in range(1, size + 1):
        few = np.flatnonzero(n == k)
        if len(few):
            h[few] = mix(run_hash(w.hash, at[few], k), np.uint64(k)) if k < size else run_hash(w.hash, at[few], k)
    return doc, at, n, h


def _distinct(doc: np.ndarray, h: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], np.bincount(doc[keep], minlength=texts)


def exact_shingles(texts: Sequence[bytes], size: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Sorted distinct numbers of shingles, text by text, how many each text has, and whether the numbers are hashes.

    Words are lower-cased. Numbers are hashes that depend on nothing but the shingle, as long as shingles
    of these texts with equal hashes are equal as text; if two are not, all of these texts' shingles are numbered anew.
    Either way, two shingles of these texts have one number only if they are equal.
    """
    w = Words(texts, lower=True)
    doc, at, n, h = _shingles(w, size)
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    a, b = order[same], order[same + 1]
    good = bool((n[a] == n[b]).all()) and w.agree()
    for k in range(size if good else 0):
        live = n[a] > k
        good = good and bool((w.hash[at[a[live]] + k] == w.hash[at[b[live]] + k]).all())
    if not good:
        number: dict[bytes, int] = {}
        spelled = (w.spelled(x, x + m) for x, m in zip(at.tolist(), n.tolist(), strict=True))
        h = np.fromiter((number.setdefault(s, len(number)) for s in spelled), np.uint64, len(at))
    return (*_distinct(doc, h, len(texts)), good)


def shingle_sets(texts: Sequence[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes, text by text, and how many each text has."""
    doc, _, _, h = _shingles(Words(texts, lower=True), size)
    return _distinct(doc, h, len(texts))


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """The texts in order as UTF-8, a bounded size at a time (one text at least); null is empty."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > most:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, held
