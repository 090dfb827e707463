from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from graftline.llm import importance as im

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def brute_features(text: str | None, longest: int) -> list[int]:
    words = WORD.findall((text or "").encode().lower())
    return [zlib.crc32(b" ".join(words[i : i + n])) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent, seed, least, longest, buckets):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(c % buckets for c in brute_features(text, longest))
    for text in target:
        t.update(c % buckets for c in brute_features(text, longest))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    rows = []
    for i, text in docs:
        f = brute_features(text, longest)
        weight = sum(gain(c % buckets) for c in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(brute_features(text, 1))])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1], r[2]))
    for n, r in enumerate(fit[: len(fit) * percent // 100], 1):
        r[4] = n
    return sorted((tuple(r[:5]) for r in rows), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=90), min_size=2, max_size=2))
def test_crc_of_two_strings(parts):
    a, b = parts
    got = im.combined(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))
    assert got[0] == zlib.crc32(a + b)


def test_crc_behind_a_very_long_string():
    b = bytes(3_000_001)
    assert im.combined(np.array([zlib.crc32(b"a")], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))[0] == zlib.crc32(b"a" + b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB é,9 ", max_size=30) | st.text(max_size=30), max_size=5), st.integers(1, 4))
def test_features_equal_joined_strings(texts, longest):
    crc, owner, count = im.features([t.encode() for t in texts], longest)
    for i, t in enumerate(texts):
        assert Counter(crc[owner == i].tolist()) == Counter(brute_features(t, longest))
        assert count[i] == len(brute_features(t, 1))


def test_long_words():
    texts = [b"a" * n for n in (1, 63, 64, 65, 100_000)] + [b""]
    assert im.features(texts, 1)[0].tolist() == [zlib.crc32(t) for t in texts if t]


@pytest.mark.parametrize("longest", [1, 3])
def test_equals_brute_force(spark, longest):
    names = "alpha beta gamma delta eps Zeta été x1 42".split()
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(rng.choice(names, rng.integers(0, 40)))) for i in range(120)]
    docs += [(200, None), (201, ""), (None, "beta beta gamma"), (5, docs[5][1]), (5, docs[5][1]), (300, "alpha " * 5000), (301, "...")]
    target = ["gamma delta gamma", None, "", "été beta"]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, id long, weight string")
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = im.resampled(frame, bench, 30, 7, 3, longest=longest, buckets=50)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target, 30, 7, 3, longest, 50)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    assert sorted(map(tuple, im.resampled(docs, none, 100, 7, 0, buckets=10).collect()), key=str) == brute([(1, "a b"), (2, "c")], [], 100, 7, 0, 1, 10)
    assert im.resampled(docs.limit(0), none).count() == 0
    with pytest.raises(ValueError):
        im.bucket_counts(docs, buckets=0)
