from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from graftline.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(docs, least_chars, least_n, typos):
    n = Counter()
    for doc, text in docs:
        for r in RUN.findall(text or ""):
            r = r.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{r}".encode())
            n[r[: h % len(r)] + r[h % len(r) + 1 :] if typos and h % typos == 0 else r] += 1
    return {w: k for w, k in n.items() if len(w) >= least_chars and k >= least_n}


def brute_groups(words, times):
    form, rows = {}, {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
        rows[w] = len(near)
    found = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.append((w, n, form[w], root, rows[w], words[form[w]] if form[w] else None))
    return sorted(found)


@pytest.mark.parametrize("typos", [None, 3])
def test_equals_brute_force(spark, typos):
    rng = np.random.default_rng(3)
    base = ["colour", "planet", "planets", "aaaaaa", "aaaaaaa", "ananas", "naïveté", "straße", "ababab", "bababa", "ÀÉîÿàâ"]
    docs = [(i, " ".join(rng.choice(base, rng.integers(0, 60)))) for i in range(60)]
    docs += [(70, None), (71, ""), (None, "Planet planet-PLANET"), (5, docs[5][1]), (5, docs[5][1]), (72, "colour," * 3000), (73, "x" * 5000 + "日本planet語")]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n long, word string")
    counts = spelling.word_counts(frame, typos=typos, least_n=2)
    want = brute_words(docs, 6, 2, typos)
    assert {r["word"]: r["n"] for r in counts.collect()} == want
    got = spelling.spelling_groups(counts, 2).select("word", "n", "form", "root", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == brute_groups(want, 2)


def test_all_near_words_are_found(spark):
    """Few letters make many near words, many equal bigrams and many ties."""
    rng = np.random.default_rng(4)
    words = {"".join(rng.choice(list("abé"), rng.integers(4, 9))): int(rng.integers(1, 400)) for _ in range(500)}
    frame = spark.createDataFrame(sorted(words.items()), "word string, n long")
    got = spelling.spelling_groups(frame, 3).select("word", "n", "form", "root", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == brute_groups(words, 3)


def test_long_ways_and_edges(spark):
    # each word is five times as frequent as the one before and one edit from it
    chain = [("abcdefghij"[: 5 + i], 5**i) for i in range(6)]
    rows = [*chain, ("abc", 1), ("ab", 9), (None, 7)]
    got = {r["word"]: (r["root"], r["n_near"]) for r in spelling.spelling_groups(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["abcde"] == ("abcdefghij", 1) and got["abcdef"] == ("abcdefghij", 2)
    assert got["abc"] == ("abc", 0) and got["ab"] == ("ab", 0) and got[None] == (None, 0)
    assert spelling.spelling_groups(spark.createDataFrame([], "word string, n long")).count() == 0
