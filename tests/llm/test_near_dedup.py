from __future__ import annotations

import random
import re

import numpy as np
import pytest

from graftline.llm import near_dedup as nd
from graftline.llm import word_hashes


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            if (rows[i][0] == rows[j][0] and sets[i] and sets[j]) or (sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])):
                parent[root(i)] = root(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[root(i)] = min(k, low.get(root(i), k))
    return [(k, len(s), k if k is None or not s else low[root(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))]


def corpus(seed, families=12, most=14):
    rng = random.Random(seed)
    vocab = [f"W{i}" for i in range(300)]
    passage = [rng.choice(vocab) for _ in range(60)]
    texts = []
    for f in range(families):
        base = [rng.choice(vocab) for _ in range(rng.choice([4, 8, 12, 30, 90, 200]))]
        if f % 3 == 0:
            base[len(base) // 2 : len(base) // 2] = passage
        for _ in range(rng.randint(1, most)):
            w = list(base)
            for _ in range(int(len(w) * rng.choice([0, 0.01, 0.02, 0.04, 0.08]) + rng.random())):
                i = rng.randrange(len(w))
                w[i : i + 1] = rng.choice([[], [rng.choice(vocab)], [w[i], rng.choice(vocab)]])
                w = w or ["x"]
            texts.append(rng.choice([" ", "\n", "  "]).join(w))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "size", "percent", "short"), [(1, 3, 85, 32), (2, 5, 80, 32), (3, 3, 85, 3), (4, 3, 80, 2)])
def test_components_equal_brute_force(spark, monkeypatch, seed, size, percent, short):
    monkeypatch.setattr(nd, "SHORT_LIST", short)  # long lists, in several blocks, too
    monkeypatch.setattr(nd, "BLOCK_ALL", 1500 if short < 32 else nd.BLOCK_ALL)
    monkeypatch.setattr(nd, "BLOCK_FEW", 400 if short < 32 else nd.BLOCK_FEW)
    rows = corpus(seed, 20 if short < 32 else 30, 24)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, nd.near_components(docs, size=size, percent=percent).collect()))
    assert got == sorted(brute(rows, size, percent))
    assert len({r[2] for r in got}) < len(rows)


def test_edge_rows(spark):
    rows = [(5, None), (4, ""), (3, " \n"), (9, "A b"), (2, "a  B"), (None, "a b"), (7, "one"), (7, "one"), (8, "p q r s"), (8, "x y z w"), (11, "x y z w"), (1, "lone words here now"), (12, "long " * 30000), (13, "long " * 40000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component string")
    got = sorted(map(tuple, nd.near_components(docs, size=3, percent=85).collect()), key=str)
    assert got == sorted(brute(rows, 3, 85), key=str)
    assert nd.near_components(docs.limit(0)).count() == 0
    assert sorted(r.doc_id or 0 for r in nd.near_dedup(docs, size=3, percent=85).collect()) == [0, 1, 2, 3, 4, 5, 7, 7, 8, 8, 12]


def test_an_identifier_with_two_texts_links_both(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    rows = [(8, one), (8, two), (20, two + " z"), (30, one + " z"), (40, "lonely text here")]
    got = sorted(map(tuple, nd.near_components(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=85).collect()))
    assert got == sorted(brute(rows, 3, 85)) and {r[2] for r in got} == {8, 40}


def test_sketch_keys_of_pairs_at_the_threshold_meet():
    rng = np.random.default_rng(5)
    for percent in (80, 85):
        for n in [*range(6, 40), 64, 70, 200, 1000]:
            for _ in range(60):
                shared = -(-n * percent // 100)
                rest = n - shared
                values = rng.integers(0, 1 << 63, n, dtype=np.uint64)
                a, b = np.sort(values[: shared + rest // 2]), np.sort(np.r_[values[:shared], values[shared + rest // 2 :]])
                ka, kb = (set(nd._keys(x[: nd.KEEP], len(x)).tolist()) for x in (a, b))
                assert ka & kb
                assert nd.estimates([a[: nd.KEEP]], [b[: nd.KEEP]])[0] >= percent / 100 - nd.MARGIN


def test_long_words_that_alike_sums_would_take_for_equal(spark):
    for letters in (1024, 4096):
        one = "".join("ab"[bin(i).count("1") % 2] for i in range(letters))
        rows = [(1, one), (2, one.translate(str.maketrans("ab", "ba"))), (3, one + " tail of it"), (4, one.upper())]
        got = sorted(map(tuple, nd.near_components(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=85).collect()))
        assert got == sorted(brute(rows, 3, 85)) and [r[2] for r in got] == [1, 2, 3, 1]


def test_shingles_with_equal_hashes_are_told_apart(monkeypatch):
    texts = [b"a b c d e f", b"a b c d e g", b"A  b c", b"x", b""]
    sizes = [4, 4, 1, 1, 0]
    good = nd.exact_shingles(texts, 3)
    assert good[2] and good[1].tolist() == sizes
    right = word_hashes.Words._hashes
    monkeypatch.setattr(word_hashes.Words, "_hashes", lambda self, seed: right(self, seed) % np.uint64(2))
    numbers, counts, by_hash = nd.exact_shingles(texts, 3)
    assert not by_hash and counts.tolist() == sizes and len(np.unique(numbers)) == len(np.unique(good[0]))
