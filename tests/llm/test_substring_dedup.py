from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from graftline.llm import substring_dedup as sd


def brute(rows, window):
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    for i in order:
        w = (rows[i][1] or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[rows[i][0]] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def corpus(seed, window, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(rng.choice([3, 40, 400]))]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(window - 2, 3 * window))] for _ in range(5)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            w += p[a : len(p) - rng.randint(0, 5)] if rng.random() < 0.5 else [rng.choice(vocab) for _ in range(rng.randint(0, 2 * window))]
        rows.append((rng.randrange(10**9), rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(rng.randrange(10**9), t) for _, t in rng.sample(rows, 8)]
    return list(dict(rows).items())


@pytest.mark.parametrize(("seed", "window", "edge"), [(1, 20, 8), (2, 20, 8), (3, 20, 8), (4, 8, 3), (5, 8, 3)])
def test_equals_brute_force(spark, seed, window, edge):
    rows = corpus(seed, window)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in sd.remove_repeats(docs, window=window, edge=edge).collect()}
    want = brute(rows, window)
    assert got == want and any(r[1] for r in want.values())


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(sd, "BROADCAST_LONGS", 8)  # shuffled joins, too
    long = " ".join(f"x{i}" for i in range(60000))
    base = " ".join(f"b{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, "a b"), (4, base), (5, "p " + base + " q"), (6, long), (7, long + " tail"), (8, "same " * 100), (9, "é" + base)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, key int")
    got = {r.id: r for r in sd.remove_repeats(docs).collect()}
    assert {k: (r.n_words, r.n_removed, r.kept_sha256) for k, r in got.items()} == brute(rows, 20)
    assert got[5].spans == [[1, 31]] and got[7].spans == [[0, 60000]]
    assert sd.remove_repeats(docs.limit(0)).count() == 0


def test_repeated_and_null_identifiers(spark):
    base = " ".join(f"b{i}" for i in range(30))
    rows = [(None, base), (4, base + " z"), (4, base + " z"), (4, "other " + base), (9, "q")]
    got = sorted((str(r.id), r.n_words, r.n_removed) for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("4", 31, 30), ("4", 31, 30), ("4", 31, 30), ("9", 1, 0), ("None", 30, 0)]


def test_long_words_that_alike_sums_would_take_for_equal(spark):
    for letters in (1024, 4096):
        one = "".join("ab"[bin(i).count("1") % 2] for i in range(letters))
        other = one.translate(str.maketrans("ab", "ba"))
        base = [f"b{i}" for i in range(30)]
        rows = [(1, " ".join([*base, one, "end"])), (3, " ".join([*base, other, "end"])), (4, " ".join([*base, one, "end"]))]
        got = {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == brute(rows, 20) and got[3][1] == 30 and got[4][1] == 32


def test_source_coordinates_catch_equal_hashes(spark, monkeypatch):
    """With a hash that takes many words for one, only the verification at the sources saves the result."""
    right = sd.Words._hashes
    rows = corpus(6, 20, 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    weak = lambda self, seed: right(self, seed) % np.uint64(4) if seed == 0 else right(self, seed)
    keyed = docs.selectExpr("doc_id key", "text")
    run = lambda df, f, kind: spark.createDataFrame(pa.Table.from_batches(list(f(iter(pa.Table.from_pandas(df.toPandas()).combine_chunks().to_batches())))), kind)
    monkeypatch.setattr(type(docs), "mapInArrow", run)
    monkeypatch.setattr(sd.Words, "_hashes", weak)
    summary = keyed.mapInArrow(lambda it: sd._summary(it, 20, 8, 0), "key long, n_words long, n_paths long, whole string")
    assert not sd._verified(keyed, sd.repeated_spans(keyed, summary, 20, 8, 0).cache())[1]
    got = {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in sd.remove_repeats(docs).collect()}
    assert got == brute(rows, 20)


def test_spans_are_compacted_along_their_sources(spark):
    rows = [(5, 10, 3, 1, 0), (5, 13, 2, 1, 3), (5, 15, 1, 2, 40), (5, 60, 1, 1, 50), (6, 13, 2, 1, 3)]
    got = sd.compacted(spark.createDataFrame(rows, "key long, at long, size long, source long, source_at long"), 20)
    assert sorted(map(tuple, got.collect())) == [(5, 10, 24, 1, 0), (5, 15, 20, 2, 40), (5, 60, 20, 1, 50), (6, 13, 21, 1, 3)]
