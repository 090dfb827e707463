from __future__ import annotations

import hashlib
import itertools
import random

from pyspark.sql import functions as F

from graftline.llm import spot_signatures as spot


def brute(text):
    import regex

    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    content = [(i, w) for i, w in enumerate(words) if w not in spot.ANCHORS]
    chains = set()
    for i, w in enumerate(words):
        if w in spot.ANCHORS:
            after = [c for j, c in content if j > i][: spot.CHAIN]
            if len(after) == spot.CHAIN:
                chains.add((w, *after))
    if words:
        chains |= {tuple(words[i : i + spot.CHAIN]) for i in range(max(1, len(words) - spot.CHAIN + 1))}
    return chains


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def texts(n, seed=3):
    rng = random.Random(seed)
    vocab = [*spot.ANCHORS[:12], *(f"w{i}" for i in range(60))]
    return [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_query_against_brute_force(spark, tmp_path):
    all_texts = [*texts(40), None, "", "x", "xx yy zz", "The, the; THE of!", "the cat and dog " * 900, "é🙂" * 9]
    rows = [(i * 3, t, 1) for i, t in enumerate(all_texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in spot.op9_spot_signatures(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for (i, t, _), (_, u, _) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, u = t or "", u or ""
        q = len(t) // 4
        edited = t[: len(t) - q] + u[:q]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(brute(t), brute(edited))) < 1e-12
        assert abs(r.near_next - jaccard(brute(t), brute(u))) < 1e-12
        assert len(r.fingerprint.split()) == len(brute(t))


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "other"), (None, "the x y"), (2, None)], "doc_id long, text string")
    assert spot.edited_and_next(docs).count() == 5
    assert spot.edited_and_next(docs.limit(0)).count() == 0


def test_near_pairs_against_brute_force(spark):
    base = texts(25, 5)
    rng = random.Random(7)
    near = []
    for t in base:
        w = t.split()
        for _ in range(len(w) // 25):
            w[rng.randrange(len(w))] = "changed"
        near += [" ".join(w), t]
    rows = list(enumerate([*base, *near, None]))
    members, pairs = spot.near_pairs(spark.createDataFrame(rows, "doc_id long, text string"), similar=0.8)
    name = {r.id: r.class_id for r in members.collect()}
    sets = {i: brute(t) for i, t in rows}
    assert all(sets[i] == sets[c] and c <= i for i, c in name.items()) and len(name) == len(rows)
    reps = sorted(set(name.values()))
    want = {(a, b) for a, b in itertools.combinations(reps, 2) if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want
    assert pairs.where(F.col("a") >= F.col("b")).count() == 0


def test_likeness_across_any_number_of_signatures(spark):
    """An edit that gains or loses one anchor costs as little in texts with few as in texts with many of them."""
    rows = []
    for n in range(12, 21):
        sentences = [f"word{i} the left{i} right{i} other{i} more{i}" for i in range(n)]
        rows.append((n, " ".join(sentences), " ".join([*sentences[:-1], sentences[-1].replace("the", "thee")])))
    both = spark.createDataFrame(rows, "n int, a string, b string")
    got = {r.n: r.x for r in both.select("n", spot.likeness(spot.signatures(F.col("a")), spot.signatures(F.col("b"))).alias("x")).collect()}
    assert min(got.values()) > 0.85 and max(got.values()) - min(got.values()) < 0.05


def test_an_identifier_with_two_texts_keeps_both_links(spark):
    one, two = (" ".join(f"{c}{i} the {c}x{i}" for i in range(40)) for c in "pq")
    rows = [(8, one, "k"), (8, two, "k"), (20, two + " z", "k"), (30, one + " z", "k")]
    members, pairs = spot.near_pairs(spark.createDataFrame(rows, "doc_id long, text string, key string"))
    assert sorted((r.a, r.b) for r in pairs.collect()) == [(8, 20), (8, 30)]
    assert sorted(map(tuple, members.collect())) == [(8, 8), (8, 8), (20, 20), (30, 30)]


def test_signatures_are_sorted_and_chained_without_work_for_every_comparison(spark):
    """Interpreted comparators and slices for every word took most of the query's CPU time."""
    docs = spark.createDataFrame([(t,) for t in (*texts(20), None, "", "the", "x", "of the x")], "text string")
    signed = docs.select("text", *[spot.signatures(F.col("text"), c).alias(f"chain{c}") for c in (1, 2, 3)])
    for r in signed.collect():
        for signs in r[1:]:
            assert signs == sorted(set(signs)) and None not in signs
        assert len(r.chain2) == len(brute(r.text))
    # Sorted as plain numbers: no nulls among them, and no comparator.
    assert not any(signed.schema[f"chain{c}"].dataType.containsNull for c in (1, 2, 3))
    plan = signed.select("chain2")._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan
    assert plan.count("slice(") == 1  # of the words, once for a text
