from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from graftline.llm import exact_dedup as ed


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest().upper()) for i in ids]
    return sorted(out, key=str)


def got(groups):
    return sorted(map(tuple, groups.withColumn("digest", F.hex("digest")).collect()), key=str)


@pytest.mark.parametrize(("levels", "fan_in"), [(3, 1), (4, 3)])
def test_groups_equal_brute_force(spark, levels, fan_in):
    rng = random.Random(levels)
    rows = [(i, rng.choice(["hot text"] * 5 + [f"t {rng.randrange(40)}", None, "", " ", "a\t\nb", "a b", "long " * 5000])) for i in rng.sample(range(10**6), 300)]
    rows += [(None, "a b"), (None, "only null"), rows[0], rows[1]]
    docs = spark.createDataFrame([(*r, "x", 1, True) for r in rows], "doc_id long, text string, digest string, run int, kept boolean")
    assert got(ed.exact_groups(docs, levels=levels, fan_in=fan_in)) == brute(rows)
    assert ed.exact_groups(docs.limit(0)).count() == 0


def test_rounds_deal_runs_by_digest(spark):
    rows = [(i, "hot" if i % 3 else f"t{i}") for i in range(400)]
    leaf = ed.leaf_rows(ed.digests(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"), 4).cache()
    leaves, last = ed.tree_merge(leaf, 4, 2)
    hot = lambda df: df.where("n_bytes = 3 AND n > 1").count()
    assert hot(leaves) == 16 and hot(last) == 1
    assert last.where("run <> home").isEmpty() and last.select("run").distinct().count() > 8
    half = leaves.withColumn("run", F.col("run").bitwiseAND(F.lit(12)).bitwiseOR(F.col("home").bitwiseAND(F.lit(3))))
    assert hot(ed.merge_runs(ed.sorted_runs(half))) == 4
    plan = ed.merge_runs(ed.sorted_runs(half))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and "Window" in plan
    with pytest.raises(RuntimeError, match="level 2"):
        ed.checked(ed.sorted_runs(half), 2, 400)


def test_dedup_keeps_columns_and_repeated_identifiers(spark):
    rows = [(1, "a", "p"), (2, "a", "q"), (3, None, "r"), (4, "", "s"), (5, "b", "t"), (5, "c", "u"), (5, "c", "t"), (6, "c", "v"), (None, "a", "w"), (None, "z", "x")]
    names = ["lost", "twice", "digest", "own", "turn", "kept"]
    docs = spark.createDataFrame([(*r, *"123456") for r in rows], "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    out = ed.exact_dedup(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.source) for r in out.collect() if r.doc_id) == [(1, "a", "p"), (3, None, "r"), (5, "b", "t"), (5, "c", "t")]
    assert [r.text for r in out.where("doc_id IS NULL").collect()] == ["z"]
    assert sorted(r.doc_id for r in ed.exact_dedup(docs.where("doc_id < 5")).collect()) == [1, 3]


def test_levels_follow_the_rows():
    assert [ed.levels_for(n) for n in (0, 1, 64 * ed.RUN_ROWS, 64 * ed.RUN_ROWS + 1, 1000 * ed.RUN_ROWS)] == [6, 6, 6, 7, 10]
