from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from graftline.llm import language_id as lid

SF = "/root/testdata/sf0.001"


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "bab"]
    rng = np.random.default_rng(1)
    p = np.vstack([rng.random((len(pieces), 2)), np.full((1, 2), lid.UNKNOWN), np.zeros((1, 2))])
    words = ["a", "abab", "bbaab", "c", "a" * 60, "ab" * 40]
    scorer = lid.Scorer(pieces, p)
    scorer.learn(set(words))

    def brute(w):
        w, total = "▁" + w, np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(w) - 1):
            parts, at = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(w[at:i])
                    at = i
            parts.append(w[at:])
            x = np.ones(2)
            for s in parts:
                x = x * (p[pieces.index(s)] if s in pieces else p[-2] if len(s) == 1 else 0)
            total += x
        return np.log(total)

    for w in words[:4]:
        assert np.allclose(scorer.logs[scorer.number[w]], brute(w))
    both = lid.Scorer(pieces, p)
    assert np.allclose(both.long_word("bbaab" * 5), (both.learn({"bbaab" * 5}), both.logs[0])[1])


def test_fit_finds_the_more_likely_pieces():
    p = lid.fit(["▁", "a", "b", "▁a", "▁b"], ["a", "b"], np.array([[9.0, 1.0], [1.0, 9.0]]), 5)
    assert np.allclose(p[:-2].sum(0), 1) and p[3, 0] > p[4, 0] and p[4, 1] > p[3, 1]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lid.identify(docs).join(docs.selectExpr("doc_id AS id", "lang"), "id").where("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.9
    assert all((zlib.crc32(str(r.id).encode()) % 4 == 2) == r.held_out and 0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("labelled", [True, False])
def test_edge_rows(spark, labelled):
    rows = [(1, None, "en", 1), (2, "123 ...", None, 1), (3, "the of and", "en" if labelled else None, 1), (3, "the of and", None, 1), (5, "der die das " * 3000, "de" if labelled else None, 1), (None, "das", None, 1), (7, "x" * 5000, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = lid.identify(docs).collect()
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got if r.id in (1, 2)} == {"und"}
    if labelled:
        assert {r.lang_pred for r in got if r.id not in (1, 2)} <= {"en", "de"}
    else:
        assert {r.lang_pred for r in got} == {"und"}
    assert lid.identify(docs.limit(0)).count() == 0
