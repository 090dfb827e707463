from __future__ import annotations

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import sentencepiece

import corpus_pipeline
from graftline.llm import language_id, mixing, registry

from .test_near_dedup import brute

SF = "/root/testdata/sf0.001"


def mix_times(rows):
    """Copies of each document by the definition of the mix, for sources without a null."""
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows}
    total, by = Counter(), {}
    for r in rows:
        total[r.source] += size[r.doc_id]
        by.setdefault(r.source, []).append(r.doc_id)
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sorted(total))}
    target, left, free = {}, 1.5 * sum(total.values()), set(total)
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * total[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2 * total[s] for s in over}
        left -= sum(2 * total[s] for s in over)
        free -= over
    times = {}
    for s, ids in by.items():
        goal, at = int(target[s] + 1e-9), 0
        for i in sorted(ids, key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i)):
            taken = sum(max(0, min(at + p + size[i], goal) - (at + p)) for p in (0, total[s]))
            times[i] = int(taken / size[i] + 0.5)
            at += size[i]
    return times


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = {r.id: r for r in language_id.identify(docs).collect()}
    rows = [r for r in docs.orderBy("doc_id").collect() if judged[r.doc_id].lang_pred != "und" and judged[r.doc_id].score >= 0.5]
    seen, unique = set(), []
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
        if key not in seen:
            seen.add(key)
            unique.append(r)
    kept = [r for r, (i, _, low) in zip(unique, brute([(r.doc_id, r.text) for r in unique], 5, 80), strict=True) if i == low]
    assert len(kept) < len(unique) < len(rows)
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter()
    times = mix_times(kept)
    for r in kept:
        ids = lib.encode(r.text, add_bos=True, add_eos=True)
        row = (r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest())
        if times[r.doc_id]:
            want[row] += times[r.doc_id]
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, got.collect())) == want


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), SF)
        assert out.columns == docs.columns and out.count() == 0


def test_stages_take_clashing_columns_nulls_and_repeats(spark):
    names = "lost twice digest own turn kept key of total rows slots copy slot id h sketch rep label component times _lost _id _times _lang_pred _lang_score _twice _d".split()
    rows = [(1, "the house and the garden " * 20, "en", "a"), (2, "the house and the garden " * 20, None, "a"), (3, None, "en", None), (4, "", "de", "b"), (5, "das Haus und der Garten sind " * 20, "de", "b"), (5, "das Haus und der Garten sind " * 20, "de", "b"), (6, "word " * 50_000, "en", "c"), (7, "das Haus und der Garten sind " * 21 + "neu", "de", "b")]
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} int" for n in names))
    want = [{1, 2, 5, 6, 7}, {1, 3, 5, 6, 7}, {1, 3, 4, 5, 6}]
    for (_, stage), ids in zip(corpus_pipeline.STAGES[:-1], [*want, None], strict=True):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        got = {r.doc_id for r in out.collect()}
        assert ids is None or got == ids


def test_sql_of_the_operators(spark):
    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    for name, sql in registry.ORACLE_SQL.items():
        got, want = registry.QUERIES[name](spark, SF), con.execute(sql)
        columns = [d[0] for d in want.description]
        text = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
        assert sorted(columns) == sorted(got.columns)
        assert sorted([text(v) for v in r] for r in got.select(*columns).collect()) == sorted([text(v) for v in r] for r in want.fetchall())
