from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from graftline.llm import sentence_pieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
OWN = sp.PieceModel(PATH)
CASES = ["", " ", "  ", "a", " a  b ", "\n", "a\nb\tc\r\n", "▁x ▁▁", "日本語 text 🙂🙂", "</s><s> <unk> <0x0A>", "x" * 3000, "ab" * 2000, " " * 50, "\u0000\u0001", "éé", "Tieg-los " * 400]


@pytest.mark.parametrize("text", CASES)
def test_equals_the_library(text):
    ids = LIB.encode(text, add_bos=True, add_eos=True)
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIB.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("ab ▁\nthe", max_size=80))
def test_equals_the_library_on_any_text(text):
    ids = LIB.encode(text, add_bos=True, add_eos=True)
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIB.decode(ids)


def test_query_on_edge_rows(spark):
    rows = [(1, None, 9), (2, "", 9), (3, "a b", 9), (3, "a b", 9), (None, CASES[8], 9), (5, "word " * 20000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long")
    got = sorted(map(tuple, sp.encode_pieces(docs).collect()), key=str)
    want = []
    for i, text, _ in rows:
        ids = LIB.encode(text or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIB.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert sp.encode_pieces(docs.limit(0)).count() == 0
