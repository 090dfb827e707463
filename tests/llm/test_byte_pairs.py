from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from graftline.llm import byte_pairs as bp

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
OWN = bp.Ranks(PATH, public_tokenizers.PATTERN)
LIB = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=OWN.rank, special_tokens={})
CASES = ["", " ", "  ", "a", " a  b ", "\n", "a\nb\tc\r\n", "a\n\nb", "I'll we've 'S's", "日本語 text 🙂🙂", "<|endoftext|>", "x" * 3000, "ab" * 2000, " " * 50, "\u0000\u0001 \u0085  x", "éé", "Tieg-los " * 400, "՘a \U00011de01 \U0003d000!", "a  b"]
SPICE = st.text(max_size=60) | st.text("ab '\nthesl\t", max_size=80)


def ids(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("text", CASES)
def test_equals_the_library(text):
    assert ids(OWN.encode(text)) == LIB.encode_ordinary(text)
    assert OWN.decode(np.array(LIB.encode_ordinary(text), np.int64)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(SPICE, max_size=5))
def test_equals_the_library_on_any_texts(texts):
    assert [ids(x) for x in OWN.encode_all(texts)] == [LIB.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=24).filter(bool))
def test_every_prefix_has_its_own_encoding(raw):
    """Against merges done one after the other on any bytes, also such as are no text."""
    one = bp.Prefixes(OWN, raw[:7]).append(raw[7:])
    for end in range(1, len(raw) + 1):
        parts = [raw[i : i + 1] for i in range(end)]
        while True:
            best = min(((OWN.rank.get(parts[i] + parts[i + 1], bp.NEVER), i) for i in range(len(parts) - 1)), default=(bp.NEVER, 0))
            if best[0] == bp.NEVER:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        assert one.ids(end) == [OWN.rank[p] for p in parts]


@settings(max_examples=200, deadline=None)
@given(SPICE, st.lists(st.tuples(st.integers(0, 80), st.integers(0, 20), SPICE), max_size=4))
def test_edits_equal_a_new_encoding(text, edits):
    one = bp.EncodedText(OWN, text)
    for start, size, new in edits:
        start = min(start, len(one.text))
        end = min(start + size, len(one.text))
        one.replace(start, end, new)
        assert one.ids() == LIB.encode_ordinary(one.text)
    assert bp.EncodedText(OWN, text).append(text).ids() == LIB.encode_ordinary(text + text)


def test_an_edit_in_a_long_text_encodes_its_surroundings_only():
    one = bp.EncodedText(OWN, "the quick brown fox " * 5000)
    assert one.replace(50_002, 50_004, "zz").encoded_chars < 60
    assert one.append(" jumps").encoded_chars < 20
    assert one.ids() == LIB.encode_ordinary(one.text)


def test_letters_are_those_of_the_library():
    """All code points that Unicode counts otherwise in some version, by whether they join a letter or a number."""
    odd = [c for c in [*range(0x370, 0x600), *range(0x1D600, 0x1F000), *range(0x10000, 0x12700), *range(0x2B700, 0x2CEC0), *range(0x18D00, 0x18F00), *range(0x11DD0, 0x11DF0)]]
    for lead in "a1":
        ranks = {bytes([i]): i for i in range(256)}
        ranks |= {(lead + chr(c)).encode(): 256 + i for i, c in enumerate(odd)}
        lib = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for c in odd:
            assert (len(lib.encode_ordinary(lead + chr(c))) == 1) == (len(OWN.pieces.of(chr(c)).findall(lead + chr(c))) == 1), hex(c)


def test_another_vocabulary(tmp_path):
    """A small vocabulary in which a word can be merged in two ways, and one token that no merge makes."""
    tokens = [*(bytes([i]) for i in range(256)), b"bc", b"ab", b"abc", b"aa", b"xyz"]
    (tmp_path / "v").write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    own = bp.Ranks(str(tmp_path / "v"), public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("v", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.rank, special_tokens={})
    for text in ("abc", "abcd", "aabc", "aaabcc", "xyz", "xyzz", "aaaaa"):
        assert ids(own.encode(text)) == lib.encode_ordinary(text)


def test_query_on_edge_rows(spark):
    rows = [(1, None, 9), (2, "", 9), (3, "a b", 9), (3, "a b", 9), (None, CASES[9], 9), (5, "word " * 20000, 9), (6, "q" * 50000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long")
    got = bp.encode_bytes(docs, with_ids=True)
    want = [(i, len(x := LIB.encode_ordinary(t or "")), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows]
    assert sorted(map(tuple, got.drop("ids").collect()), key=str) == sorted(want, key=str)
    assert sorted(bytes(r["decoded"]).decode() for r in bp.decode_ids(got).collect()) == sorted(t or "" for _, t, _ in rows)
    assert bp.encode_bytes(docs.limit(0)).count() == 0


def test_edits_of_rows(spark):
    rows = [(1, "the quick fox", [(4, 9, "slow"), (0, 0, "See ")]), (2, None, None), (3, "x", [])]
    got = bp.encode_edits(spark.createDataFrame(rows, "id long, text string, edits array<struct<start: int, end: int, new: string>>"))
    assert {r["id"]: r["ids"] for r in got.collect()} == {1: LIB.encode_ordinary("See the slow fox"), 2: [], 3: LIB.encode_ordinary("x")}
