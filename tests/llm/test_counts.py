import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from littoral.llm import counts

from .helpers import docs, prose

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def n_tokens(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t　\xa0'sdlthe,.éÉß12#İΣσ́̈"), st.characters(codec="utf-8")), max_size=60) | st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", " ", "a", "\n", "Don't", "<|EndOfText|>"]), max_size=9).map("".join))
def test_pieces_of_pre_tokens_add_up(text):
    cutter = counts._cutter(PATH)
    assert cutter.native
    assert sum(n * cutter.pieces(p) for p, n in cutter.cut(text).items() if p) == n_tokens(text)


def awkward():
    rng = random.Random(7)
    alphabet = [" ", "\n", "\t ", "\x1c", "\x85", "\xa0", "\u2003", "'s", "'LL", "'Ve", "'", "The", "ED", "é", "É", "E\u0301", "ſ", "K", "Å", "ß", "ẞ", "İ", "I\u0307", "Σ", "Ας", "12", "³", "Ⅷ", "一二", "کتاب", "각", "ᄀ", "ᅡ", "😀", "\U0001e900", "\U00010d50", "\u1c89", "\ua7dc", "#!", "<|endoftext|>", "<|StartOfText|>", ".", "\x00", "\uffff", "ǅ", "ŉ"]
    return ["".join(rng.choices(alphabet, k=rng.randrange(1, 30))) for _ in range(1500)]


def test_jvm_counts_as_the_library(spark):
    rows = list(enumerate(awkward()))
    for r in counts.count(docs(spark, rows), PATH).collect():
        assert r.n_tokens == n_tokens(rows[r.doc_id][1]), repr(rows[r.doc_id][1])


def test_python_cut(spark, monkeypatch):
    monkeypatch.setattr(counts._cutter(PATH), "native", False)
    rows = [(1, "A b  c"), (2, None), (3, "<|endoftext|> x Don't 12")]
    assert {r.doc_id: r.n_tokens for r in counts.count(docs(spark, rows), PATH).collect()} == {d: n_tokens(t or "") for d, t in rows}


@pytest.mark.parametrize("head", [0, 3, 100_000])
def test_rows(spark, head):
    rows = [(1, "A b  c"), (1, "A b  c"), (None, None), (2, ""), (3, prose(4, 3000)), (4, "<|endoftext|> x <|startoftext|>y"), (5, "x" * 5000), (6, "Éä İ 12 34")]
    got = counts.count(docs(spark, rows), PATH, head=head).collect()
    want = [(d, len((t or "").encode()), n_tokens(t or ""), n_tokens(t or "") > 2048) for d, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty(spark):
    assert counts.count(docs(spark, []), PATH).collect() == []
