import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from littoral.llm import bpe

from .helpers import docs, prose

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
TIK = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(text):
    return np.frombuffer(bpe.encode([text], PATH, P.PATTERN)[0], np.uint32).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t 　'sdlthe,.éèñßüÖ12#"), st.characters(codec="utf-8")), max_size=60))
def test_same_as_tiktoken(text):
    assert ids(text) == TIK.encode_ordinary(text)


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "a  b", "<|endoftext|> x", "don't  stop\n\n now", "x" * 3000, "ab" * 500 + " " * 300 + "é" * 200, prose(2, 3000)])
def test_texts(text):
    assert ids(text) == TIK.encode_ordinary(text)
    assert bpe.decode(bpe.encode([text], PATH, P.PATTERN)[0], PATH) == text.encode()


def test_appends_and_edits():
    ranks = bpe.load(PATH)
    rng = random.Random(3)
    table, data = bpe.PrefixTable(ranks), b""
    for _ in range(40):
        more = bytes(rng.choices(b"the antioned ", k=rng.randrange(1, 30)))
        table.append(more)
        data += more
    for _ in range(40):
        lo = rng.randrange(len(data))
        hi = min(len(data), lo + rng.randrange(8))
        new = bytes(rng.choices(b"xing er", k=rng.randrange(8)))
        redone = table.replace(lo, hi, new)
        data = data[:lo] + new + data[hi:]
        assert redone <= len(data) - lo
        assert table.last == bpe.PrefixTable(ranks, data).last
        assert table.tokens() == ranks.encode_piece(data)


def test_rows(spark):
    rows = [(1, "a b  c"), (1, "a b  c"), (None, None), (2, ""), (3, prose(4, 500))]
    got = sorted(bpe.digests(docs(spark, rows), PATH, P.PATTERN).collect(), key=str)
    want = []
    for d, t in rows:
        x = np.array(TIK.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((d, len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = bpe.decode_documents(bpe.encode_documents(docs(spark, rows), PATH, P.PATTERN), PATH).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((d, t or "") for d, t in rows), key=str)


def awkward():
    rng = random.Random(5)
    alphabet = [" ", "  ", "\n", "\t ", " \r\n", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "'s", "'LL", "'ve", "'", "''", "the", "ed", "é", "ñ", "ß", "Ö", "12", "³", "Ⅷ", "一二", "کتاب", "\u0301", "😀", "\U0001e900", "\U00010d40", "\u1c89", "#!", "<|endoftext|>", ".", "\x00", "\uffff"]
    return ["".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(1500)] + ["x" * 3000, "ab" * 500 + " " * 300 + "é" * 200, "A", " ", "'", "'r", " 's"]


def test_jvm_same_as_tiktoken(spark):
    rows = list(enumerate(awkward()))
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in bpe.encode_documents(docs(spark, rows), PATH).collect()}
    for k, t in rows:
        assert got[k] == TIK.encode_ordinary(t), repr(t)


def test_jvm_vocabularies(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}, special_tokens={})
    rows = list(enumerate(awkward()[::5]))
    for r in bpe.encode_documents(docs(spark, rows), path).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == other.encode_ordinary(rows[r.doc_id][1])


def test_other_patterns(spark):
    pattern = r"\S+|\s+"
    tik = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=RANKS, special_tokens={})
    for r in bpe.digests(docs(spark, [(1, "don't stop  now"), (2, None)]), PATH, pattern, with_ids=True).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == tik.encode_ordinary("don't stop  now" if r.doc_id == 1 else "")


def test_empty(spark):
    assert bpe.digests(docs(spark, []), PATH, P.PATTERN).collect() == []
