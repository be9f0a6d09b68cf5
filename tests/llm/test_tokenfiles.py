import io
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from littoral.llm import tokenfiles

from .helpers import docs, prose

PATH = P.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdlthe,.éß12#<|>"), st.characters(codec="utf-8")), max_size=60) | st.lists(st.sampled_from(["<|endoftext|>", " ", "a", "\n", "don't", " <|endoftext|>"]), max_size=9).map("".join))
def test_encode_is_the_librarys(text):
    got = tokenfiles.encode([text, "x", text], PATH)
    assert got[0].tolist() == got[2].tolist()
    assert got[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_shard_round_trip(kind):
    rng = np.random.default_rng(1)
    sink = io.BytesIO()
    writer = tokenfiles.ShardWriter(sink, kind, block=64)
    rows = [(k if k else None, rng.integers(0, 2**32 if k == 3 else 50_000, n, dtype=np.uint32)) for k, n in enumerate([1, 0, 63, 64, 65, 1000, 2])]
    for r in rows:
        writer.add(*r)
    writer.close()
    reader = tokenfiles.ShardReader(sink, sink.tell())
    flat = np.concatenate([x for _, x in rows])
    got = list(reader.documents())
    assert [(d, x.tolist()) for d, _, x in got] == [(d, x.tolist()) for d, x in rows]
    for lo, hi in [(0, 1), (60, 70), (0, len(flat)), (128, 128), (500, 900)]:
        assert reader.ids(lo, hi).tolist() == flat[lo:hi].tolist()


def test_rows(spark):
    rows = [(5, prose(1, 2000)), (2, "b <|endoftext|> a"), (2, "a"), (9, None), (1, ""), (None, "x  y"), (2, "a")] + [(100 + k, prose(k, k)) for k in range(60)]
    for kind in ("byte", "bit"):
        got = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in tokenfiles.round_trip(docs(spark, rows), PATH, kind=kind).collect()}
        want, at = {}, 0
        for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
            ids = LIBRARY.encode(t or "", add_special_tokens=False).ids + [0]
            want[d, at] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            at += len(ids)
        assert got == want


def test_empty(spark):
    assert tokenfiles.round_trip(docs(spark, []), PATH).collect() == []
