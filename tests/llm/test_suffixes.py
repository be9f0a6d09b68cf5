import random
from collections import Counter

import numpy as np
import pytest

from littoral.llm import suffixes

from .helpers import docs, prose


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, data):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((d, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


def cases():
    rng = random.Random(1)
    a, b, c = prose(1, 300), prose(2, 150), "é" * 30 + prose(3, 100)
    rows = [(1, a), (2, a), (2, a), (3, a + " tail"), (4, prose(4, 30) + b + prose(5, 10)), (5, b[5:]), (None, b[:-3]), (None, None), (6, ""), (7, "x" * 3000), (8, "ab" * 500), (9, prose(9, 900)), (10, c), (11, "è" + c[1:])]
    passage = prose(6, 120)
    rows += [(100 + k, prose(200 + k, 20 + k) + passage + prose(300 + k, k)) for k in range(30)]
    rows += [(200 + k, "".join(rng.choices("ab", k=900))) for k in range(4)]
    return rows + [(90, prose(7, 5000)), (91, "É" + prose(7, 5000) + prose(7, 400))]


@pytest.mark.parametrize("length,short,gram,shard", [(400, 200, 32, 4_000_000), (40, 20, 8, 300), (60, 12, 5, 700), (12, 12, 5, 20_000)])
def test_matches_brute_force(spark, length, short, gram, shard):
    rows = cases()
    got = suffixes.remove(docs(spark, rows), length, short, gram, shard).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str) == brute(rows, length)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_repeated) for r in got) == sorted((str(d), n, gone) for d, n, gone, *_ in brute(rows, short))


def test_equal_rows_travel_once(spark):
    text = prose(1, 300)
    rows = [(1, text)] * 50 + [(None, text)] * 50
    got = suffixes.marks(docs(spark, rows), (400, 200)).collect()
    assert len(got) == 2 and max(len(r.marks) for r in got) < 60
    assert {r.n_removed for r in suffixes.remove(docs(spark, rows)).collect()} == {len(text)}


def test_clean_keeps_columns_and_characters(spark):
    rows = cases()
    table = docs(spark, rows)
    got = suffixes.clean(table)
    assert got.columns == table.columns
    by = {r.doc_id: r.text for r in got.collect() if r.doc_id is not None}
    plain = {d: k for d, *_, k in brute(rows, 400) if d is not None}
    assert by.keys() == plain.keys()
    for d, text in by.items():
        assert text.encode() == plain[d] or len(text.encode()) - len(plain[d]) in (1, 2, 3)
    assert all(r.n_chars == len(r.text) for r in got.collect() if r.text is not None)


def test_clean_cuts_whole_characters(spark):
    rng = random.Random(8)
    shared = "".join(rng.choices("aé漢😀", k=60))
    # Behind and before the shared string, characters that begin or end with the same bytes.
    rows = [(k, a + shared[k % 3 :] + b) for k, (a, b) in enumerate([("", ""), ("é", "漢x"), ("ĩ", "漣"), ("x😀", "😁"), ("y🐀", "é"), (prose(5, 40), prose(6, 40)), (shared, shared)])]
    rows += [(20, None), (21, ""), (22, "漢")]
    data = [(t or "").encode() for _, t in rows]
    for length in (7, 20, 31):
        seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
        want = {}
        for (d, t), b in zip(rows, data):
            gone = [False] * len(b)
            for i in range(len(b) - length + 1):
                if seen[b[i : i + length]] > 1:
                    gone[i : i + length] = [True] * length
            at, kept = 0, ""
            for c in t or "":
                n = len(c.encode())
                kept += "" if all(gone[at : at + n]) else c
                at += n
            want[d] = None if t is None else kept
        got = {r.doc_id: r.text for r in suffixes.clean(docs(spark, rows), length, 4, 120).collect()}
        assert got == want and sum(map(len, data)) > sum(len((t or "").encode()) for t in got.values())


def test_empty(spark):
    assert suffixes.remove(docs(spark, [])).collect() == []
    assert suffixes.clean(docs(spark, [])).collect() == []


def test_anchors_cover_every_start():
    data = random.Random(3).randbytes(5000) + b"z" * 2000
    h, at, first, last = suffixes.anchors(data, gram=48, step=900)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert starts.tolist() == list(range(len(data) - 399))
    assert ((at >= last) & (at + 48 <= first + 400)).all()


def test_anchors_are_few():
    data = random.Random(4).randbytes(100_000)
    assert 400 < len(suffixes.anchors(data, gram=48)[0]) < 900
