import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from littoral.llm import decontaminate as dc

from .helpers import docs, prose


def brute_tiles(doc, item, least):
    """Greedy string tiling as it is defined: the longest free match first, one at a time."""
    least = min(least, len(item))
    fd, fi, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and fd[p + n] and fi[q + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < max(1, least):
            return out
        fd[p : p + n] = fi[q : q + n] = [False] * n
        out.append((p, q, n))


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=30), st.text("abc", max_size=20), st.integers(1, 5))
def test_tiles_are_greedy(doc, item, least):
    got, want = dc.tiles(list(doc), list(item), least), brute_tiles(doc, item, least)
    assert [n for *_, n in sorted(got, key=lambda x: -x[2])][:1] == [n for *_, n in want][:1]
    for p, q, n in got:
        assert doc[p : p + n] == item[q : q + n] and n >= min(least, len(item))
    for side in (0, 1):
        used = [x + k for m in got for x in [m[side]] for k in range(m[2])]
        assert len(used) == len(set(used))
    assert sorted(got) == sorted(want)


ITEM = prose(1, 40, 10**6)


def test_documents(spark):
    rng = random.Random(1)
    w = ITEM.split()
    swapped = " ".join(w[20:] + ["and"] + w[:20])
    rows = [(1, prose(2, 300) + " " + ITEM.upper() + "! " + prose(3, 50)), (2, swapped), (3, prose(4, 500)), (4, " ".join(w[:12])), (5, None), (6, ""), (None, ITEM), (7, ITEM), (7, ITEM), (8, "two words here"), (9, prose(5, 20_000) + ITEM)]
    bench = spark.createDataFrame([(10, ITEM, "x"), (11, "two words", "y"), (12, None, None), (13, "", None), (None, prose(9, 30, 10**6), None)], "item_id long, text string, doc_id string")
    got = sorted(((r.doc_id, r.item_id, r.coverage) for r in dc.contaminated(docs(spark, rows), bench).collect()), key=str)
    assert got == sorted([(1, 10, 1.0), (2, 10, 1.0), (None, 10, 1.0), (7, 10, 1.0), (7, 10, 1.0), (8, 11, 1.0), (9, 10, 39 / 40)], key=str) or got == sorted([(1, 10, 1.0), (2, 10, 1.0), (None, 10, 1.0), (7, 10, 1.0), (7, 10, 1.0), (8, 11, 1.0), (9, 10, 0.975)], key=str)
    kept = dc.clean(docs(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6] and kept.columns == docs(spark, []).columns
    # Against all pairs.
    want = {(d, i) for d, t in rows for i, b in [(10, ITEM), (11, "two words")] if dc.coverage(dc.words((t or "").encode()), dc.words(b.encode()))[0] >= 0.5}
    assert {(d, i) for d, i, _ in got} == want


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert dc.contaminated(docs(spark, []), some).collect() == []
    assert dc.contaminated(docs(spark, [(1, ITEM)]), none).collect() == []
