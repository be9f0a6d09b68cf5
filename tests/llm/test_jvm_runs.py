"""Texts are read in the JVM: no Python worker takes every text of op6 and op10."""

import random

import pytest
from pyspark.sql import functions as F

from littoral.llm import repeats, suffixes

from .helpers import docs, prose


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def texts():
    rng = random.Random(5)
    return ["", None, "a b", "x " * 80, "é\t漢 \n" * 30, "z" * 900, prose(1, 13), prose(2, 600, 9), prose(3, 3000), "".join(rng.choices("ab é", k=2000)), " \x0b" + prose(2, 600, 9)]


def check_cover(rows, starts, wide, string):
    """Every start is in one stretch, its run lies in it, and equal strings have equal runs at equal places."""
    at_start, place = [], {}
    for key, first, more, at in rows:
        for start in range(first, first + more + 1):
            at_start.append(start)
            assert at is None or start <= at + first <= start + wide
            got = (key, None if at is None else at + first - start)
            assert place.setdefault(string(start), got) == got
    assert at_start == list(range(starts))


def test_word_runs_cover_every_window(spark):
    table = docs(spark, [(k, t) for k, t in enumerate(texts())])
    found = repeats._runs(repeats._keyed(table), 13, 5)
    assert "InArrow" not in plan(found)
    by = {}
    for r in found.collect():
        by.setdefault(r.doc, []).append((r.run, r.first, r.more, None))
    few = 0
    for k, t in enumerate(texts()):
        w = (t or "").encode().split()
        check_cover(sorted(by.get(k, []), key=lambda x: x[1]), max(0, len(w) - 12), 8, lambda i, w=w: tuple(w[i : i + 13]))
        few += len(by.get(k, []))
    assert few < sum(len((t or "").split()) for t in texts()) / 3


@pytest.mark.parametrize("length, gram", [(200, 32), (40, 8), (12, 12)])
def test_byte_anchors_cover_every_string(spark, length, gram):
    table = docs(spark, [(k, t) for k, t in enumerate(texts())])
    found = suffixes._anchors(suffixes._keyed(table), length, gram)
    assert "InArrow" not in plan(found)
    by = {}
    for r in found.collect():
        by.setdefault(r.doc, []).append((r.anchor, r.first, r.more, r.at))
    for k, t in enumerate(texts()):
        b = (t or "").encode()
        check_cover(sorted(by.get(k, []), key=lambda x: x[1]), max(0, len(b) - length + 1), length - gram, lambda i, b=b: b[i : i + length])


def test_texts_are_cut_without_python_workers(spark):
    """op10_suffixes: its last step sent every text and its marks through a Python worker."""
    rows = [(1, prose(1, 200)), (2, prose(1, 200) + " tail"), (3, None)]
    done = suffixes.remove(docs(spark, rows))
    assert "InArrow" not in plan(done) and plan(done).count("littoral_repeat_remove") == 1
    assert {r.doc_id: (r.n_spans, bytes(r.kept)) for r in done.collect()} == {1: (1, b""), 2: (1, b" tail"), 3: (0, b"")}
    assert done.filter(F.col("n_removed") > 0).count() == 2
