import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from littoral.llm import repeats

from .helpers import docs, prose


def brute(rows, window=13):
    big = float("inf")
    first = defaultdict(lambda: big)
    split = [(big if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            first[g] = min(first[g], d)
    out = []
    for (d, w), (own, _) in zip(split, rows):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out.append((own, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def cases():
    a, b, c = prose(1, 60), prose(2, 14), prose(3, 400)
    rows = [(1, a), (2, a), (2, a), (2, a + " tail"), (3, prose(4, 30) + " " + b), (4, b), (5, b + "\n\n" + prose(5, 9)), (None, a), (None, b), (6, None), (7, ""), (8, "one two"), (9, c), (10, " ".join(c.split()[20:380])), (11, "x " * 60), (12, "x " * 40)]
    passage = prose(6, 20)
    rows += [(100 + k, prose(200 + k, 20 + k) + "  " + passage + " " + prose(300 + k, k)) for k in range(40)]
    return rows + [(90, prose(7, 20_000)), (91, "É" + prose(7, 20_000))]


@pytest.mark.parametrize("bucket,run,prefix", [(60, 6, 1), (400, 3, 2), (10**6, 5, 2)])
def test_matches_brute_force(spark, bucket, run, prefix):
    got = repeats.remove(docs(spark, cases()), run=run, prefix=prefix, bucket=bucket).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(cases())


def test_empty(spark):
    assert repeats.remove(docs(spark, [])).collect() == []


def test_every_window_has_an_anchor():
    rng = np.random.default_rng(2)
    sizes = np.array([5, 200, 0, 13, 282])
    text, h, at, first, last = repeats.anchors(rng.integers(0, 30, 500).astype(np.uint64), sizes)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert starts.tolist() == [*range(5, 205 - 12), 205, *range(218, 500 - 12)]
    assert set(text.tolist()) == {1, 3, 4} and (np.diff(text) >= 0).all()
    assert ((at >= last) & (at + repeats.RUN <= first + 13)).all()


def brute_nodes(suffixes, depth):
    """Maximal repeats to the right: prefixes of several suffixes that go on differently (or end)."""
    below = defaultdict(list)
    for s in suffixes:
        for n in range(depth, len(s) + 1):
            below[tuple(s[:n])].append(s[n : n + 1])
    return sorted((len(p), len(after)) for p, after in below.items() if len(after) > 1 and (len({tuple(a) for a in after}) > 1 or [] in after))


@pytest.mark.parametrize("seed", range(6))
def test_nodes_of_sorted_suffixes(seed):
    rng = np.random.default_rng(seed)
    text = [b"%d" % x for x in rng.integers(0, 3, 90)]
    suffixes = [text[i : i + int(rng.integers(4, 12))] for i in range(80)]
    order, common = repeats.sorted_suffixes(pa.array([b" ".join(s).decode() for s in suffixes]))
    for i in range(1, len(order)):
        a, b = suffixes[order[i - 1]], suffixes[order[i]]
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[i] == same
    for depth in (1, 3, 6):
        found = repeats.nodes(common, depth)
        for d, lo, hi in found:
            assert len({tuple(suffixes[order[i]][:d]) for i in range(lo, hi)}) == 1
        assert sorted((d, hi - lo) for d, lo, hi in found) == brute_nodes(suffixes, depth)


def test_equal_rows_travel_once(spark):
    text = prose(1, 300)
    got = repeats.marks(docs(spark, [(1, text)] * 40 + [(2, text)] * 40 + [(None, text)] * 40)).collect()
    assert {r.doc for r in got} == {2, (1 << 63) - 1} and max(len(r.marks) for r in got) < 150
