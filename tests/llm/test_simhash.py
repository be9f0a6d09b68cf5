import re

import numpy as np
import xxhash

from littoral.llm import simhash

from .helpers import docs, prose


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    fps = [brute_fp(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                comp[b] = a
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, fps[i], min(ids, default=None)))
    return sorted(out, key=str)


def cases():
    base = prose(1, 300)
    rows = [(9, base), (3, base), (3, base), (None, base), (4, base + " tail"), (5, ""), (6, None), (7, " \t\n"), (8, "one"), (10, "One two"), (11, "É À x y z")]
    rows += [(20 + k, base.replace("w1 ", f"v{k} ", 1)) for k in range(12)]
    rows += [(50 + k, prose(100 + k, 5 + 40 * k)) for k in range(12)]
    return rows + [(90, prose(7, 30_000)), (91, prose(7, 30_000).upper())]


def test_matches_brute_force(spark):
    rows = cases()
    for tile in (64,):
        got = simhash.near_duplicates(docs(spark, rows), tile=tile).collect()
        assert sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got), key=str) == brute(rows)


def test_empty(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []


def test_segments_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 40, dtype=np.int64)
    fps = {int(x) for x in seeds}
    for x in seeds:
        for _ in range(6):
            y = int(x)
            for b in rng.choice(63, rng.integers(1, 6), replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    fps = sorted(fps)
    parent = {x: x for x in fps}

    def find(p, x):
        while p[x] != x:
            x = p[x]
        return x

    def join(p, x, y):
        a, b = sorted((find(p, x), find(p, y)))
        p[b] = a

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 3:
                join(parent, x, y)
    table = spark.createDataFrame([(x,) for x in fps], "fp long")
    for s in (2, 8):
        monkeypatch.setattr(simhash, "CELLS", {s: 10**9})
        got = {x: x for x in fps}
        for r in simhash.links(table, tile=16).collect():
            assert (r.u ^ r.v).bit_count() >= 1
            join(got, r.u, r.v)
        assert {x: find(got, x) for x in fps} == {x: find(parent, x) for x in fps}
        roots = {r.node: r.root for r in simhash.components(simhash.links(table, tile=16)).collect()}
        assert {x: roots.get(x, x) for x in fps} == {x: find(parent, x) for x in fps}
