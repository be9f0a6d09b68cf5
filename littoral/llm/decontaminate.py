"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a seed (a run of ``LEAST`` words) are
joined; each joined pair is tiled: the longest common run of words not yet
covered is marked, again and again, found by running Karp-Rabin with a falling
search length. The share of the item's words under tiles is its coverage, which
passages put in another order have as well. Pairs of ``COVERED`` and more count.

Seeds of all items go to the documents as a bit set of bounded size: with room
enough almost only true seeds pass it, beyond that more seeds are shuffled than
need be; the join behind it is exact either way. A pair is tiled only if its
shared seeds could cover enough of the item.

Words are runs of letters and digits (and all characters beyond ASCII), A-Z in
lower case. An item with fewer words than ``LEAST`` is one seed of its own
length; one without words matches nothing.

Defined results: null and empty texts match nothing; repeated rows and items
stay rows and items; null ids are carried along; empty tables give empty
results.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, as_bytes, documents, map_batches, materialize, text_key
from .grams import Bloom, Words, gram_hashes

LEAST = 5
COVERED = 0.5

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def words(data: bytes) -> list[bytes]:
    return data.translate(_PLAIN).split()


def tiles(doc: list, item: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(doc position, item position, length)`` of each tile; no word is in two.

    Longest first, as search lengths fall; of equal ones the first in the document, then in the item.
    """
    least = min(least, len(item))
    free_d, free_i = [True] * len(doc), [True] * len(item)
    codes = {w: k + 1 for k, w in enumerate(dict.fromkeys(item))}
    d, t = [codes.get(w, 0) for w in doc], [codes[w] for w in item]
    out: list[tuple[int, int, int]] = []
    if not least:
        return out
    search = len(item)
    while True:
        found = _matches(d, t, free_d, free_i, search)
        longest = max((m[2] for m in found), default=0)
        if longest > 2 * search:
            search = longest
            continue
        found = sorted(((-n, p, q) for p, q, n in found), reverse=True)
        while found:
            n, p, q = found.pop()
            n = -n
            if all(free_d[p : p + n]) and all(free_i[q : q + n]):
                free_d[p : p + n] = free_i[q : q + n] = [False] * n
                out.append((p, q, n))
                continue
            # What an earlier tile left of this match waits its turn by its own length.
            k = 0
            while k < n:
                while k < n and not (free_d[p + k] and free_i[q + k]):
                    k += 1
                start = k
                while k < n and free_d[p + k] and free_i[q + k]:
                    k += 1
                if k - start >= search:
                    found.append((start - k, p + start, q + start))
            found.sort(reverse=True)
        if search > 2 * least:
            search //= 2
        elif search > least:
            search = least
        else:
            return out


def _rolling(codes: list[int], free: list[bool], size: int):
    """``position, hash`` of each run of ``size`` free words, each hash from the one before."""
    top = pow(_BASE, size, _PRIME)
    run = h = 0
    for k, c in enumerate(codes):
        if not free[k] or not c:
            run = h = 0
            continue
        run += 1
        h = (h * _BASE + c) % _PRIME
        if run > size:
            h = (h - codes[k - size] * top) % _PRIME
        if run >= size:
            yield k - size + 1, h


def _matches(d: list[int], t: list[int], free_d: list[bool], free_i: list[bool], size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of free words of ``size`` at least."""
    starts = defaultdict(list)
    for q, h in _rolling(t, free_i, size):
        starts[h].append(q)
    out = []
    for p, h in _rolling(d, free_d, size):
        for q in starts.get(h, ()):
            if p and q and d[p - 1] == t[q - 1] and free_d[p - 1] and free_i[q - 1]:
                continue  # the run began earlier
            n = 0
            while p + n < len(d) and q + n < len(t) and d[p + n] == t[q + n] and free_d[p + n] and free_i[q + n]:
                n += 1
            if n >= size:
                out.append((p, q, n))
    return out


def coverage(doc: list, item: list, least: int = LEAST) -> tuple[float, int]:
    """Covered share of the item and the number of tiles."""
    found = tiles(doc, item, least)
    return (sum(n for *_, n in found) / len(item) if item else 0.0), len(found)


def _near(doc: list[bytes], item: list[bytes], least: int) -> list[bytes]:
    """The stretches of a document that shared seeds cover; no match lies elsewhere. Empty words part them."""
    least = min(least, len(item))
    seeds = {tuple(item[k : k + least]) for k in range(len(item) - least + 1)}
    out, end = [], 0
    for k, gram in enumerate(zip(*(doc[j:] for j in range(least)))):
        if gram in seeds:
            if k > end and out:
                out.append(b"")
            out += doc[max(k, end) : k + least]
            end = k + least
    return out


def _seeds(items: DataFrame, least: int) -> DataFrame:
    """``item, size, seed`` of each distinct seed of each item, and the item's words."""

    def make():
        hasher = Words()

        def each(batch):
            rows = []
            for item, data in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                w = words(data)
                size = min(least, len(w))
                if w:
                    rows += [(item, len(w), size, int(h)) for h in np.unique(gram_hashes(hasher.hashes(w), size)).view(np.int64)]
            a, b, c, d = zip(*rows) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(c, pa.int32()), pa.array(d, pa.int64())], names=["item", "n_words", "size", "seed"])

        return each

    return map_batches(items, make, "item long, n_words int, size int, seed long")


def _bloom(seeds: DataFrame, n: int) -> Bloom:
    """The bit set of all seeds, joined word by word of its bounded size."""
    size = Bloom.size(n)

    def make():
        def each(batch):
            bits = Bloom.of(batch.column(0).to_numpy().view(np.uint64), size).bits
            at = np.nonzero(bits)[0]
            return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(bits[at].view(np.int64))], names=["at", "bits"])

        return each

    parts = map_batches(seeds.select("seed"), make, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(size // 64, np.uint64)
    out[parts["at"].to_numpy(np.int64)] = parts["bits"].to_numpy(np.int64).view(np.uint64)
    return Bloom(out)


def _hits(docs: DataFrame, bloom: Bloom, sizes: list[int]) -> DataFrame:
    """``row, doc_id, text, seeds`` of the documents that have words of the bit set."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom.bits)

    def make():
        hasher, known = Words(), Bloom(shared.value)

        def each(batch):
            rows = []
            for k, data in enumerate(as_bytes(batch.column(2))):
                h = hasher.hashes(words(data))
                found = [g[known.find(g)] for g in (gram_hashes(h, s) for s in sizes)]
                if any(map(len, found)):
                    rows.append((k, np.unique(np.concatenate(found)).view(np.int64)))
            if not rows:
                return None
            at, seeds = pa.array([k for k, _ in rows]), pa.array([s for _, s in rows], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([batch.column(i).take(at) for i in range(3)] + [seeds], names=["row", "doc_id", "text", "seeds"])

        return each

    numbered = documents(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return map_batches(numbered, make, "row long, doc_id long, text string, seeds array<long>")


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, covered: float = COVERED) -> DataFrame:
    """``row, doc_id, item_id, k, coverage, n_tiles`` of each pair that is covered enough; ``row`` tells repeated documents apart, ``k`` is a hash of the text."""
    spark = docs.sparkSession
    items = materialize(benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("text").cast("string").alias("text"), F.col("item_id").cast("long").alias("item_id")), "benchmark")
    seeds = materialize(_seeds(items.select("item", "text"), least), "benchmark-seeds")
    sizes = sorted(r.size for r in seeds.select("size").distinct().collect())
    if not sizes:
        return spark.createDataFrame([], "row long, doc_id long, item_id long, k long, coverage double, n_tiles int")
    hits = materialize(_hits(docs, _bloom(seeds, seeds.count()), sizes), "benchmark-hits")
    pairs = hits.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy("row", "item").agg(F.count("*").alias("n"), F.first("n_words").alias("n_words"), F.first("size").alias("size"))
    # One seed can stand in several places of an item; n counts distinct ones, so the bound is on places.
    places = seeds.groupBy("item").agg(F.count("*").alias("distinct_seeds"), F.first("n_words").alias("w"), F.first("size").alias("s")).select("item", (F.col("w") - F.col("s") + 1 - F.col("distinct_seeds")).alias("again"))
    likely = pairs.join(places, "item").filter((F.col("n") + F.col("again")) * F.col("size") >= covered * F.col("n_words")).select("row", "item")
    full = likely.join(hits.select("row", "doc_id", "text"), "row").join(items.select("item", "item_id", F.col("text").alias("item_text")), "item")

    def make():
        def each(batch):
            share, count = [], []
            for data, other in zip(as_bytes(batch.column(3)), as_bytes(batch.column(4))):
                item = words(other)
                c, n = coverage(_near(words(data), item, least), item, least)
                share.append(c)
                count.append(n)
            return pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(5), pa.array(share), pa.array(count, pa.int32())], names=["row", "doc_id", "item_id", "k", "coverage", "n_tiles"])

        return each

    tiled = map_batches(full.select("row", "doc_id", "item_id", "text", "item_text", text_key("text").alias("k")), make, "row long, doc_id long, item_id long, k long, coverage double, n_tiles int")
    return tiled.filter(F.col("coverage") >= covered)


def clean(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, covered: float = COVERED) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    bad = contaminated(docs, benchmark, least, covered).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "k").distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own")
    keyed = docs.select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), text_key("text").alias("k"))
    return keyed.join(materialize(bad, "benchmark-bad"), ["doc", "k"], "left_anti").select("own.*")
