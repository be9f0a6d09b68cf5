"""SimHash near-duplicates by tiled exact comparison.

Every distinct fingerprint is compared with every other one that it could be
within the radius of. Fingerprints are laid out in tiles by the population
counts of their segments; a pair of tiles whose counts differ by more than the
radius is skipped as a whole, the rest is compared with numpy exclusive-or and
bit counts. Nothing is approximate.

Defined results: a null or empty text, or one of white space only, has
fingerprint zero and links like any other; texts of one or two words are one
shingle; repeated rows stay rows; a null ``doc_id`` keeps its fingerprint and
never names a component (a component of null ids only has a null id); an empty
table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, as_bytes, discard, documents, map_batches, materialize, text_key

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints a tile holds about; segments are chosen so that cells come near it.
TILE = 8192
#: About how many cells the population counts of 1, 2, 4 and 8 segments fill evenly.
CELLS = {1: 14, 2: 100, 4: 2500, 8: 390_000}

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; a bit needs over half of the hashes."""
    words = data.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) < shingle:
        hashes = digest(b" ".join(words), seed)
    else:
        grams = zip(*(itertools.islice(words, k, None) for k in range(shingle)))
        hashes = b"".join([digest(g, seed) for g in map(b" ".join, grams)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    n = len(rows)
    if n < 256:
        ones = np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(rows[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, k, fp``: one signed 64-bit fingerprint for each row; ``k`` is a hash of its text."""

    def make():
        def each(batch):
            fps = [fingerprint(x, shingle, seed) for x in as_bytes(batch.column(1))]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "k", "fp"])

        return each

    return map_batches(documents(docs).withColumn("k", text_key("text")), make, "doc_id long, k long, fp long")


def spanning(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what lies within the radius between two tiles (or in one): a star for each local group, never all pairs."""
    nodes = a if b is None else np.concatenate([a, b])
    label = np.arange(len(nodes))
    offset = 0 if b is None else len(a)
    other = a if b is None else b
    step = max(1, (1 << 21) // max(1, len(other)))
    for lo in range(0, len(a), step):
        near = np.bitwise_count(a[lo : lo + step, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        i, j = i + lo, j + offset
        if b is None:
            keep = i < j
            i, j = i[keep], j[keep]
        while len(i):
            low = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            label = label[label]
            if np.array_equal(before, label) and np.array_equal(label[i], label[j]):
                break
    while not np.array_equal(label, label[label]):
        label = label[label]
    odd = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[odd], nodes[label[odd]]


def _tiles(fps: DataFrame, radius: int, tile: int) -> DataFrame:
    """Pairs of tiles that may hold links, each as two arrays (the second null within one tile)."""
    n = fps.count()
    segments = next((s for s, cells in CELLS.items() if n / cells <= tile), max(CELLS))
    width = 64 // segments
    counts = [F.bit_count(F.shiftrightunsigned("fp", k * width).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))).cast("long") for k in range(segments)]
    cell = sum((F.shiftleft(c, 7 * k) for k, c in enumerate(counts[1:], 1)), counts[0])
    placed = fps.select("fp", cell.alias("cell"))
    sizes = materialize(placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("n")), "simhash-cells")
    tiles = materialize(
        placed.join(sizes, "cell").select("fp", "cell", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int").alias("tile")).groupBy("cell", "tile").agg(F.collect_list("fp").alias("fps")),
        "simhash-tiles",
    )
    # Half of the steps between cells within the radius; a cell's own pairs are the zero step.
    steps = [s for s in _steps(segments, radius) if s >= (0,) * segments]
    shifts = [sum(x << (7 * k) for k, x in enumerate(s)) for s in steps]
    a = sizes.select(F.col("cell").alias("cell_a"), F.col("n").alias("n_a"))
    b = sizes.select(F.col("cell").alias("cell_b"), F.col("n").alias("n_b"))
    pairs = a.select("*", F.explode(F.array(*map(F.lit, shifts))).alias("d")).withColumn("cell_b", F.col("cell_a") + F.col("d")).drop("d").join(b, "cell_b")
    pairs = pairs.select("*", F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)).alias("tile_a")).select("*", F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)).alias("tile_b"))
    pairs = pairs.filter("cell_a != cell_b or tile_a <= tile_b").select("cell_a", "tile_a", "cell_b", "tile_b")
    left = tiles.select(F.col("cell").alias("cell_a"), F.col("tile").alias("tile_a"), F.col("fps").alias("a"))
    right = tiles.select(F.col("cell").alias("cell_b"), F.col("tile").alias("tile_b"), F.col("fps").alias("b"))
    same = (F.col("cell_a") == F.col("cell_b")) & (F.col("tile_a") == F.col("tile_b"))
    joined = pairs.join(left, ["cell_a", "tile_a"]).join(right, ["cell_b", "tile_b"])
    return joined.select("a", F.when(~same, F.col("b")).alias("b"))


def _steps(dims: int, radius: int) -> list[tuple[int, ...]]:
    """Integer steps whose absolute values sum to the radius at most."""
    out = [()]
    for _ in range(dims):
        out = [s + (x,) for s in out for x in range(-radius, radius + 1) if sum(map(abs, s)) + abs(x) <= radius]
    return out


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``u, v``: edges that connect all distinct fingerprints within the radius of each other."""

    def make():
        def each(batch):
            u, v = [], []
            for k in range(batch.num_rows):
                a, b = (batch.column(c)[k].values for c in (0, 1))
                x, y = spanning(a.to_numpy().view(np.uint64), None if b is None else b.to_numpy().view(np.uint64), radius)
                u.append(x)
                v.append(y)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(z).view(np.int64)) for z in (u, v)], names=["u", "v"])

        return each

    return map_batches(_tiles(fps, radius, tile), make, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge: alternating large and small stars, by joins with minima, until nothing moves."""
    spark = edges.sparkSession

    def state(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def star(both: DataFrame, small: bool) -> DataFrame:
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        met = both.join(low, "u")
        if small:  # the smaller neighbours of u, and u itself, hang on the smallest
            out = met.filter("v <= u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        else:  # the larger neighbours of u hang on the smallest
            out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.filter("u != v").distinct()

    def twice(df):
        return df.union(df.select(F.col("v").alias("u"), F.col("u").alias("v")))

    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "stars")
    seen = state(now)
    while seen[0]:
        large = materialize(star(twice(now), False), "stars")
        step = materialize(star(large, True), "stars")
        after = state(step)
        discard(large)
        discard(now)
        now = step
        if after == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()) if seen[0] else spark.createDataFrame([], "node long, root long")


def _labelled(docs: DataFrame, radius: int, shingle: int, seed: int, tile: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, k, fp`` of each row, and ``fp, root, first`` of each fingerprint."""
    by_doc = materialize(fingerprints(docs, shingle, seed), "simhash-docs")
    fps = materialize(by_doc.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-fps")
    edges = materialize(links(fps.select("fp"), radius, tile), "simhash-links")
    roots = components(edges).withColumnRenamed("node", "fp")
    return by_doc, fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"), "first")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, tile: int = TILE) -> DataFrame:
    """``doc_id, fp, component_id``: one row for each input row; ``component_id`` is the smallest ``doc_id`` of its component."""
    by_doc, fps = _labelled(docs, radius, shingle, seed, tile)
    fps = materialize(fps, "simhash-roots")
    least = fps.filter("linked").groupBy("root").agg(F.min("first").alias("least"))
    named = fps.join(least, "root", "left").select("fp", F.when(F.col("linked"), F.col("least")).otherwise(F.col("first")).alias("component_id"))
    return by_doc.join(named, "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, tile: int = TILE) -> DataFrame:
    """``docs`` with its columns, one row of each component: the one of the smallest ``doc_id`` (null last)."""
    by_doc, fps = _labelled(docs, radius, shingle, seed, tile)
    fps = materialize(fps, "simhash-roots")
    own = F.struct(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "k")
    best = by_doc.join(fps, "fp").groupBy("root").agg(F.min(own).alias("best")).select("best.doc", "best.k")
    # Rows of equal id and text are one; only where there are several is a choice to make.
    several = by_doc.groupBy(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "k").agg((F.count("*") > 1).alias("several"))
    best = materialize(best.join(several, ["doc", "k"]), "simhash-best")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own")
    met = docs.select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), text_key("text").alias("k")).join(best, ["doc", "k"])
    return met.filter("not several").unionByName(met.filter("several").dropDuplicates(["doc", "k"])).select("own.*")


def hex64(fp: str) -> F.Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
