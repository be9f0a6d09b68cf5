"""Repeated byte strings by suffix arrays of shards.

Each byte covered by a string of ``LENGTH`` bytes that also starts anywhere else
is removed; bytes under shorter repeats, of ``SHORT`` bytes, are counted beside
it from the same suffix arrays. Every string of the shortest length has one run
of ``GRAM`` bytes in it that hashes lowest (the first of equal ones); equal
strings have it at the same place. These anchors, one in about half such a
length, are counted first; only around anchors that occur twice or more are
bytes moved at all. The strings of an anchor, as one stretch of bytes that goes
on to the end of the longest length, go to the shard of its hash. A shard's
suffix array is made by induced sorting in the JVM (leftmost-smaller substrings
sorted recursively, the rest induced in linear time), its common prefixes in
text order; neighbouring starts that share a length are repeats. No string
starts in two stretches, so none meets itself.

Equal stretches of an anchor are one in its shard: their strings all repeat, and
groups of copies, however large, come to a few stretches. They are told by
their digests (128 bits); bytes are moved only of anchors with two and more
different stretches, once for each of these. An anchor whose stretches still
overfill a shard is split by longer runs around it. Rows of
equal id and text are one key and travel once, with their number.

Defined results: null and empty texts have no bytes; texts shorter than a length
lose nothing by it; repeated rows are documents like any other and repeat each
other; null ``doc_id``s stay null; of very long texts a window of runs is held at
a time; other columns, whatever their names, are left out by ``remove`` and kept
by ``clean``; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, as_bytes, discard, documents, map_batches, materialize, once_each, release, text_key
from .grams import mix
from .jvm import register

LENGTH = 400
#: Four bytes a word with its space: passages of over 50 words are longer, but for the rarest.
SHORT = 200
GRAM = 32
#: Bytes of a shard about; places looked at in one go.
SHARD, STEP = 4_000_000, 1 << 20
_ODD = 0x9E3779B97F4A7C15


def _tables():
    rng = np.random.default_rng(20)
    codes = rng.integers(0, 2**63, 256, dtype=np.uint64)
    inverse = pow(_ODD, -1, 1 << 64)
    return codes, inverse


_CODES, _INVERSE = _tables()
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, n.bit_length())
    if size not in _powers:
        _powers.clear()
        one = np.ones(1, np.uint64)
        up, down = (np.cumprod(np.concatenate([one, np.full(size - 1, x, np.uint64)])) for x in (_ODD, _INVERSE))
        _powers[size] = up, down
    return _powers[size]


def byte_grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` bytes, by prefix sums modulo 2**64."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _power(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    pad = -len(x) % width
    full = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).reshape(-1)
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each anchor, and the first and last start of the strings that it is chosen for."""
    raw = np.frombuffer(data, np.uint8)
    out = []
    for lo in range(0, len(raw) - length + 1, step):
        grams = byte_grams(raw[lo : lo + step + length - 1], gram)
        # The place breaks ties, so that equal runs give the first of them.
        key = (grams & ~np.uint64(0x1FFFFF)) | np.arange(len(grams), dtype=np.uint64)
        at = (sliding_min(key, length - gram + 1) & np.uint64(0x1FFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.nonzero(np.diff(at))[0] + 1])
        last = np.concatenate([first[1:] - 1, [len(at) - 1]])
        out.append((grams[at[first]], at[first] + lo, first + lo, last + lo))
    if not out:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    return tuple(np.concatenate(x) for x in zip(*out))


def _keyed(docs: DataFrame) -> DataFrame:
    return documents(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), text_key("text").alias("k"), "text")


def _anchors(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc, k, anchor, first, more, at`` of each anchor: ``anchors`` of each text, by a hash of its own, in the JVM."""
    of = F.call_function(register(keyed.sparkSession, "littoral_byte_anchors", "littoral.ByteAnchors", "array<struct<anchor: bigint, first: int, more: int, at: int>>"), F.col("text").cast("binary"), F.lit(length), F.lit(gram))
    return keyed.select("doc", "k", F.inline(of))


def _stretches(hits: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    """Each stretch's digest and size: its ``starts``, and behind them what a string of ``length`` from the last one needs, as far as the text goes."""

    def make():
        def each(batch):
            counts, parts = [], []
            lists = batch.column(3)
            flat = lists.flatten()
            first, more = flat.field("first").to_numpy(), flat.field("more").to_numpy()
            at = 0
            for data, n in zip(as_bytes(batch.column(2)), lists.value_lengths().to_numpy().tolist()):
                parts += [data[f : f + m + length] for f, m in zip(first[at : at + n].tolist(), more[at : at + n].tolist())]
                counts.append(n)
                at += n
            digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), "<i8").reshape(-1, 2)
            rep = pa.array(np.repeat(np.arange(len(counts)), counts))
            columns = [
                *(batch.column(c).take(rep) for c in (0, 1)),
                *(flat.field(c) for c in ("n", "anchor", "first", "at")),
                pa.array(more + np.int32(1)),
                pa.array(np.fromiter(map(len, parts), np.int32, len(parts))),
                *(pa.array(np.ascontiguousarray(digest[:, c])) for c in (0, 1)),
            ]
            return pa.RecordBatch.from_arrays(columns + [pa.array(parts, pa.binary())] * with_bytes, names=names)

        return each

    schema = "doc long, k long, n long, anchor long, first int, at int, starts int, size int, h1 long, h2 long" + ", bytes binary" * with_bytes
    names = [c.split()[0] for c in schema.split(", ")]
    return map_batches(hits.select("doc", "k", "text", "found"), make, schema)


def marks(docs: DataFrame, lengths: tuple[int, ...] = (LENGTH,), gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """``doc, k, marks``: for each key with repeats, ``first`` of a stretch and, for each length, its repeated starts: so many from the first one (``all``) or runs of them (int pairs)."""
    spark = docs.sparkSession
    short, long = min(lengths), max(lengths)
    repeats = register(spark, "littoral_suffix_shard", "littoral.SuffixShard", "array<binary>")
    keyed = _keyed(docs)
    found = materialize(_anchors(keyed, short, gram), "suffix-anchors")
    # Written, so that both sides of the join come from plain exchanges and Spark can split a frequent anchor.
    twice = materialize(found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "suffix-twice")
    # Copies of a row bring each stretch several times: it is one, that stands in so many.
    hits = found.join(twice, "anchor").groupBy("doc", "k").agg(F.collect_set(F.struct("anchor", "first", "more", "at")).alias("found"), F.count("*").alias("n"))
    hits = hits.select("doc", "k", (F.col("n") / F.size("found")).cast("long").alias("copies"), "found")
    hits = materialize(hits.withColumn("found", F.transform("found", lambda f: f.withField("n", F.col("copies")))), "suffix-hits")
    discard(found)
    discard(twice)
    release(spark)
    parts = materialize(_stretches(once_each(keyed, hits), long, False), "suffix-stretches")
    copies = materialize(hits.filter("copies > 1").select("doc", "k", "copies"), "suffix-copies")
    discard(hits)
    release(spark)
    # Equal stretches are one; what several have repeats all along. One that is alone with its anchor is done by that.
    # (Its bytes are those of its place in the smallest document; of equal ones, the same row for all.)
    distinct = materialize(
        parts.groupBy("anchor", "h1", "h2").agg(F.sum("n").alias("n"), F.min("at").alias("at"), F.min("starts").alias("starts"), F.min("size").alias("size"), F.min("doc").alias("doc"), *(F.min_by(c, "doc").alias(c) for c in ("k", "first"))), "suffix-distinct"
    )
    anchors_of = materialize(distinct.groupBy("anchor").agg(F.count("*").alias("stretches"), F.sum(F.col("size").cast("long")).alias("bytes")), "suffix-sizes")
    every = F.array(*(F.greatest(F.lit(0), F.least(F.col("starts"), F.col("size") - x + 1)) for x in lengths)).alias("all")
    nothing = F.lit(None).cast("array<binary>").alias("runs")
    alone = distinct.join(anchors_of.filter("stretches = 1").select("anchor"), "anchor").select("anchor", "h1", "h2", F.lit(0).alias("off"), every, nothing)
    # Only the others' bytes are moved, each once.
    asked = distinct.join(anchors_of.filter("stretches > 1").select("anchor"), "anchor").groupBy("doc", "k")
    asked = asked.agg(F.collect_list(F.struct("anchor", "first", (F.col("starts") - 1).alias("more"), "at", "n")).alias("found"))
    asked = asked.join(copies, ["doc", "k"], "left").select("doc", "k", F.coalesce("copies", F.lit(1)).alias("copies"), "found")
    asked = materialize(asked, "suffix-asked")
    full = materialize(_stretches(once_each(keyed, asked), long, True).select("anchor", "h1", "h2", "n", "at", "starts", "bytes"), "suffix-bytes")
    release(spark)
    large = materialize(anchors_of.filter((F.col("stretches") > 1) & (F.col("bytes") > shard)).select("anchor"), "suffix-large")
    members, groups, sure = _split(full, large, lengths, gram, shard)
    size = groups.agg(F.sum(F.octet_length("bytes").cast("long"))).first()[0] or 0
    shards = size // shard + 1
    grouped = groups.groupBy(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")).agg(F.collect_list(F.struct("key", "k1", "k2", "n", "starts", "bytes")).alias("s"))
    of = ", ".join(map(str, lengths))
    called = grouped.select("s", F.expr(f"{repeats}(s.bytes, s.starts, array({of}))").alias("r"))
    runs = F.transform(F.sequence(F.lit(0), F.size("s") - 1), lambda i: F.struct(F.get("s", i).alias("s"), F.array(*(F.get("r", i + F.size("s") * k) for k in range(len(lengths)))).alias("runs")))
    marked = called.select(F.explode(runs).alias("m")).select("m.s.*", "m.runs").withColumn("size", F.octet_length("bytes"))
    some = F.exists("runs", lambda r: r.isNotNull())
    runs = materialize(marked.filter((F.col("n") > 1) | some).select("key", "k1", "k2", F.when(F.col("n") > 1, every).alias("all"), "runs"), "suffix-runs")
    release(spark)
    of_stretch = alone.unionByName(members.join(runs, ["key", "k1", "k2"]).select("anchor", "h1", "h2", "off", "all", "runs"))
    for rows in sure:
        of_stretch = of_stretch.unionByName(rows.select("anchor", "h1", "h2", "off", F.array(*(F.lit(int(x == short)) for x in lengths)).alias("all"), nothing))
    of_stretch = materialize(of_stretch, "suffix-found")
    met = parts.select("doc", "k", "anchor", "first", "h1", "h2").join(of_stretch, ["anchor", "h1", "h2"])
    out = materialize(met.groupBy("doc", "k").agg(F.collect_list(F.struct((F.col("first") + F.col("off")).alias("first"), "all", "runs")).alias("marks")), "suffix-marks")
    for table in (parts, copies, distinct, anchors_of, asked, full, runs, of_stretch):
        discard(table)
    return out


def _halved(rows: DataFrame, short: int, long: int, gram: int) -> tuple[DataFrame, int]:
    """Each stretch as two, by the side to which the bytes that all its strings share are made longer.

    The longer run is half way to a whole short string, so that each string has
    it on one side; which one follows from where the old run stands in the
    string, and so is the same for equal strings. Once it is a whole short
    string, each stretch is one start, and its run grows ahead towards the long
    length; strings that the text ends before are done.
    """
    whole = gram >= short
    longer = ((long if whole else short) + gram + 1) // 2

    def make():
        def each(batch):
            cols = {k: batch.column(i).to_pylist() for i, k in enumerate(batch.schema.names)}
            out = []
            for anchor, h1, h2, n, off, at, starts, data in zip(*(cols[k] for k in ("anchor", "h1", "h2", "n", "off", "at", "starts", "bytes"))):
                left = at - (longer - gram)
                sides = ((0, 1, 0),) if whole else ((0, min(starts, left + 1), left), (max(0, left + 1), starts, at))
                for lo, hi, place in sides:
                    if lo < hi and place + longer <= len(data):
                        part = data[lo : hi - 1 + long]
                        key = xxhash.xxh3_64_intdigest(data[place : place + longer], longer) - (1 << 63)
                        d1, d2 = np.frombuffer(xxhash.xxh3_128_digest(part), "<i8").tolist()
                        out.append((anchor, h1, h2, n, off + lo, place - lo, hi - lo, key, d1, d2, part))
            kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.int64()] * 3 + [pa.binary()]
            names = ["anchor", "h1", "h2", "n", "off", "at", "starts", "key", "k1", "k2", "bytes"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names) if out else None

        return each

    chosen = rows.select("anchor", "h1", "h2", "n", "off", "at", "starts", "bytes")
    return map_batches(chosen, make, "anchor long, h1 long, h2 long, n long, off int, at int, starts int, key long, k1 long, k2 long, bytes binary"), longer


def _split(distinct: DataFrame, large: DataFrame, lengths: tuple[int, ...], gram: int, shard: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Groups that fit a shard: ``anchor, h1, h2, off, key, k1, k2`` (what is where) and ``key, k1, k2, n, starts, bytes`` (what it is); and starts that are known to repeat at the short length.

    An anchor whose stretches would overfill a shard (``large``) has them halved and dealt
    out anew by the longer runs, as often as it takes; runs of one place alone
    go. In the end a run is a whole string, and all of it one stretch.
    """
    short, long = min(lengths), max(lengths)
    weight = F.sum(F.octet_length("bytes").cast("long"))
    fit = distinct.join(large, "anchor", "left_anti")
    members = [fit.select("anchor", "h1", "h2", F.lit(0).alias("off"), F.col("anchor").alias("key"), F.col("h1").alias("k1"), F.col("h2").alias("k2"))]
    groups = [fit.select(F.col("anchor").alias("key"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), "n", "starts", "bytes")]
    sure: list[DataFrame] = []
    rest = distinct.join(large, "anchor").withColumn("off", F.lit(0))
    while gram < long and not large.isEmpty():
        sub, gram = _halved(rest, short, long, gram)
        sub = materialize(sub, "suffix-halved")
        one = materialize(sub.groupBy("key", "k1", "k2").agg(F.sum("n").alias("n"), F.min("starts").alias("starts"), F.min("bytes").alias("bytes")), "suffix-distinct")
        sizes = materialize(one.groupBy("key").agg(F.sum("n").alias("total"), weight.alias("b")).filter("total > 1").select("key", ((F.col("b") > shard) & F.lit(gram < long)).alias("again")), "suffix-sizes")
        small, large = sizes.filter("not again").select("key"), sizes.filter("again").select("key")
        members.append(sub.join(small, "key").select("anchor", "h1", "h2", "off", "key", "k1", "k2"))
        groups.append(one.join(small, "key").select("key", "k1", "k2", "n", "starts", "bytes"))
        rest = sub.join(large, "key")
        if gram == short:
            sure.append(rest.select("anchor", "h1", "h2", "off"))

    def union(tables):
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out

    return union(members), union(groups), sure


def remove(docs: DataFrame, length: int = LENGTH, short: int = SHORT, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, n_repeated, kept``: ``kept`` are the bytes that repeats of ``length`` leave, ``n_repeated`` counts those under repeats of ``short``. Texts are cut in the JVM."""
    found = marks(docs, (length, short), gram, shard)
    release(docs.sparkSession)
    met = _keyed(docs).join(found, ["doc", "k"], "left").select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "text", "marks")

    returns = "struct<n_bytes: bigint, n_removed: bigint, n_spans: bigint, n_repeated: bigint, kept: binary>"
    done = F.call_function(register(docs.sparkSession, "littoral_repeat_remove", "littoral.RepeatRemove", returns), F.col("text").cast("binary"), F.col("marks"), F.lit(length), F.lit(short))
    return met.select("doc_id", F.inline(F.array(done)))


def clean(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """``docs`` with its columns, texts without the repeats: a character goes if all its bytes do. ``n_chars``, where there, follows.

    Texts are cut in the JVM, row by row: none goes to a Python worker.
    """
    found = marks(docs, (length,), gram, shard)
    release(docs.sparkSession)
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("own")
    text = F.col("text").cast("string")
    keyed = docs.select(own, text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), text_key("text").alias("k"))
    met = keyed.join(found, ["doc", "k"], "left")

    cut = F.call_function(register(docs.sparkSession, "littoral_repeat_cut", "littoral.RepeatCut", "binary"), text.cast("binary"), F.col("marks"), F.lit(length))
    done = met.select("own", F.when(F.col("marks").isNotNull(), cut.cast("string")).otherwise(text).alias("text"))
    n_chars = F.length("text").cast("long")
    return done.select(*(F.col("text") if c == "text" else F.when(F.col("text").isNotNull(), n_chars).alias(c) if c == "n_chars" else F.col(f"own.`{c}`") for c in docs.columns))
