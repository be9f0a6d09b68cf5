"""Repeated word windows by prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words. Each word covered by a window that
also starts in a document with a smaller id is removed.

Which suffixes can lie below a deep node is settled first, without moving words:
of each window the run of ``RUN`` words in it that hashes lowest (equal windows
have it at the same place, one in about five words is such a run) is looked up
among the documents, and only stretches of windows around a run that two
documents have go on. Equal stretches are one, told by their digests (128 bits),
with the smallest document that has it: copies, however many, are done by that.

What is left are stretches that share a run but differ. Their suffixes are split
into groups by a prefix of their words: of ``PREFIX`` words first, twice as many
where a group would not fit a bucket of memory size, up to the whole window.
Groups are packed into buckets; in each the suffixes are sorted and their common
prefixes give the internal nodes of the group's suffix tree. Nodes ``WINDOW``
words deep and deeper are the repeats; a suffix below one is removed from if the
node has a smaller document. A prefix of a whole window that still has too many
suffixes is such a node itself, and only its smallest document is looked for.

Defined results: null and empty texts have no words; texts shorter than a window
lose nothing; rows of the same ``doc_id`` never remove from each other; a null
``doc_id`` counts as larger than all others (two nulls as equal); repeated rows
stay rows, and travel once; very long texts are many stretches; other columns,
whatever their names, are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, as_bytes, discard, documents, map_batches, materialize, once_each, release, text_key
from .grams import gram_hashes
from .jvm import register

WINDOW = 13
#: Words of the runs by which stretches are found, and of the shortest prefix of a group of suffixes.
RUN, PREFIX = 5, 2
#: Words of a bucket about: those of its suffixes, each as long as its stretch goes on.
BUCKET = 500_000


def anchors(words: np.ndarray, sizes: np.ndarray, window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, ...]:
    """For each chosen run of texts laid end to end, ``sizes`` words each: its text, its hash, its position, and the first and last start of the windows that it is chosen for (all counted from the first text)."""
    grams = gram_hashes(words, run)
    n = len(words) - window + 1
    windows = np.maximum(sizes - window + 1, 0)
    if n <= 0 or not windows.any():
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    low, at = grams[:n].copy(), np.zeros(n, np.int64)
    for k in range(1, window - run + 1):
        here = grams[k : k + n]
        less = here < low
        low[less] = here[less]
        at[less] = k
    text = np.repeat(np.arange(len(sizes)), windows)
    start = np.arange(len(text)) + (np.cumsum(sizes) - sizes - np.cumsum(windows) + windows)[text]
    at = at[start] + start
    first = np.concatenate([[0], np.nonzero(np.diff(at))[0] + 1])
    last = np.concatenate([first[1:] - 1, [len(start) - 1]])
    return text[first], grams[at[first]], at[first], start[first], start[last]


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc, k, text``: rows of equal id and text are one key, and have the same result."""
    return documents(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), text_key("text").alias("k"), "text")


def _runs(keyed: DataFrame, window: int, run: int) -> DataFrame:
    """``doc, k, run, first, more`` of each stretch: ``anchors`` of each text, by a hash of its own, in the JVM."""
    of = F.call_function(register(keyed.sparkSession, "littoral_word_runs", "littoral.WordRuns", "array<struct<run: bigint, first: int, more: smallint>>"), F.col("text").cast("binary"), F.lit(window), F.lit(run))
    return keyed.select("doc", "k", F.inline(of))


def _stretches(texts: DataFrame, window: int, with_words: bool) -> DataFrame:
    """``doc, k, run, first, more, h1, h2`` of each stretch of windows: a digest of its words, and its ``words``."""
    schema = "doc long, k long, run long, first int, more short, h1 long, h2 long" + ", words string" * with_words
    names = [c.split()[0] for c in schema.split(", ")]

    def make():
        def each(batch):
            counts, words = [], []
            lists = batch.column(3)
            flat = lists.flatten()
            first, more = flat.field("first").to_numpy(), flat.field("more").to_numpy()
            at = 0
            for data, n in zip(as_bytes(batch.column(2)), lists.value_lengths().to_numpy().tolist()):
                w = data.split()
                words += [b" ".join(w[f : f + m + window]) for f, m in zip(first[at : at + n].tolist(), more[at : at + n].tolist())]
                counts.append(n)
                at += n
            digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<i8").reshape(-1, 2)
            rep = pa.array(np.repeat(np.arange(len(counts)), counts))
            columns = [*(batch.column(c).take(rep) for c in (0, 1)), *(flat.field(c) for c in ("run", "first", "more")), *(pa.array(np.ascontiguousarray(digest[:, c])) for c in (0, 1))]
            return pa.RecordBatch.from_arrays(columns + [pa.array(words, pa.binary()).cast(pa.string())] * with_words, names=names)

        return each

    return map_batches(texts.select("doc", "k", "text", "found"), make, schema)


def sorted_suffixes(suffixes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The order of suffixes by their words (by numbers given to these), and the words that each shares with the one before it."""
    lists = pc.split_pattern(suffixes, " ")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    width = int(sizes.max())
    # Ends differ from every word and from each other.
    table = np.repeat(-1 - np.arange(len(sizes), dtype=np.int32)[:, None], width, axis=1)
    table[np.arange(width) < sizes[:, None]] = lists.flatten().dictionary_encode().indices.to_numpy()
    order = np.lexsort(table.T[::-1])
    ranked = table[order]
    differ = ranked[1:] != ranked[:-1]
    return order, np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), width)])


def nodes(common: np.ndarray, depth: int) -> list[tuple[int, int, int]]:
    """Internal nodes ``(depth, first, end)`` at ``depth`` and deeper of the tree of sorted suffixes: a node spans suffixes that share so many words and no more. A node comes after those below it."""
    out: list[tuple[int, int, int]] = []
    open_: list[tuple[int, int]] = []
    for i, shared in enumerate([*common.tolist()[1:], 0], 1):
        first = i - 1
        while open_ and open_[-1][0] > shared:
            d, first = open_.pop()
            out.append((d, first, i))
        if shared >= depth and (not open_ or open_[-1][0] < shared):
            open_.append((shared, first))
    return out


def _subtrees(table: pa.Table, window: int) -> pa.Table:
    """The suffixes of a bucket, ``h1, h2, at``, that lie below a deep node with a smaller document than theirs."""
    order, common = sorted_suffixes(table["words"].combine_chunks())
    least = table["least"].to_numpy()[order]
    marked = np.zeros(len(order), bool)
    end = len(order)
    # The shallowest of the deep nodes has all below it; after it in this order comes what lies beside it.
    for _, first, stop in reversed(nodes(common, window)):
        if first < end and stop <= end:
            marked[first:stop] = least[first:stop] > least[first:stop].min()
            end = first
    return table.select(["h1", "h2", "at"]).take(pa.array(np.sort(order[marked])))


def _suffixes(stretches: DataFrame, prefix: int, before: int, with_words: bool) -> DataFrame:
    """Suffixes of ``stretches``: ``h1, h2, least, at``, their number of words, a hash of their first words (and of as many as were tried before)."""
    w = F.col("w")

    def suffix(i):
        def start(n: int):
            return F.xxhash64(F.array_join(F.slice(w, i + 1, n), " "))

        whole = [F.array_join(F.slice(w, i + 1, F.size(w)), " ").alias("words")] * with_words
        return F.struct(i.alias("at"), (F.size(w) - i).alias("size"), start(prefix).alias("group"), *([start(before).alias("parent")] if before else []), *whole)

    each = stretches.select("h1", "h2", "least", "more", F.split("words", " ").alias("w"))
    return each.select("h1", "h2", "least", F.inline(F.transform(F.sequence(F.lit(0), F.col("more").cast("int")), suffix)))


def _grouped(stretches: DataFrame, window: int, prefix: int, bucket: int) -> tuple[DataFrame, DataFrame | None]:
    """Suffixes with a ``group``, whose prefixes are as long as it takes for it to fit a bucket; and those below whole windows that never do.

    Large groups are as few as buckets that they would fill: the suffixes of all
    others meet a short list, not each other.
    """
    fit, before, parents = None, 0, None
    while True:

        def own(with_words, prefix=prefix, before=before, parents=parents):
            rows = _suffixes(stretches, prefix, before, with_words)
            return rows if parents is None else rows.join(parents, "parent", "left_semi").drop("parent")

        large = materialize(own(False).groupBy("group").agg(F.sum("size").alias("size")).filter(F.col("size") > bucket).select("group"), "repeat-large")
        some = not large.isEmpty()
        rest = own(True).join(large, "group", "left_anti") if some else own(True)
        fit = rest if fit is None else fit.unionByName(rest)
        if not some:
            return fit, None
        if prefix >= window:
            return fit, own(True).join(large, "group", "left_semi")
        before, parents, prefix = prefix, large.withColumnRenamed("group", "parent"), min(window, 2 * prefix)


def trees(stretches: DataFrame, window: int = WINDOW, prefix: int = PREFIX, bucket: int = BUCKET) -> DataFrame:
    """``h1, h2, bits`` of ``stretches`` (h1, h2, more, least, words), which are read several times: bit i: the window at i also starts in a document smaller than ``least``."""
    fit, frequent = _grouped(stretches, window, prefix, bucket)
    n = F.col("more") + 1
    size = stretches.agg(F.sum(n * (n + window - 1) - n * (n - 1) / 2).cast("long")).first()[0] or 0
    buckets = size // bucket + 1
    tasks = max(int(stretches.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // 16)
    dealt = fit.select("h1", "h2", "least", "at", "words", F.pmod("group", F.lit(buckets)).alias("bucket")).repartition(tasks, "bucket")
    below = dealt.groupBy("bucket").applyInArrow(lambda t: _subtrees(t.drop_columns(["bucket"]), window), "h1 long, h2 long, at int")
    if frequent is not None:
        whole = frequent.withColumn("node", F.substring_index("words", " ", window))
        node = materialize(whole.groupBy("node").agg(F.min("least").alias("smallest")), "repeat-nodes")
        below = below.unionByName(whole.join(node, "node").filter("smallest < least").select("h1", "h2", "at"))
    return materialize(below.groupBy("h1", "h2").agg(F.expr("bit_or(shiftleft(1L, at))").alias("bits")), "repeat-bits")


def marks(docs: DataFrame, window: int = WINDOW, run: int = RUN, prefix: int = PREFIX, bucket: int = BUCKET) -> DataFrame:
    """``doc, k, marks``: for each key with removed words the marked windows as ``first, bits``."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    found = materialize(_runs(keyed, window, run), "repeat-runs")
    shared = materialize(found.groupBy("run").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a < b").select("run"), "repeat-shared")
    release(spark)
    hits = found.join(shared, "run").groupBy("doc", "k").agg(F.collect_set(F.struct("run", "first", "more")).alias("found"), F.count("*").alias("n"))
    hits = materialize(hits.select("doc", "k", (F.col("n") / F.size("found")).cast("long").alias("copies"), "found"), "repeat-hits")
    discard(found)
    discard(shared)
    release(spark)
    parts = materialize(_stretches(once_each(keyed, hits), window, False), "repeat-stretches")
    copies = materialize(hits.filter("copies > 1").select("doc", "k", "copies"), "repeat-copies")
    discard(hits)
    release(spark)
    # All of a row by the same smallest document (of equal ones, the same row).
    distinct = materialize(parts.groupBy("h1", "h2").agg(F.min("doc").alias("doc"), *(F.min_by(c, "doc").alias(c) for c in ("k", "first", "more", "run"))), "repeat-distinct")
    # Runs of several stretches, not all of which first stand in the same document.
    open_ = materialize(distinct.groupBy("run").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a < b").select("run"), "repeat-open")
    asked = distinct.drop("h1", "h2").join(open_, "run").groupBy("doc", "k").agg(F.collect_list(F.struct("run", "first", "more")).alias("found"))
    asked = materialize(asked.join(copies, ["doc", "k"], "left").select("doc", "k", F.coalesce("copies", F.lit(1)).alias("copies"), "found"), "repeat-asked")
    release(spark)
    # Written, and what made it deleted, before its suffixes are dealt out: texts and suffixes are not on disk at once.
    words = materialize(_stretches(once_each(keyed, asked), window, True).withColumnRenamed("doc", "least").drop("doc", "k", "run", "first"), "repeat-words")
    for table in (asked, copies, open_):
        discard(table)
    release(spark)
    bits = trees(words, window, prefix, bucket)
    discard(words)
    release(spark)
    # Written, so that a stretch with many copies meets it from plain exchanges, which Spark can split.
    of = materialize(distinct.select("h1", "h2", F.col("doc").alias("least")).join(bits, ["h1", "h2"], "left"), "repeat-of")
    every = F.expr("shiftleft(1L, more + 1) - 1")
    met = parts.join(of, ["h1", "h2"]).select("doc", "k", "first", F.when(F.col("doc") > F.col("least"), every).otherwise(F.coalesce("bits", F.lit(0))).alias("bits")).filter("bits != 0")
    out = materialize(met.groupBy("doc", "k").agg(F.collect_list(F.struct("first", "bits")).alias("marks")), "repeat-marks")
    for table in (parts, distinct, bits, of):
        discard(table)
    return out


def _kept(words: list[bytes], first: np.ndarray, bits: np.ndarray, window: int) -> list[bytes]:
    edge = np.zeros(len(words) + 1, np.int64)
    for k in range(64):
        at = first[(bits >> k & 1).astype(bool)] + k
        if not len(at) and not (bits >> k).any():
            break
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


def remove(docs: DataFrame, window: int = WINDOW, run: int = RUN, prefix: int = PREFIX, bucket: int = BUCKET) -> DataFrame:
    """Per row ``doc_id, n_words, n_removed, kept``: the kept words joined by one space."""
    found = marks(docs, window, run, prefix, bucket)
    release(docs.sparkSession)
    met = _keyed(docs).join(found, ["doc", "k"], "left").select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "text", "marks")

    def make():
        def each(batch):
            n, gone, kept = [], [], []
            for data, m in zip(as_bytes(batch.column(1)), batch.column(2)):
                w = data.split()
                left = w
                if m.is_valid:
                    left = _kept(w, m.values.field("first").to_numpy().astype(np.int64), m.values.field("bits").to_numpy(), window)
                n.append(len(w))
                gone.append(len(w) - len(left))
                kept.append(b" ".join(left))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

        return each

    return map_batches(met, make, "doc_id long, n_words long, n_removed long, kept string")

