"""Token ids in shard files of compressed planes.

A shard holds the ids of whole documents, one after the other, in blocks of a
fixed number of ids. Each block is transposed: byte k (or bit k) of all its ids
stands together as plane k, and each plane is compressed with zstandard on its
own, so that the almost constant high planes cost next to nothing. Behind the
blocks stand the documents' ids and lengths and an index of the planes'
offsets; any range of ids is read by decoding its blocks alone.

    magic | planes of block 0 | planes of block 1 | ... | documents | index | lengths of the last two | magic

Documents are dealt out by ranges of ``doc_id`` and encoded in that order, so
shard numbers ascend with ``doc_id``. A shard's file has the name of its
attempt, and the manifest, which Spark commits once, names the files that count:
a task that runs again, or twice at once, disturbs nothing.

Defined results: a null or empty text is the end id alone; null ``doc_id``s come
first; rows of the same ``doc_id`` are ordered by text; repeated rows stay rows;
a text without spaces is encoded as a whole and never remembered; other columns,
whatever their names, are left out; an empty table gives no shards and an empty
result.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import CUT, byte_letters
from .common import documents, materialize, path as scratch_path

MAGIC = b"LTPLANE1"
BLOCK = 1 << 16
LEVEL = 3
#: Bytes of a shard's texts about, as its table's files hold them.
SHARD_BYTES = 64_000_000
_TAIL = struct.Struct("<QQ8s")
NULL_ID = -(1 << 63)


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """The planes of a block, lowest first."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k]).tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    if kind == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class ShardWriter:
    """Appends documents; memory holds one block and 16 bytes for each document."""

    def __init__(self, sink, kind: str = "byte", block: int = BLOCK, level: int = LEVEL):
        self.sink, self.kind, self.block = sink, kind, block
        self.zip = zstandard.ZstdCompressor(level=level).compress
        self.rest: list[np.ndarray] = []
        self.waiting = self.n_ids = 0
        self.at = len(MAGIC)
        self.blocks: list[list[int]] = []
        self.doc_ids: list[int] = []
        self.lengths: list[int] = []
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(NULL_ID if doc_id is None else doc_id)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            joined = np.concatenate(self.rest)
            whole = len(joined) // self.block * self.block
            for lo in range(0, whole, self.block):
                self._block(joined[lo : lo + self.block])
            self.rest, self.waiting = [joined[whole:]], len(joined) - whole

    def _block(self, ids: np.ndarray) -> None:
        sizes = []
        for p in to_planes(ids, self.kind):
            z = self.zip(p)
            self.sink.write(z)
            sizes.append(len(z))
        self.blocks.append([self.at, len(ids), *sizes])
        self.at += sum(sizes)

    def close(self) -> None:
        if self.waiting:
            self._block(np.concatenate(self.rest))
        docs = self.zip(np.array(self.doc_ids, "<i8").tobytes() + np.array(self.lengths, "<u4").tobytes())
        index = self.zip(json.dumps({"kind": self.kind, "block": self.block, "n_ids": self.n_ids, "n_docs": len(self.doc_ids), "blocks": self.blocks}).encode())
        self.sink.write(docs + index + _TAIL.pack(len(docs), len(index), MAGIC))


class ShardReader:
    """Documents and any range of ids of a shard, from a seekable file."""

    def __init__(self, source, size: int):
        self.source, self.unzip = source, zstandard.ZstdDecompressor().decompress
        n_docs, n_index, magic = _TAIL.unpack(self._read(size - _TAIL.size, _TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a shard of token planes")
        end = size - _TAIL.size
        self.index = json.loads(self.unzip(self._read(end - n_index, n_index)))
        docs, n = self.unzip(self._read(end - n_index - n_docs, n_docs)), self.index["n_docs"]
        self.doc_ids, self.lengths = np.frombuffer(docs, "<i8", n), np.frombuffer(docs, "<u4", n, 8 * n)

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def block(self, k: int) -> np.ndarray:
        at, n, *sizes = self.index["blocks"][k]
        raw, planes = self._read(at, sum(sizes)), []
        for size in sizes:
            planes.append(self.unzip(raw[:size]))
            raw = raw[size:]
        return from_planes(planes, n, self.index["kind"])

    def ids(self, start: int, stop: int) -> np.ndarray:
        size = self.index["block"]
        if start >= stop:
            return np.zeros(0, np.uint32)
        parts = [self.block(k) for k in range(start // size, (stop - 1) // size + 1)]
        return np.concatenate(parts)[start - start // size * size :][: stop - start]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``doc_id``, start in the shard and ids of each document, block by block."""
        rest, k, at = np.zeros(0, np.uint32), 0, 0
        for doc_id, n in zip(self.doc_ids.tolist(), self.lengths.tolist()):
            parts, have = [rest], len(rest)
            while have < n:
                parts.append(self.block(k))
                have += len(parts[-1])
                k += 1
            joined = np.concatenate(parts)
            yield None if doc_id == NULL_ID else doc_id, at, joined[:n]
            rest, at = joined[n:], at + n


class Encoder:
    """Ids of texts by the tokenizers library: of each chunk between spaces once, while it is remembered."""

    #: Chunks that are remembered at most, and their characters; bytes of text at work; chunks that the library is given as one text.
    LIMIT, LONGEST, AT_ONCE, RUN = 200_000, 48, 8_000_000, 2000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        letters = set(byte_letters().values())
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        if any(c not in letters for t in vocabulary for c in t):
            raise ValueError("not a byte-level vocabulary")
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.n_bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Texts with a special string are the library's own to cut; so are those with other white space beside a space ours.
        self.special = "|".join(map(re.escape, special)) or r"[^\s\S]"
        self.odd = r"\s\s|^\s|\s$|[\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _behind_spaces(self, chunks: list[str], sizes: np.ndarray) -> pa.Array:
        """Many chunks of so many bytes as one text, told apart by the bytes of their ids: a space between two of them starts a match."""
        parts, ends, at = [], [np.zeros(1, np.int64)], 0
        for lo in range(0, len(chunks), self.RUN):
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(chunks[lo : lo + self.RUN])], add_special_tokens=False)[0].ids, "<u4")
            stops = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(sizes[lo : lo + self.RUN] + 1)) + 1
            parts.append(ids)
            ends.append(4 * stops + at)
            at += 4 * len(ids)
        raw = np.concatenate(parts) if parts else np.zeros(0, "<u4")
        return pa.Array.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(np.concatenate(ends)), pa.py_buffer(raw)])

    def _of_chunks(self, lists: pa.ListArray) -> list[np.ndarray]:
        """The ids of texts given as their chunks, none of which is empty but for a text without any."""
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        stops = np.cumsum(counts)
        starts = stops - counts
        coded = lists.flatten().dictionary_encode()
        at, unique = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        first = np.unique(at[starts])
        heads = pa.array(self._ids([unique[k] for k in first.tolist()]), pa.large_binary())
        values = list(map(self.known.get, unique))
        new = [k for k, v in enumerate(values) if v is None]
        fresh = self._behind_spaces([unique[k] for k in new], pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)[new].astype(np.int64))
        place = np.arange(len(unique))
        place[new] = len(unique) + np.arange(len(new))
        behind = place[at]
        behind[starts] = len(unique) + len(new) + np.searchsorted(first, at[starts])
        every = pa.concat_arrays([pa.array(values, pa.large_binary()), fresh, heads])
        size = pc.binary_length(every).fill_null(0).to_numpy(zero_copy_only=False)[behind]
        ends = np.cumsum(size) // 4
        joined = np.frombuffer(every.take(pa.array(behind)).buffers()[2] or b"", "<u4", int(ends[-1]))
        self._remember(unique, new, fresh, np.bincount(at, minlength=len(unique)))
        return [joined[lo:hi] for lo, hi in zip((ends[starts] - size[starts] // 4).tolist(), ends[stops - 1].tolist())]

    def _remember(self, unique: list[str], new: list[int], fresh: pa.Array, times: np.ndarray) -> None:
        """Short chunks that came more than once; what came first is mostly what comes often, so the later half goes."""
        again = [(j, k) for j, k in enumerate(new) if times[k] > 1 and len(unique[k]) <= self.LONGEST]
        if len(self.known) + len(again) > self.LIMIT:
            self.known = dict(islice(self.known.items(), self.LIMIT // 2))
            again = again[: self.LIMIT // 2]
        if again:
            self.known.update(zip((unique[k] for _, k in again), fresh.take(pa.array([j for j, _ in again])).to_pylist()))

    def _some(self, texts: pa.Array) -> list[np.ndarray]:
        special = pc.match_substring_regex(texts, self.special).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False) & ~special
        out: list = [None] * len(texts)
        for which, of in ((special, self._whole), (odd, self._cut), (~special & ~odd, lambda x: self._of_chunks(pc.split_pattern(x, " ")))):
            at = np.nonzero(which)[0]
            if len(at):
                for k, ids in zip(at.tolist(), of(texts.take(pa.array(at)))):
                    out[k] = ids
        return out

    def _whole(self, texts: pa.Array) -> list[np.ndarray]:
        return [np.frombuffer(x, "<u4") for x in self._ids(texts.to_pylist())]

    def _cut(self, texts: pa.Array) -> list[np.ndarray]:
        return self._of_chunks(pa.array([CUT.split(t) for t in texts.to_pylist()], pa.list_(texts.type)))

    def encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        texts = pc.fill_null(texts, "")
        before = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))])
        lo = 0
        while lo < len(texts):  # some MB at a time, so that what is wanted at once stays small
            hi = max(lo + 1, int(np.searchsorted(before, before[lo] + self.AT_ONCE, "right")) - 1)
            yield from self._some(texts.slice(lo, hi - lo))
            lo = hi


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """Lives as long as the Python worker."""
    return Encoder(path)


def encode(texts: list[str], path: str) -> list[np.ndarray]:
    """The library's ids of each text."""
    return list(_encoder(path).encoded(pa.array(texts, pa.string())))


def write_shards(docs: DataFrame, out: str, path: str, end_id: int = 0, kind: str = "byte", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write shards of all rows to the folder ``out``, which executors share; returns ``shard, path, n_docs, n_ids``.

    Shards are ranges of ``doc_id`` and the first characters of the text, so
    that one id with many rows does not have to be one shard.
    """
    texts = documents(docs)
    about = int(str(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # Beyond a petabyte the planner's estimate stands for "unknown".
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-about // shard_bytes) if about < 1 << 50 else 1)
    ordered = texts.repartitionByRange(shards, F.col("doc_id"), F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], np.uint32)

    def run(batches):
        task = TaskContext.get()
        shard, writer = task.partitionId(), None
        fs, folder = pafs.FileSystem.from_uri(out)
        # Each attempt has a file of its own; the manifest, which Spark commits once, names the one that counts.
        name = f"part-{shard:06d}-{task.taskAttemptId()}.planes"
        encoder = _encoder(path)
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                fs.create_dir(folder, recursive=True)
                sink = fs.open_output_stream(f"{folder}/{name}")
                writer = ShardWriter(sink, kind)
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encoded(batch.column(1))):
                writer.add(doc_id, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([f"{out}/{name}"]), pa.array([len(writer.doc_ids)]), pa.array([writer.n_ids])], names=["shard", "path", "n_docs", "n_ids"])

    return materialize(ordered.mapInArrow(run, "shard long, path string, n_docs long, n_ids long"), "planes-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of every document; ``start`` counts the ids of all documents before it.

    The running sum is over one row a shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    dealt = manifest.select("shard", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")).repartition(max(1, manifest.count()), "shard")

    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                fs, name = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as source:
                    rows, held = [], 0
                    for doc_id, at, ids in ShardReader(source, source.size()).documents():
                        rows.append((doc_id, base + at, ids.tobytes()))
                        held += len(ids)
                        if held > 1 << 20:
                            yield _rows(rows)
                            rows, held = [], 0
                    if rows:
                        yield _rows(rows)

    return dealt.mapInArrow(run, "doc_id long, start long, ids binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["doc_id", "start", "ids"])


def round_trip(docs: DataFrame, path: str, end_id: int = 0, kind: str = "byte") -> DataFrame:
    """Written and read back: ``doc_id, start, n_tokens, ids_crc32``."""
    manifest = write_shards(docs, scratch_path(docs.sparkSession, "planes"), path, end_id, kind)
    return read_shards(manifest).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
