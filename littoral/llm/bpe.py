"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece of text exactly one token can end its encoding. The
table of these last tokens is filled from left to right: a token may follow a
prefix if it and the prefix's own last token would not have merged across their
border. Walking back through the table gives the encoding. As the table of a
prefix never changes, appended bytes only extend it, and after an edit it is
filled again only until it agrees with what was there.

Tables of documents are encoded and decoded by JVM functions (``java``), which
fill the same table from the UTF-8 of a row without a Python worker; matches of
the public pattern are found by their classes of characters. ``PrefixTable`` and
other patterns use the Python form.

Defined results: null and empty texts have no tokens; repeated rows stay rows;
null ids stay null; a text without spaces is one piece, whose table has 4 bytes
for each of its bytes; other columns, whatever their names, are left out; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_texts, documents, map_batches
from .jvm import register

_NEVER = 1 << 60
# Fixed value: the pattern whose matches the JVM functions find.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Ranks:
    """A vocabulary of mergeable ranks, prepared for the table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        #: Tokens that merging alone can produce, by their bytes; only these can stand inside a piece.
        self.good: dict[bytes, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for t, r in sorted(ranks.items(), key=lambda x: x[1]):
            if len(t) == 1:
                self.good[t] = r
            elif halves := self._split(t, r):
                self.good[t], self.halves[r] = r, halves
        self._pairs: dict[int, bool] = {}

    def _split(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge is the last one that makes ``token``; none if merging ends elsewhere."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min(((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best >= rank:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The tokens that stood at one border of ``token`` while it was made, each with the rank that ended it."""
        out, end = [], _NEVER
        while True:
            out.append((self.token[token], end))
            if token not in self.halves:
                return out
            end, token = token, self.halves[token][side]

    def fit(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` side by side stay two tokens."""
        key = a << 32 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > 200_000:
                self._pairs.clear()
            get = self.ranks.get
            # The leftmost of equal ranks merges first: a merge inside a wins, one inside b loses.
            known = not any((m := get(x + y)) is not None and m < x_end and m <= y_end for x, x_end in self._spine(a, 1) for y, y_end in self._spine(b, 0))
            self._pairs[key] = known
        return known

    def extend(self, data: bytes | bytearray, last: list[int], start: int, stop: int | None = None) -> None:
        """Fill ``last[start..]``, where ``last[i]`` ends the encoding of ``data[:i]``; ``last[:start]`` is filled."""
        good, known, fit, longest = self.good.get, self._pairs.get, self.fit, self.longest
        data = bytes(data)
        for i in range(start, (len(data) if stop is None else stop) + 1):
            for j in range(i - longest if i > longest else 0, i):
                t = good(data[j:i])
                if t is not None:
                    if j:
                        fits = known(last[j] << 32 | t)
                        if fits is None:
                            fits = fit(last[j], t)
                        if not fits:
                            continue
                    last[i] = t
                    break

    def walk(self, last: list[int], end: int) -> list[int]:
        out = []
        while end:
            out.append(last[end])
            end -= len(self.token[last[end]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """One match of the pattern; a piece that is a token as a whole is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last = [0] * (len(piece) + 1)
        self.extend(piece, last, 1)
        return self.walk(last, len(piece))


class PrefixTable:
    """The table of one piece of text, kept for appends and edits (no pattern is applied)."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, bytearray(), [0]
        self.append(data)

    def append(self, data: bytes) -> None:
        start = len(self.data) + 1
        self.data += data
        self.last += [0] * len(data)
        self.ranks.extend(self.data, self.last, start)

    def replace(self, lo: int, hi: int, data: bytes) -> int:
        """Put ``data`` in place of ``[lo, hi)``; returns how many entries had to be filled again."""
        old = self.last[hi + 1 :]
        self.data[lo:hi] = data
        tail = lo + len(data)
        self.last = self.last[: lo + 1] + [0] * (len(self.data) - lo)
        agreed, i, now = 0, lo, bytes(self.data)
        while i < len(self.data):
            i += 1
            self.ranks.extend(now, self.last, i, i)
            if i > tail:
                # Entries look back no further than the longest token: so many that agree, and all do.
                agreed = agreed + 1 if self.last[i] == old[i - tail - 1] else 0
                if agreed >= self.ranks.longest:
                    self.last[i + 1 :] = old[i - tail :]
                    break
        return i - lo

    def tokens(self) -> list[int]:
        whole = self.ranks.ranks.get(bytes(self.data))
        return [whole] if whole is not None else self.ranks.walk(self.last, len(self.data))


@lru_cache(maxsize=4)
def load(path: str) -> Ranks:
    """A ``.tiktoken`` file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return Ranks({base64.b64decode(t): int(r) for t, r in map(bytes.split, f)})


def encode(texts: list[str], path: str, pattern: str = PATTERN) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers, in Python."""
    ranks, pieces = load(path), regex.compile(pattern).findall
    return [np.array([i for p in pieces(t) for i in ranks.encode_piece(p.encode())], "<u4").tobytes() for t in texts]


def decode(ids: bytes, path: str) -> bytes:
    return b"".join(map(load(path).token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(docs: DataFrame, path: str, pattern: str = PATTERN) -> DataFrame:
    """``doc_id, ids``: the ids of each row as bytes."""
    if pattern == PATTERN:
        name = register(docs.sparkSession, "littoral_bpe_encode", "littoral.BpeEncode", "binary")
        return documents(docs).select("doc_id", F.call_udf(name, F.col("text").cast("binary"), F.lit(path)).alias("ids"))

    def make():
        def each(batch):
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(encode(as_texts(batch.column(1)), path, pattern), pa.binary())], names=["doc_id", "ids"])

        return each

    return map_batches(documents(docs), make, "doc_id long, ids binary")


def _decoded(spark, path: str):
    name = register(spark, "littoral_bpe_decode", "littoral.BpeDecode", "binary")
    return F.call_udf(name, F.col("ids"), F.lit(path))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` again from ``doc_id, ids``."""
    return encoded.select("doc_id", _decoded(encoded.sparkSession, path).cast("string").alias("text"))


def digests(docs: DataFrame, path: str, pattern: str = PATTERN, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``): encoded, then decoded from the ids, row by row."""
    encoded = encode_documents(docs, path, pattern)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    out = encoded.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2(_decoded(docs.sparkSession, path), 256).alias("decoded_sha256"), "ids")
    return out if with_ids else out.drop("ids")
