"""Token counts without ids: pieces are counted once for each distinct pre-token.

Each text becomes its distinct pre-tokens and how often each stands in it (a JVM
function; nothing else is kept of the text). The corpus' distinct pre-tokens are
gathered, and the tokenizer's model counts the pieces of each once. Every
per-document frequency is then joined to these counts and summed. The join is
split by frequency: the most frequent pre-tokens, a table of bounded size, are
broadcast, the many rare ones, a few percent of all frequencies, meet theirs by
a shuffle. Both are exact, and no hot pre-token is ever shuffled. Texts are cut
again where they are needed again, which costs less than writing their pieces.

Meant for tokenizers whose pre-tokenizer never joins two sides of white space
(all that split on white space do). Those that normalise and split as
``NATIVE`` are cut in the JVM; the others by their own library in Python.

Defined results: null texts count as empty, with no bytes and no tokens;
repeated rows (equal id and text) stay rows; null ids stay null; other columns,
whatever their names, are left out; an empty table gives an empty result. A
text without white space is one chunk, whatever its length.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import byte_letters
from .common import NULL_ID, discard, documents, materialize, text_key
from .jvm import register

#: Pre-tokens that are broadcast at most, and the characters that one of them may have.
HEAD, HEAD_CHARS = 100_000, 32
LIMIT = 2048

# What a tokenizer's file says if the JVM function cuts as it does.
NATIVE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_ENTRIES = "array<struct<pre_token:string,n:int>>"


class Cutter:
    """Pre-tokens of chunks, and the pieces of pre-tokens, by the tokenizers library.

    A pre-token is the text that it stands for, after normalisation. One that
    begins with a space, which none does, is a chunk for the whole tokenizer,
    one with two spaces a string as the library's pre-tokenizer writes it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        # A special string with white space in it, or one that is looked for in lower case, is not for the JVM function.
        self.native = all(config[k] == v for k, v in NATIVE.items()) and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or t["content"].split() != [t["content"]] for t in config["added_tokens"])
        self.letters = byte_letters()

    def cut(self, text: str) -> Counter:
        """The pre-tokens of a text by the library's own normaliser and pre-tokenizer; an empty one stands for the text."""
        out, normalizer, splitter = Counter([""]), self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        for chunk in regex.findall(r"\S+", text):
            if any(s in chunk for s in self.special):
                out[" " + chunk] += 1
                continue
            low = chunk if normalizer is None else normalizer.normalize_str(chunk)
            out.update("  " + p for p, _ in splitter.pre_tokenize_str(low))
        return out

    def pieces(self, pre_token: str) -> int:
        if pre_token.startswith("  "):
            return len(self.tokenizer.model.tokenize(pre_token[2:]))
        if pre_token.startswith(" "):
            return len(self.tokenizer.encode(pre_token[1:], add_special_tokens=False).ids)
        return len(self.tokenizer.model.tokenize(pre_token.encode().decode("latin-1").translate(self.letters)))


@lru_cache(maxsize=4)
def _cutter(path: str) -> Cutter:
    return Cutter(path)


def frequencies(docs: DataFrame, path: str) -> DataFrame:
    """``doc, k, n_bytes, pre_token, n``: one row for each distinct pre-token of each row; the empty pre-token is the row itself."""
    cutter = _cutter(path)
    if cutter.native:
        name = register(docs.sparkSession, "littoral_pre_tokens", "littoral.PreTokens", _ENTRIES)
        entries = F.call_udf(name, F.col("text").cast("binary"), F.lit(" ".join(cutter.special)))
    else:

        @F.arrow_udf(_ENTRIES)
        def cut(texts: pa.Array) -> pa.Array:
            own = _cutter(path)
            return pa.array([[{"pre_token": p, "n": n} for p, n in own.cut(t or "").items()] for t in texts.to_pylist()], pa.list_(pa.struct([("pre_token", pa.string()), ("n", pa.int32())])))

        entries = cut("text")
    row = documents(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), text_key("text").alias("k"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), entries.alias("e"))
    return row.select("doc", "k", "n_bytes", F.inline("e"))


def vocabulary(docs: DataFrame, path: str) -> DataFrame:
    """``pre_token, freq, pieces`` of every distinct pre-token; of the empty one no pieces."""

    def count(batches):
        cutter = _cutter(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([cutter.pieces(p) if p else 0 for p in batch.column(0).to_pylist()], pa.int32())], names=["pre_token", "freq", "pieces"])

    counted = frequencies(docs, path).groupBy("pre_token").agg(F.sum("n").alias("freq"))
    return materialize(counted.mapInArrow(count, "pre_token string, freq long, pieces int"), "pre-tokens")


def _head(vocab: DataFrame, most: int) -> DataFrame:
    """The most frequent pre-tokens: those above the least power of two that ``most`` of them at most reach, and the empty one."""
    short = vocab.filter((F.length("pre_token") <= HEAD_CHARS) & (F.col("pre_token") != ""))
    by_power = {r.power: r.n for r in short.groupBy(F.floor(F.log2("freq")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()}
    total, least = 0, 62
    for power in sorted(by_power, reverse=True):
        total += by_power[power]
        if total > most:
            break
        least = power
    return vocab.filter((F.col("pre_token") == "") | (F.length("pre_token") <= HEAD_CHARS) & (F.col("freq") >= (1 << least))).select("pre_token", "pieces")


def count(docs: DataFrame, path: str, limit: int = LIMIT, head: int = HEAD) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row."""
    vocab = vocabulary(docs, path)
    often = materialize(_head(vocab, head), "pre-tokens-head")
    entries = frequencies(docs, path)
    # Bounded: HEAD rows of HEAD_CHARS characters. Every row has its empty pre-token here.
    summed = entries.join(F.broadcast(often), "pre_token").groupBy("doc", "k").agg(F.max("n_bytes").alias("n_bytes"), F.sum(F.col("n") * F.col("pieces")).alias("a"), F.sum(F.when(F.col("pre_token") == "", F.col("n"))).cast("int").alias("copies"))
    tail = entries.drop("n_bytes").join(F.broadcast(often.select("pre_token")), "pre_token", "left_anti")
    rest = vocab.join(F.broadcast(often.select("pre_token")), "pre_token", "left_anti").select("pre_token", "pieces")
    more = tail.join(rest, "pre_token").groupBy("doc", "k").agg(F.sum(F.col("n") * F.col("pieces")).alias("b"))
    n_tokens = ((F.col("a") + F.coalesce("b", F.lit(0))) / F.col("copies")).cast("long").alias("n_tokens")
    rows = summed.join(more, ["doc", "k"], "left").select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "n_bytes", n_tokens, F.explode(F.sequence(F.lit(1), "copies")))
    out = materialize(rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")), "token-counts")
    discard(vocab)
    discard(often)
    return out
