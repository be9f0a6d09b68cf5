"""What the text operators share: row batches, byte helpers, and the tables of ``scratch``."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import discard, materialize, path, release

__all__ = ["NULL_ID", "as_bytes", "as_texts", "discard", "documents", "map_batches", "materialize", "once_each", "path", "read_table", "release", "text_key"]


def documents(df: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that other columns, whatever their names, stay out of the way."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


#: Stands for a null ``doc_id`` in keys: larger than all others.
NULL_ID = (1 << 63) - 1


def text_key(text: str) -> Column:
    """A hash of a text, null as empty: with ``doc_id`` it finds the rows of a document again in another scan.

    Numbers given to rows by a scan would not do: a scan can be split in another
    way after executors are lost.
    """
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def once_each(keyed: DataFrame, hits: DataFrame) -> DataFrame:
    """``doc, k, text, found`` of each key of ``hits`` (doc, k, copies, found), however many rows (``copies``) it has."""
    one = keyed.join(hits.filter("copies = 1"), ["doc", "k"]).select("doc", "k", "text", "found")
    several = keyed.join(hits.filter("copies > 1"), ["doc", "k"]).groupBy("doc", "k").agg(F.min("text").alias("text"), F.first("found").alias("found"))
    return one.unionByName(several)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; nulls are empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | list[pa.RecordBatch] | None]], schema: str) -> DataFrame:
    """``mapInArrow`` with state per task: ``make()`` runs once a task and returns the function for its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            if batch.num_rows:
                out = each(batch)
                if out is not None:
                    yield from out if isinstance(out, list) else [out]

    return df.mapInArrow(run, schema)
