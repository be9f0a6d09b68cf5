"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or an own folder where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="littoral-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def path(spark: SparkSession, name: str) -> str:
    return f"{root(spark)}/littoral/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, and lost executors lose nothing.

    With ``by``, filters on these columns read their own files alone.
    """
    spark = df.sparkSession
    target = path(spark, name)
    df.write.partitionBy(*by).parquet(target) if by else df.write.parquet(target)
    out = spark.read.schema(df.schema).parquet(target)
    out._scratch = target
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote and that nothing reads any more."""
    target = getattr(df, "_scratch", None)
    if target:
        context = df.sparkSession.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(target)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished steps now rather than at its next garbage collection.

    Its cleaner works beside the collector, so the first round finds what the second one frees.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)
