"""Rectangles, features and refresh states derived from the driver's tables, as SQL that Spark and DuckDB both run.

Coordinates are whole numbers in hundredths of a degree, so predicates and areas are exact in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import st

WATER = {
    "wid": "p_partkey",
    "x0": "(p_partkey*7919)%9000-4500",
    "y0": "(p_partkey*10473)%4000-2000",
    "x1": "(p_partkey*7919)%9000-4500 + 20 + p_size*4",
    "y1": "(p_partkey*10473)%4000-2000 + 20 + (p_partkey%7)*10",
}
AREA = {
    "aid": "c_custkey",
    "rid": "c_nationkey",
    "x0": "(c_custkey*6271)%9000-4500",
    "y0": "(c_custkey*15013)%4000-2000",
    "x1": "(c_custkey*6271)%9000-4500 + case when c_custkey%3=0 then 5 else 60+(c_custkey%11)*30 end",
    "y1": "(c_custkey*15013)%4000-2000 + case when c_custkey%3=0 then 5 else 40+(c_custkey%5)*25 end",
}
FEATURES = {
    "oid": "o_orderkey",
    "otype": "case o_orderkey%3 when 0 then 'n' when 1 then 'w' else 'r' end",
    "nat": "case o_custkey%6 when 0 then 'water' when 1 then 'shoal' when 2 then 'waterway' when 3 then 'wood' when 4 then 'beach' end",
    "waterway": "case when o_orderkey%13=0 then 'riverbank' end",
    "water": "case o_orderkey%8 when 0 then 'stream' when 1 then 'canal' when 2 then 'ditch' when 3 then 'drain' when 4 then 'lake' when 5 then 'river' when 6 then 'lagoon' end",
}


def sql(columns: dict[str, str], table: str) -> str:
    whole = {"wid", "aid", "rid", "oid", "x0", "y0", "x1", "y1"}
    return "select " + ", ".join(f"cast({e} as bigint) {c}" if c in whole else f"{e} {c}" for c, e in columns.items()) + f" from {table}"


WATER_SQL, AREA_SQL, FEATURES_SQL = sql(WATER, "part"), sql(AREA, "customer"), sql(FEATURES, "orders")


def _derived(spark: SparkSession, sf_dir: str, table: str, columns: dict[str, str]) -> DataFrame:
    whole = {"wid", "aid", "rid", "oid", "x0", "y0", "x1", "y1"}
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*(F.expr(e).cast("bigint").alias(c) if c in whole else F.expr(e).alias(c) for c, e in columns.items()))


def water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "part", WATER)


def area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "customer", AREA)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "orders", FEATURES)


def with_geom(df: DataFrame) -> DataFrame:
    """The rectangle as WKB beside its envelope."""
    return df.select("*", st("st_box", *(F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))).alias("geom"))
