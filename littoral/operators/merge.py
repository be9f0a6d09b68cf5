"""Union of what each host was given, and the merge into the host.

``contract`` mode unites all polygons of a group's union with the host; ``compat``
only the largest of them, and the others stand beside the host. The host stays
the polygon that it lies in itself; what else comes out is extra rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import scratch
from ..functions.geo import envelope
from ..kernel import st

MODES = ("contract", "compat")


def once(column: Column) -> Column:
    """``column``, computed once a row; filters on it would otherwise compute it again."""
    return F.explode(F.array(column))


def unions(grouped: DataFrame) -> DataFrame:
    """``wid, united``: the polygons of the union of each group, largest first; empty unions are left out."""
    return grouped.select("wid", once(st("st_union_all", "pieces")).alias("united")).filter(F.size("united") > 0)


def patches(united: DataFrame) -> DataFrame:
    """``wid, piece, geom``: a row for each polygon of each union."""
    return united.select("wid", F.posexplode("united").alias("piece", "geom"))


def merged(united: DataFrame, water: DataFrame, mode: str = "contract") -> DataFrame:
    """``wid, geom, extras`` of each host with a union."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    met = united.join(water.select("wid", F.col("geom").alias("host")), "wid")
    parts = met.select("wid", once(st("st_merge", "host", "united", F.lit(mode == "compat"))).alias("parts"))
    return parts.select("wid", F.element_at("parts", 1).alias("geom"), F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))).alias("extras"))


def extras(done: DataFrame) -> DataFrame:
    return done.select("wid", F.posexplode("extras").alias("piece", "geom"))


def replaced(water: DataFrame, done: DataFrame) -> DataFrame:
    """``water`` with the new geometry of the hosts that have one."""
    new = done.select("wid", F.col("geom").alias("new_geom"))
    return water.join(new, "wid", "left").withColumn("geom", F.coalesce("new_geom", "geom")).drop("new_geom")


def append_fids(rows: DataFrame, order: list[str], start: int) -> DataFrame:
    """``fid`` for each row: ``start`` and on, in the order of the columns.

    Rows are sorted in ranges; each range counts on from the sum of those before
    it, so no single task sees all rows. The sorted rows are written first, as
    ranges drawn twice could differ.
    """
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = scratch.materialize(spread.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")), "fids")
    sums = placed.groupBy("_part").agg(F.count("*").alias("n"))
    before = sums.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    return placed.join(before, "_part").withColumn("fid", F.lit(start) + F.col("_base") + F.col("_at")).drop("_part", "_at", "_base")


def with_envelope(df: DataFrame) -> DataFrame:
    return df.select("*", *envelope("geom"))
