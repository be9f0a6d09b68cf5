"""Views for checking a result: viewports, GeoJSON, differences and their clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import scratch
from ..functions.geo import ENVELOPE, KM_PER_DEGREE, LEAST_COS, envelope, feature_json
from ..kernel import st
from . import merge
from .spatial_join import cell_size, grid_join

MOST_FEATURES = 5000
DIVISOR = 4000
#: Of the difference atlas: kilometres between neighbours, and the least area of a cluster.
BUFFER_KM, LEAST_KM2 = 5.0, 0.1


def parse_bbox(text: str) -> tuple[float, float, float, float]:
    parts = text.split(",")
    if len(parts) != 4:
        raise ValueError("a box is four numbers")
    return tuple(map(float, parts))


def bounds(layer: DataFrame) -> DataFrame:
    return layer.agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def viewport(layer: DataFrame, box: Sequence[float], limit: int | None = MOST_FEATURES, exact: bool = True, fid: str = "fid") -> DataFrame:
    """Rows that meet the box, the first by id. The envelope comparisons reach the scan; geometry decides what is left."""
    x0, y0, x1, y1 = box
    near = layer.filter((F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0))
    if exact:
        near = near.filter(st("st_intersects", "geom", st("st_box", *(F.lit(float(v)) for v in box))))
    return near.orderBy(fid).limit(limit) if limit is not None else near.orderBy(fid)


def simplified(rows: DataFrame, box: Sequence[float], divisor: float = DIVISOR) -> DataFrame:
    """Geometry as coarse as the viewport allows; a divisor of zero leaves it."""
    if not divisor > 0:
        return rows
    tolerance = max(box[2] - box[0], box[3] - box[1]) / divisor
    return rows.withColumn("geom", st("st_simplify", "geom", F.lit(float(tolerance))))


def features(rows: DataFrame, fields: Sequence[str] = (), color: bool = False, fid: str = "fid") -> DataFrame:
    return rows.select(F.col(fid), feature_json(fid, "geom", fields, color).alias("feature"))


def collection(rows: DataFrame, fid: str = "fid") -> str:
    """A FeatureCollection of a viewport's (limited) rows."""
    parts = [r.feature for r in rows.orderBy(fid).collect()]
    return '{"type":"FeatureCollection","features":[' + ",".join(parts) + "]}"


def modified(revised: DataFrame, reference: DataFrame) -> DataFrame:
    """``fid, geom`` of what each changed row has gained."""
    met = revised.select("fid", F.col("geom").alias("after")).join(reference.select("fid", F.col("geom").alias("before")), "fid").filter(F.col("after") != F.col("before"))
    return met.select("fid", F.explode(st("st_difference", "after", "before")).alias("geom"))


def added(revised: DataFrame, reference: DataFrame) -> DataFrame:
    return revised.join(reference.select("fid"), "fid", "left_anti")


def deltas(revised: DataFrame, reference: DataFrame, box: Sequence[float] | None = None) -> DataFrame:
    """``did, fid, x0..y1, area_km2`` of every polygon that rows gained and of every new row, numbered by row and place.

    With a box, only revised rows whose envelope meets it are paired; a
    reference row counts wherever it lies, so that moved rows are not new ones.
    """
    if box is not None:
        x0, y0, x1, y1 = box
        revised = revised.filter((F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0))
    gained = modified(revised, reference).unionByName(added(revised, reference).select("fid", "geom"))
    sized = gained.select("fid", *envelope("geom"), st("st_area", "geom").alias("area"))
    return merge.append_fids(sized.withColumnRenamed("fid", "of"), ["of", *ENVELOPE], 0).select(F.col("fid").alias("did"), F.col("of").alias("fid"), *ENVELOPE, km2().alias("area_km2"))


def widened(km: float = BUFFER_KM):
    """Degrees east and north by which an envelope grows, so that two that lie within ``km`` meet: half of it each."""
    north = km / 2 / KM_PER_DEGREE
    return F.lit(north) / F.greatest(F.lit(LEAST_COS), F.cos(F.radians((F.col("y0") + F.col("y1")) / 2))), F.lit(north)


def km2(area: str = "area", y0: str = "y0", y1: str = "y1"):
    """Square degrees as square kilometres at the middle latitude."""
    return F.col(area) * KM_PER_DEGREE**2 * F.greatest(F.lit(LEAST_COS), F.cos(F.radians((F.col(y0) + F.col(y1)) / 2)))


def clusters(deltas: DataFrame, widen_x, widen_y, cell: float | None = None, key: str = "did") -> DataFrame:
    """``did, cluster``: deltas whose widened envelopes meet are one cluster, named by its smallest id.

    Labels spread to neighbours and jump along themselves, each round a join
    written to the shared folder, until none changes.
    """
    wide = scratch.materialize(deltas.select(F.col(key).alias("did"), (F.col("x0") - widen_x).alias("x0"), (F.col("y0") - widen_y).alias("y0"), (F.col("x1") + widen_x).alias("x1"), (F.col("y1") + widen_y).alias("y1")), "wide")
    other = wide.select(F.col("did").alias("oid"), *(F.col(c).alias(f"o_{c}") for c in ENVELOPE))
    pairs = grid_join(wide, other, cell or cell_size(wide), ENVELOPE, [f"o_{c}" for c in ENVELOPE])
    edges = scratch.materialize(pairs.filter("did != oid").select("did", "oid"), "neighbours")
    labels = scratch.materialize(wide.select("did", F.col("did").alias("cluster")), "labels")
    while True:
        near = edges.join(labels.select(F.col("did").alias("oid"), F.col("cluster").alias("c")), "oid").groupBy("did").agg(F.min("c").alias("c"))
        spread = labels.join(near, "did", "left").select("did", F.col("cluster").alias("old"), F.least("cluster", F.coalesce("c", "cluster")).alias("mid"))
        jump = labels.select(F.col("did").alias("mid"), F.col("cluster").alias("far"))
        fresh = scratch.materialize(spread.join(jump, "mid").select("did", "old", F.least("mid", "far").alias("cluster")), "labels")
        moved = fresh.filter("old != cluster").limit(1).count()
        scratch.discard(labels)
        labels = fresh.select("did", "cluster")
        if not moved:
            return labels


def atlas(deltas: DataFrame, labels: DataFrame, least_km2: float = LEAST_KM2, most: int | None = None) -> DataFrame:
    """``cluster, center_x, center_y, added_km2, fids`` of each cluster of enough area, largest first."""
    by = deltas.join(labels, "did").groupBy("cluster").agg(
        F.sum("area_km2").alias("added_km2"), ((F.min("x0") + F.max("x1")) / 2).alias("center_x"), ((F.min("y0") + F.max("y1")) / 2).alias("center_y"), F.array_join(F.array_sort(F.collect_set("fid")), " ").alias("fids")
    )
    out = by.filter(F.col("added_km2") >= least_km2).orderBy(F.desc("added_km2"), "cluster")
    return out.limit(most) if most is not None else out
