"""Hosts for regional polygons: candidates, first valid match, groups.

A polygon meets a host by its envelope first (a grid join of ids and envelopes
alone), then exactly: it must intersect the host and not lie within it. Of
several hosts the one of the smallest id takes it. Polygons without a host are
left out of the result; ``unmatched`` shows them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import scratch
from ..functions.geo import ENVELOPE, cap_box, clipped_pieces, covered_by
from ..kernel import register, st
from .spatial_join import Extent, cell_size, expected, extent, grid_join, grid_lists

#: Bytes of geometry of one host that meet in one row.
CHUNK = 32 << 20

#: Up to so many expected pairs, all hosts are looked at in one round; else the first round has about so many candidates a polygon, and each further one has so many times the hosts.
FEW, NEAR, GROW = 20_000_000, 8, 8

HOST_ENV = tuple(f"w_{c}" for c in ENVELOPE)


def _hosts(water: DataFrame) -> DataFrame:
    return water.select("wid", *(F.col(c).alias(f"w_{c}") for c in ENVELOPE))


def candidates(water: DataFrame, area: DataFrame, cell: float | None = None, keep: tuple[str, ...] = (), extents: tuple[Extent, Extent] | None = None) -> DataFrame:
    """``aid, rid, x0..y1, wid, w_x0..w_y1`` of each polygon and host whose envelopes meet (and columns of the polygon to ``keep``)."""
    size = cell or max(cell_size(water), cell_size(area))
    return grid_join(area.select("aid", "rid", *ENVELOPE, *keep), _hosts(water), size, ENVELOPE, HOST_ENV, **({"extents": extents} if extents else {}))


def box_takes() -> Column:
    """The exact predicate where all polygons are rectangles: meeting is known, containment is comparisons."""
    return ~covered_by(ENVELOPE, HOST_ENV)


def in_chunks(rows: DataFrame, weight: Column) -> DataFrame:
    """``rows`` with ``chunk``: rows of a host are dealt by ``aid`` to as many chunks (from 0) as hold about ``CHUNK`` bytes each; -1 where one is enough.

    Only hosts of more than one chunk are joined; there are at most as many of
    them as the whole has chunks, and Spark broadcasts them if they are few.
    """
    large = rows.groupBy("wid").agg(F.sum(weight).alias("bytes")).filter(F.col("bytes") > CHUNK).select("wid", F.ceil(F.col("bytes") / CHUNK).alias("chunks"))
    dealt = rows.join(large, "wid", "left").withColumn("chunk", F.when(F.col("chunks").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("aid"), F.col("chunks"))))
    return dealt.drop("chunks")


def takes(pairs: DataFrame, water: DataFrame, area: DataFrame) -> DataFrame:
    """The pairs whose host takes the polygon, with its ``a_geom``; geometry is joined to the ids only here.

    A host meets its candidates chunk by chunk: its geometry is joined to, and
    decoded and indexed once for, each chunk and not each pair.
    """
    sized = pairs.join(area.select("aid", F.length("geom").alias("size")), "aid")
    dealt = in_chunks(sized, F.col("size")).drop("size").join(area.select("aid", F.col("geom").alias("a_geom")), "aid")
    columns = [c for c in dealt.columns if c not in ("wid", "chunk")]
    chunks = dealt.groupBy("wid", "chunk").agg(F.collect_list(F.struct(*columns)).alias("members"))
    met = chunks.join(water.select("wid", F.col("geom").alias("w_geom")), "wid")
    told = met.select("wid", F.explode(F.arrays_zip("members", st("st_takes_each", "w_geom", F.col("members.a_geom")).alias("taken"))).alias("pair"))
    return told.filter("pair.taken").select(*(F.col(c) if c == "wid" else F.col(f"pair.members.{c}").alias(c) for c in (*pairs.columns, "a_geom")))


def first_match(pairs: DataFrame) -> DataFrame:
    """``aid, wid``: one host for each polygon."""
    return pairs.groupBy("aid").agg(F.min("wid").alias("wid"))


def _parts(water: DataFrame, of: Extent, of_water: Extent) -> list[DataFrame]:
    """Hosts by ranges of their ids upwards, each larger than the one before; all at once where few pairs are expected."""
    pairs = expected(of, of_water)
    share, shares = NEAR * of.n / max(pairs, 1.0), []
    while pairs > FEW and share < 1 / 2:
        shares.append(share)
        share *= GROW
    cuts = water.agg(F.percentile_approx("wid", shares)).first()[0] if shares else []
    wid = F.col("wid")
    above = [F.lit(True), *(F.coalesce(wid > c, F.lit(True)) for c in cuts)]
    return [water.filter(lo & hi) for lo, hi in zip(above, [*(wid <= c for c in cuts), F.lit(True)])]


def first_taken(water: DataFrame, area: DataFrame, cell: float | None, taken: Callable[[DataFrame], DataFrame], keep: tuple[str, ...] = (), extents: tuple[Extent, Extent] | None = None) -> DataFrame:
    """``aid, wid``: ``first_match`` of the candidates that ``taken`` leaves, without forming all of them.

    Hosts are looked at by their ids upwards, in a few rounds: a polygon that has
    its host meets no later one. Only polygons that no host takes meet all.
    """
    cell = cell or max(cell_size(water), cell_size(area))
    extents = extents or (extent(area), extent(water))
    parts = _parts(water, *extents)
    if len(parts) == 1:
        return first_match(taken(candidates(water, area, cell, keep, extents)))
    found = None
    for part in parts:
        left = area if found is None else unmatched(area, found)
        own = scratch.materialize(first_match(taken(candidates(part, left, cell, keep))), "first")
        found = own if found is None else found.unionByName(own)
    return first_match(found)


def first_hosts(water: DataFrame, area: DataFrame, cell: float, most: int, extents: tuple[Extent, Extent] | None = None) -> DataFrame | None:
    """``aid, wids``: the first candidates of each polygon, ``most`` of them at most, without rectangles (``box``) that cover its envelope; polygons without any are left out.

    Cell by cell the hosts are gone through by their ids upwards until a polygon has
    enough. None where a cell has so many rows that they should not meet in one row.
    """
    register(water.sparkSession)
    corners = lambda p="": [F.col(c).cast("double").alias(f"{p}{c}") for c in ENVELOPE]
    polygons, hosts = area.select("aid", *corners()).dropna(), water.select("wid", *corners("w_"), "box").dropna()
    cells = grid_lists(polygons, hosts, cell, FEW, ENVELOPE, HOST_ENV, extents)
    if cells is None:
        return None
    met = cells.select(F.col("left.aid").alias("aid"), st("st_first_hosts", "left", "right", F.lit(most)).alias("wids"))
    each = met.select(F.explode(F.arrays_zip("aid", "wids")).alias("x")).select("x.aid", "x.wids").filter(F.size("wids") > 0)
    if most == 1:
        return each.groupBy("aid").agg(F.min(F.col("wids")[0]).alias("wid")).select("aid", F.array("wid").alias("wids"))
    return each.groupBy("aid").agg(F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("wids")))), 1, most).alias("wids"))


def first_boxes(water: DataFrame, area: DataFrame, cell: float | None = None, extents: tuple[Extent, Extent] | None = None) -> DataFrame:
    """``aid, wid``: the first host that takes each polygon, where all are rectangles."""
    cell = cell or max(cell_size(water), cell_size(area))
    extents = extents or (extent(area), extent(water))
    if expected(*extents) > FEW:
        found = first_hosts(water.withColumn("box", F.lit(True)), area, cell, 1, extents)
        if found is not None:
            return scratch.materialize(found.select("aid", F.col("wids")[0].alias("wid")), "first")
    return first_taken(water, area, cell, lambda pairs: pairs.filter(box_takes()), (), extents)


def boxed(df: DataFrame) -> DataFrame:
    """``df`` with ``box``: its geometry is its envelope itself, so that comparisons are the exact predicates among such rows."""
    return df.withColumn("box", F.coalesce(st("st_is_box", "geom", *(F.col(c).cast("double") for c in ENVELOPE)), F.lit(False)))


def exact_pairs(water: DataFrame, area: DataFrame, cell: float | None = None) -> DataFrame:
    """``aid, rid, x0..y1, wid, w_x0..w_y1`` where the host takes the polygon. Both have ``geom`` and ``box``; geometry moves only for pairs that are not two rectangles."""
    cell = cell or max(cell_size(water), cell_size(area))
    out = candidates(water.filter("box"), area.filter("box"), cell).filter(box_takes())
    for hosts, polygons in ((water.filter("not box"), area), (water.filter("box"), area.filter("not box"))):
        if not hosts.isEmpty() and not polygons.isEmpty():
            pairs = scratch.materialize(candidates(hosts, polygons, cell), "candidates")
            out = out.unionByName(takes(pairs, hosts, polygons).select(*out.columns))
    return out


def first_exact(water: DataFrame, area: DataFrame, cell: float | None = None, extents: tuple[Extent, Extent] | None = None) -> DataFrame:
    """``aid, wid``: the first host that takes each polygon, by the exact predicates. Both sides as in ``exact_pairs``; envelopes of ``water`` decide who is a candidate.

    The first among rectangles comes first; then other pairs are looked at that could come before it.
    """
    cell = cell or max(cell_size(water), cell_size(area))
    of_area, of_water = extents or (extent(area), extent(water))
    sure = first_boxes(water.filter("box"), area.filter("box"), cell, (of_area, of_water))
    sure = scratch.materialize(sure, "sure")
    out = sure
    for hosts, polygons in ((water.filter("not box"), area), (water.filter("box"), area.filter("not box"))):
        of = extent(hosts)
        if of.n and not polygons.isEmpty():
            known = polygons.join(sure.select("aid", F.col("wid").alias("below")), "aid", "left")

            def taken(pairs, hosts=hosts, polygons=polygons):
                pairs = scratch.materialize(pairs.filter("below is null or wid < below"), "open")
                return takes(pairs, hosts, polygons)

            out = out.unionByName(first_taken(hosts, known, cell, taken, ("below",), (of_area, of)))
        if area.filter("not box").isEmpty():
            break
    return out if out is sure else scratch.materialize(first_match(out), "first")


def unmatched(area: DataFrame, matched: DataFrame) -> DataFrame:
    return area.join(matched.select("aid"), "aid", "left_anti")


def cap_columns(km: float) -> list[Column]:
    """``cx0..cy1``: the host's envelope widened by ``km``."""
    return cap_box(km, *(F.col(c) for c in HOST_ENV))


def check_km(km: float | None) -> float | None:
    """None where there is no cap: unset, zero, or infinite. Negative numbers and NaN are errors."""
    if km is None or km == 0 or km == float("inf"):
        return None
    if not km > 0:
        raise ValueError("the distance is a positive number of kilometres")
    return km


def pieces(matched: DataFrame, km: float | None = None) -> DataFrame:
    """``aid, wid, piece`` for each polygon of each match, clipped to the cap of its host.

    ``matched`` has ``aid, wid, a_geom`` and both envelopes.
    """
    km = check_km(km)
    if km is None:
        return matched.select("aid", "wid", F.col("a_geom").alias("piece"))
    capped = matched.select("aid", "wid", "a_geom", *ENVELOPE, *cap_columns(km))
    return capped.select("aid", "wid", F.explode(clipped_pieces("a_geom", ENVELOPE, ("cx0", "cy0", "cx1", "cy1"))).alias("piece"))


def groups(found: DataFrame) -> DataFrame:
    """``wid, pieces``, in the order of ``aid``; pieces of a host with several chunks are united within each chunk first.

    So what meets in one row is a chunk of pieces, and then the chunks' unions,
    without the borders between pieces of a chunk.
    """
    ordered = lambda key, value: F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda x: x[value])
    chunks = in_chunks(found, F.length("piece")).groupBy("wid", "chunk").agg(ordered("aid", "piece").alias("pieces"))
    parts = chunks.select("wid", "chunk", F.when(F.col("chunk") >= 0, st("st_union_all", "pieces")).otherwise(F.col("pieces")).alias("pieces"))
    return parts.groupBy("wid").agg(F.flatten(ordered("chunk", "pieces")).alias("pieces"))
