"""Regions merged into the hosts, each after the ones before it.

Candidates are found once, from the hosts' original envelopes; the exact
predicates of each region see the hosts as the regions before left them. What a
region adds beside a host is no host for later ones.

A polygon is offered to its candidates by their ids upwards and goes on where it is
refused, so what a host is given depends on hosts of smaller ids alone. All hosts
go through their regions at once, each in one row (``st_evolve``), with what is
offered to it so far; then hosts whose offers changed go through them again, until
no polygon moves. Rounds are as many as the longest way of a polygon that another
one waits for. Where a cap clips what is given, where offers of a host would
overfill a row, and where a cell has too many rows, regions are followed instead:

Only regions that meet at a host have to wait for each other. Each polygon gets a
level: one more than the last level at which any of its candidate hosts takes
something from an earlier region; a host takes what a region gives it once all of
that region's candidates for it are decided. Levels are worked off one after the
other, whatever regions they hold, so the number of rounds is the longest chain
of regions around one place, not the number of regions. Along the levels go, in
the shared folder, what is given but not yet due, and changed hosts that a later
level still asks for; a level reads its own pairs and the hosts in them.

Where a host meets about as many polygons as half the regions or more, levels
would be nearly as many as regions, and the pairs more than need be formed. There
regions follow one by one, and each finds the first host of its polygons without
all candidates (``overlap.first_exact``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import scratch
from ..functions.geo import ENVELOPE
from ..kernel import register, st
from ..operators import merge, overlap
from ..operators.spatial_join import Extent, expected, extent


#: So many candidates of each polygon are looked up at first; all of them where it is refused by these.
FIRST = 16
#: Offers are dealt to tasks of about so many polygons each.
DEALT = 50_000


@dataclass
class Folded:
    """``water``: wid, geom of all hosts; ``extras``, ``patches``: ord, wid, piece, geom; ``metrics``: a row for each region."""

    water: DataFrame
    extras: DataFrame
    patches: DataFrame
    metrics: DataFrame

    def output(self) -> DataFrame:
        """``fid, geom``: hosts by their id, then extras by region, host and piece, numbered on."""
        first = self.water.select(F.lit(0).alias("beside"), F.lit(0).cast("bigint").alias("ord"), "wid", F.lit(0).alias("piece"), "geom")
        more = self.extras.select(F.lit(1).alias("beside"), F.col("ord").cast("bigint").alias("ord"), "wid", "piece", "geom")
        return merge.append_fids(first.unionByName(more), ["beside", "ord", "wid", "piece"], 0).select("fid", "geom")


def levels(pairs: DataFrame) -> DataFrame:
    """``aid, level`` of each polygon with candidates (``aid, rid, wid``)."""
    now = scratch.materialize(pairs.select("aid").distinct().withColumn("level", F.lit(1)), "levels")
    earlier = Window.partitionBy("wid").orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as regions
    while True:
        events = pairs.join(now, "aid").groupBy("wid", "rid").agg(F.max("level").alias("level"))
        after = events.select("wid", "rid", F.coalesce(F.max("level").over(earlier), F.lit(0)).alias("last"))
        fresh = pairs.join(after, ["wid", "rid"]).groupBy("aid").agg((F.max("last") + 1).alias("fresh"))
        following = scratch.materialize(now.join(fresh, "aid").select("aid", F.col("level").alias("old"), F.col("fresh").alias("level")), "levels")
        moved = following.filter("old != level").limit(1).count()
        scratch.discard(now)
        now = following.select("aid", "level")
        if not moved:
            return now
        now._scratch = following._scratch


def fold(water: DataFrame, area: DataFrame, km: float | None = None, mode: str = "contract", cell: float | None = None) -> Folded:
    """``water``: wid, geom, x0..y1; ``area``: aid, rid, geom, x0..y1. Regions follow in the order of ``rid`` (a number)."""
    spark = water.sparkSession
    km = overlap.check_km(km)
    of_area, of_water = extent(area), extent(water)
    regions = area.agg(F.count_distinct("rid")).first()[0]
    if regions > 1 and km is None:
        done = _by_host(water, area, mode, cell, (of_area, of_water))
        if done is not None:
            return done
    if regions == 1 or 0 < regions * of_water.n <= 2 * expected(of_area, of_water):
        return _by_region(water, area, km, mode, cell, (of_area, of_water))
    found = scratch.materialize(overlap.candidates(water, area, cell), "candidates")
    pairs = scratch.materialize(found.join(levels(found.select("aid", "rid", "wid")), "aid"), "pairs", ("level",))
    # A host's last polygon of a region is decided at the level of the event, so each event has pairs of its own level.
    events = scratch.materialize(pairs.groupBy("wid", "rid").agg(F.max("level").alias("level")), "events", ("level",))
    lasts = scratch.materialize(events.groupBy("wid").agg(F.max("level").alias("last")), "lasts")
    last = lasts.agg(F.max("last")).first()[0] or 0
    carried = spark.createDataFrame([], "wid bigint, geom binary")
    waiting = spark.createDataFrame([], "aid bigint, rid bigint, wid bigint, piece binary")
    merged, united = [], []
    for level in range(1, last + 1):
        own = pairs.filter(F.col("level") == level).drop("level")
        hosts = water.join(own.select("wid").distinct(), "wid", "left_semi").select("wid", "geom")
        now = hosts.join(carried.select("wid", F.col("geom").alias("new")), "wid", "left").select("wid", F.coalesce("new", "geom").alias("geom"))
        taken = scratch.materialize(overlap.takes(own, now, area), "taken")
        best = taken.join(overlap.first_match(taken), ["aid", "wid"])
        rid = best.select("aid", "rid")
        fresh = overlap.pieces(best, km).join(rid, "aid").select("aid", "rid", "wid", "piece")
        ends = events.filter(F.col("level") == level).select("wid", "rid", F.lit(True).alias("ends"))
        given = waiting.unionByName(fresh).join(ends, ["wid", "rid"], "left")
        given = scratch.materialize(given.select("aid", "rid", "wid", "piece", F.coalesce("ends", F.lit(False)).alias("ends")), "given", ("ends",))
        due = given.filter("ends").drop("ends")
        # At one level a host takes from one region alone.
        of_host = due.groupBy("wid").agg(F.first("rid").alias("rid"))
        unions = scratch.materialize(merge.unions(overlap.groups(due)).join(of_host, "wid"), "united")
        done = scratch.materialize(merge.merged(unions, now, mode).join(of_host.select("wid", "rid"), "wid").withColumn("level", F.lit(level)), "merged")
        united.append(unions)
        merged.append(done)
        asked = lasts.filter(F.col("last") > level).select("wid")
        open_hosts = carried.join(done, "wid", "left_anti").unionByName(done.select("wid", "geom")).join(asked, "wid", "left_semi")
        before, carried = carried, scratch.materialize(open_hosts, "carried")
        scratch.discard(before)
        scratch.discard(taken)
        previous, waiting = waiting, given.filter("not ends").drop("ends")
        scratch.discard(previous)
        waiting._scratch = given._scratch
    return _folded(water, area, merged, united)


def _by_host(water: DataFrame, area: DataFrame, mode: str, cell: float | None, extents: tuple[Extent, Extent]) -> Folded | None:
    """The fold with a round for each move of polygons to their next hosts; None where a row would hold too much."""
    if mode not in merge.MODES:
        raise ValueError(f"mode is one of {merge.MODES}")
    register(water.sparkSession)
    cell = cell or max(overlap.cell_size(water), overlap.cell_size(area))
    tasks = water.sparkSession.sparkContext.defaultParallelism
    hosts = scratch.materialize(overlap.boxed(water.select("wid", *ENVELOPE, "geom")).repartition(tasks, "wid"), "hosts")
    areas = scratch.materialize(area.filter(F.col("rid").isNotNull()).select("aid", F.col("rid").cast("bigint").alias("rid"), *ENVELOPE, "geom").repartition(tasks, "aid"), "areas")
    found = overlap.first_hosts(hosts, areas, cell, FIRST, extents)
    if found is None:
        return None
    wids, asked, before = F.col("wids"), F.col("asked"), F.col("before")
    dealt = max(2 * tasks, min(20_000, extents[0].n // DEALT))  # few bytes may be much work: not by their size
    start = found.join(areas.select("aid", "rid"), "aid").select("aid", "rid", "wids", (F.size("wids") < FIRST).alias("all"), F.lit(1).alias("asked"), F.lit(0).alias("before"))
    now, results = scratch.materialize(start, "offers"), []
    if _heaviest(now, areas) > overlap.CHUNK:
        return None
    while True:
        changed = now.filter(asked != before).select(F.explode(F.slice(wids, F.least(asked, before) + 1, F.abs(asked - before))).alias("wid")).distinct()
        offers = now.select("aid", "rid", F.explode(F.slice(wids, F.lit(1), asked)).alias("wid")).join(changed, "wid", "left_semi")
        rows = offers.join(areas.select("aid", "geom"), "aid").groupBy("wid").agg(F.sort_array(F.collect_list(F.struct("rid", "aid", "geom"))).alias("offered"))
        each = hosts.select("wid", "geom").join(changed, "wid", "left_semi").join(rows, "wid", "left").repartition(dealt, "wid")
        each = each.select("wid", F.col("offered.aid").alias("aids"), st("st_evolve", "geom", "offered", F.lit(mode == "compat")).alias("done"))
        done = scratch.materialize(each.select("wid", "aids", "done.taken", "done.steps", F.lit(len(results)).alias("round")), "evolved")
        results.append(done)
        told = done.select("wid", F.explode(F.arrays_zip("aids", "taken")).alias("x")).select(F.col("x.aids").alias("aid"), "wid", F.col("x.taken").alias("taken"))
        place = F.array_position("wids", F.col("wid"))
        moves = told.join(now.select("aid", "wids", "asked"), "aid").groupBy("aid").agg(F.min(F.when(F.col("taken"), place)).alias("own"), F.max(~F.col("taken") & (place == asked)).alias("refused"))
        goes = F.coalesce("own", F.when(F.col("refused"), asked + 1), asked).cast("int")
        following = now.drop("before").join(moves, "aid", "left").select("aid", "rid", "wids", "all", goes.alias("asked"), asked.alias("before"))
        following = scratch.materialize(following, "offers")
        short = (asked > F.size("wids")) & ~F.col("all")
        moved, more = following.agg(F.count_if(asked != before), F.count_if(short)).first()
        scratch.discard(now)
        now = following
        if more:
            left = areas.join(now.filter(short).select("aid"), "aid", "left_semi")
            pairs = overlap.candidates(hosts.filter("box"), left, cell).filter(overlap.box_takes()).unionByName(overlap.candidates(hosts.filter("not box"), left, cell))
            whole = pairs.groupBy("aid").agg(F.sort_array(F.collect_list("wid")).alias("every"))
            now = scratch.materialize(following.join(whole, "aid", "left").select("aid", "rid", F.coalesce("every", "wids").alias("wids"), (F.col("all") | F.col("every").isNotNull()).alias("all"), "asked", "before"), "offers")
            scratch.discard(following)
            if _heaviest(now, areas) > overlap.CHUNK:
                return None
        if not moved:
            break
    every = _union(results)
    latest = every.join(every.groupBy("wid").agg(F.max("round").alias("round")), ["wid", "round"], "left_semi")
    steps = latest.select("wid", F.posexplode("steps").alias("level", "x")).select("wid", "level", "x.rid", "x.united", "x.geom", "x.extras")
    steps = scratch.materialize(steps, "steps")
    return _folded(water, area, [steps.drop("united")], [steps.select("wid", "rid", "united")])


def _heaviest(offers: DataFrame, areas: DataFrame) -> int:
    """The most bytes of geometry that any host could be offered."""
    of_host = offers.select("aid", F.explode("wids").alias("wid")).join(areas.select("aid", F.length("geom").alias("size")), "aid").groupBy("wid").agg(F.sum("size").alias("size"))
    return of_host.agg(F.max("size")).first()[0] or 0


def _by_region(water: DataFrame, area: DataFrame, km: float | None, mode: str, cell: float | None, extents: tuple[Extent, Extent]) -> Folded:
    """The fold with a round for each region."""
    spark = water.sparkSession
    cell = cell or max(overlap.cell_size(water), overlap.cell_size(area))
    tasks = spark.sparkContext.defaultParallelism
    hosts = scratch.materialize(overlap.boxed(water.select("wid", *ENVELOPE, "geom")).repartition(tasks, "wid"), "hosts")
    areas = scratch.materialize(overlap.boxed(area.select("aid", "rid", *ENVELOPE, "geom")).filter(F.col("rid").isNotNull()), "areas", ("rid",))
    rids = sorted(r[0] for r in areas.select("rid").distinct().collect())  # no more than twice the polygons that a host meets
    of_area = replace(extents[0], n=max(1, extents[0].n // max(1, len(rids))))  # of one region about
    carried = spark.createDataFrame([], "wid bigint, geom binary")
    merged, united = [], []
    for level, rid in enumerate(rids, 1):
        own = areas.filter(F.col("rid") == rid)
        changed = carried.select("wid", F.col("geom").alias("new"))
        now = hosts.join(changed, "wid", "left").select("wid", *ENVELOPE, F.coalesce("new", "geom").alias("geom"), (F.col("box") & F.col("new").isNull()).alias("box"))
        best = overlap.first_exact(now, own, cell, (of_area, extents[1]))
        met = best.join(own.select("aid", *ENVELOPE, F.col("geom").alias("a_geom")), "aid")
        if km is not None:
            met = met.join(hosts.select("wid", *(F.col(c).alias(f"w_{c}") for c in ENVELOPE)), "wid")
        unions = scratch.materialize(merge.unions(overlap.groups(overlap.pieces(met, km))).withColumn("rid", F.lit(rid).cast("bigint")), "united")
        done = merge.merged(unions, now, mode).withColumns({"rid": F.lit(rid).cast("bigint"), "level": F.lit(level)})
        done = scratch.materialize(done, "merged")
        united.append(unions)
        merged.append(done)
        before, carried = carried, scratch.materialize(carried.join(done, "wid", "left_anti").unionByName(done.select("wid", "geom")), "carried")
        scratch.discard(before)
    return _folded(water, area, merged, united)


def _folded(water: DataFrame, area: DataFrame, merged: list[DataFrame], united: list[DataFrame]) -> Folded:
    spark = water.sparkSession
    counted = area.groupBy(F.col("rid").cast("bigint").alias("ord")).agg(F.count("*").alias("polygons"))
    if not merged:
        none = spark.createDataFrame([], "ord bigint, wid bigint, piece int, geom binary")
        zero = F.lit(0).cast("bigint")
        return Folded(water.select("wid", "geom"), none, none, counted.select("ord", "polygons", zero.alias("matched_hosts"), zero.alias("extras"), zero.alias("patches")))
    merged_all, united_all = _union(merged), _union(united)
    order = F.col("rid").cast("bigint").alias("ord")
    extras = merged_all.select(order, "wid", F.posexplode("extras").alias("piece", "geom"))
    patches = united_all.select(order, "wid", F.posexplode("united").alias("piece", "geom"))
    sums = merged_all.groupBy(order).agg(F.count("*").alias("matched_hosts"), F.sum(F.size("extras")).alias("extras"))
    logged = united_all.groupBy(order).agg(F.sum(F.size("united")).alias("patches"))
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("matched_hosts", "extras", "patches")]
    metrics = counted.join(sums, "ord", "left").join(logged, "ord", "left").select("ord", "polygons", *zeros)
    newest = merged_all.groupBy("wid").agg(F.max("level").alias("level"))
    changed = merged_all.join(newest, ["wid", "level"], "left_semi")
    return Folded(merge.replaced(water.select("wid", "geom"), changed).select("wid", "geom"), extras, patches, metrics)


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
