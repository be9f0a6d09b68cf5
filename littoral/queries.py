"""The registered queries of the engine on rectangle fixtures, each with SQL that DuckDB checks it by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from . import scratch
from .functions import geo, osm
from .functions.geo import ENVELOPE
from .kernel import register, st
from .operators import merge, overlap, qa
from .plans import fold as folding
from .plans import refresh

#: Grid cells of the fixtures: about the 90th percentile of their sides.
CELL = 320
CAP_KM, CLIP_BY, VIEW, MOST, DIVISOR, WIDEN = 20, 50, (-1000, -500, 1000, 500), 50, 4000, 60
WINDOW, KM_APART = (-30.005, -15.005, 30.005, 15.005), 60.3
SELECTED = ("NATION_2", "NATION_3", "NATION_7", "NATION_11", "NATION_12", "NATION_23")


def _big(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, as the SQL has them."""
    return df.select(*(F.col(c).cast("bigint").alias(c) if t in ("int", "smallint") else F.col(c) for c, t in df.dtypes))


def scan_water_bounds(spark, d):
    return qa.bounds(fx.water(spark, d))


def filter_subtype(spark, d):
    return fx.features(spark, d).filter(osm.is_area_water())


def filter_osm_tags(spark, d):
    return fx.features(spark, d).filter(osm.is_water())


def water_features(spark, d):
    return osm.water_features(fx.features(spark, d))


def select_regions_ordered(spark, d):
    regions = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("bigint").alias("ord"), F.col("n_name").alias("region"))
    return osm.select_regions(regions, list(SELECTED))


def _candidates(spark, d):
    return overlap.candidates(fx.water(spark, d), fx.area(spark, d), CELL)


def envelope_candidates(spark, d):
    return _candidates(spark, d).select("aid", "rid", "wid")


def overlap_pairs(spark, d):
    return _candidates(spark, d).filter(overlap.box_takes()).select("aid", "rid", "wid")


def exact_pairs(spark, d):
    """The same pairs by the exact predicates over geometry."""
    register(spark)
    water, area = (overlap.boxed(fx.with_geom(side(spark, d))) for side in (fx.water, fx.area))
    return overlap.exact_pairs(water, area, CELL).select("aid", "rid", "wid")


def _matches(spark, d):
    return overlap.first_boxes(fx.water(spark, d), fx.area(spark, d), CELL)


def first_match(spark, d):
    return _matches(spark, d)


def unmatched_areas(spark, d):
    return overlap.unmatched(fx.area(spark, d), _matches(spark, d)).select("aid", "rid")


def overlap_groups(spark, d):
    return _matches(spark, d).groupBy("wid").agg(F.count("*").alias("n_areas"), F.sum("aid").alias("sum_aid"))


def cap_box(spark, d):
    env = [F.col(c) / 100.0 for c in ENVELOPE]
    box = geo.cap_box(CAP_KM, *env)
    return fx.water(spark, d).select("wid", *box).select("wid", *(F.round(F.col(f"c{c}") * 1000).cast("bigint").alias(f"milli_{c}") for c in ENVELOPE))


def _matched(spark, d):
    """Matches with both envelopes and the area's geometry."""
    water, area = fx.water(spark, d), fx.with_geom(fx.area(spark, d))
    best = _matches(spark, d).join(area.withColumnRenamed("geom", "a_geom"), "aid")
    return best.join(water.select("wid", *(F.col(c).alias(f"w_{c}") for c in ENVELOPE)), "wid")


def cap_clip(spark, d):
    register(spark)
    wide = [(F.col(f"w_{c}") + (-CLIP_BY if c[1] == "0" else CLIP_BY)).cast("double").alias(f"c{c}") for c in ENVELOPE]
    cap = [f"c{c}" for c in ENVELOPE]
    capped = _matched(spark, d).select("aid", "wid", "a_geom", *ENVELOPE, *wide)
    parts = capped.select("aid", "wid", geo.covered_by(ENVELOPE, cap).alias("whole"), F.explode(geo.clipped_pieces("a_geom", ENVELOPE, cap)).alias("piece"))
    return parts.select("aid", "wid", "whole", F.round(st("st_area", "piece")).cast("bigint").alias("area"))


def _united(spark, d):
    register(spark)
    return merge.unions(overlap.groups(overlap.pieces(_matched(spark, d))))


def _merged(spark, d):
    return merge.merged(_united(spark, d), fx.with_geom(fx.water(spark, d)))


def host_union_area(spark, d):
    parts = _merged(spark, d).select("wid", F.explode(F.concat(F.array("geom"), "extras")).alias("part"))
    return parts.groupBy("wid").agg(F.round(F.sum(st("st_area", "part"))).cast("bigint").alias("area"))


def delta_area(spark, d):
    before = fx.water(spark, d).select("wid", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("before"))
    return host_union_area(spark, d).join(before, "wid").select("wid", (F.col("area") - F.col("before")).alias("added"))


def append_fids(spark, d):
    """Matched areas numbered on after the hosts, in the order of region, host and polygon."""
    base = fx.water(spark, d).count()
    rows = _matches(spark, d).join(fx.area(spark, d).select("aid", "rid"), "aid")
    return merge.append_fids(rows, ["rid", "wid", "aid"], base).select("fid", "aid", "wid", "rid")


def _folded(spark, d):
    register(spark)
    return folding.fold(fx.with_geom(fx.water(spark, d)), fx.with_geom(fx.area(spark, d)), cell=CELL)


def fold_metrics(spark, d):
    return _folded(spark, d).metrics


def patches(spark, d):
    return _folded(spark, d).patches.select("ord", "wid", F.col("piece").cast("bigint").alias("piece"), F.round(st("st_area", "geom")).cast("bigint").alias("area"))


def merged_water(spark, d):
    return _folded(spark, d).output().select("fid", F.round(st("st_area", "geom")).cast("bigint").alias("area"))


def _one_region(spark, d):
    """The fold with all polygons as one region, which SQL can follow."""
    register(spark)
    area = fx.area(spark, d).withColumn("rid", F.lit(0).cast("bigint"))
    return folding.fold(fx.with_geom(fx.water(spark, d)), fx.with_geom(area), cell=CELL)


def fold_one_region(spark, d):
    """What becomes of each host: its own polygon and what stands beside it."""
    done = _one_region(spark, d)
    parts = done.water.select("wid", "geom").unionByName(done.extras.select("wid", "geom"))
    return parts.groupBy("wid").agg(F.round(F.sum(st("st_area", "geom"))).cast("bigint").alias("area"))


def fold_one_region_patches(spark, d):
    return _one_region(spark, d).patches.groupBy("wid").agg(F.round(F.sum(st("st_area", "geom"))).cast("bigint").alias("area"))


def fold_one_region_output(spark, d):
    """Rows are numbered without gaps, and the first are the hosts."""
    done = _one_region(spark, d)
    whole = done.output().agg(F.count("*").alias("n"), F.count_distinct("fid").alias("fids"), F.min("fid").alias("least"), F.max("fid").alias("most"), F.round(F.sum(st("st_area", "geom"))).cast("bigint").alias("area"))
    beside = done.extras.agg(F.count("*").alias("beside"))
    metrics = done.metrics.select("polygons", "matched_hosts")
    return whole.crossJoin(beside).select((F.col("n") - F.col("beside")).alias("hosts"), (F.col("n") - F.col("fids")).alias("twice"), "least", (F.col("most") - F.col("n")).alias("gap"), "area").crossJoin(metrics)


def patch_area(spark, d):
    """The union of each host's areas alone."""
    parts = merge.patches(_united(spark, d))
    return parts.groupBy("wid").agg(F.round(F.sum(st("st_area", "geom"))).cast("bigint").alias("area"))


def _states(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").select(F.col("user_id").alias("key"), "ts", "event_id", "event_type")
    last = lambda df, p: df.groupBy("key").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("m")).select("key", F.col("m.event_type").alias(f"{p}_etag"), F.to_date("m.ts").cast("string").alias(f"{p}_lm"))
    met = last(events, "r").join(last(events.filter(F.col("ts") < "2024-01-16"), "m"), "key", "left")
    k = F.col("key")
    return met.select("*", (k % 37 == 0).alias("force"), (k % 11 != 0).alias("head_ok"), (k % 5 != 0).alias("have_shp"), (k % 3 != 0).alias("have_pbf"), (k % 40).alias("shp_age_days"), F.lit(7).alias("min_age"))


def manifest_match(spark, d):
    return _states(spark, d).select("key", refresh.metadata_matches().alias("matches"))


def refresh_plan(spark, d):
    return _big(refresh.plan(_states(spark, d)).select("key", "rule", "needs_refresh", "records_metadata", "deletes_cache"))


def refresh_counts(spark, d):
    return refresh.counts(refresh.plan(_states(spark, d)))


def missing_inputs(spark, d):
    nation = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_name").alias("region"), "n_nationkey")
    return refresh.missing(nation.select("region"), nation.filter("n_nationkey % 3 != 0"))


def backoff_schedule(spark, d):
    nation = spark.read.parquet(f"{d}/nation.parquet").select((F.col("n_nationkey") + 1).cast("bigint").alias("attempt"))
    return nation.select("attempt", refresh.backoff(F.col("attempt")).cast("bigint").alias("seconds"))


def _layer(spark, d):
    return fx.with_geom(fx.water(spark, d).withColumnRenamed("wid", "fid"))


def viewport(spark, d):
    register(spark)
    return qa.viewport(_layer(spark, d), VIEW, MOST).select("fid", *ENVELOPE)


def simplify_tolerance(spark, d):
    t = geo.simplify_tolerance(*(F.col(c) for c in ENVELOPE), DIVISOR)
    return fx.water(spark, d).select("wid", F.round(t * 1_000_000).cast("bigint").alias("micro"))


def feature_color(spark, d):
    return fx.water(spark, d).select("wid", geo.hex_color(F.col("wid")).alias("color"))


def geojson_features(spark, d):
    register(spark)
    return qa.features(qa.simplified(qa.viewport(_layer(spark, d), VIEW, MOST), VIEW, DIVISOR), ENVELOPE, color=True)


def _revised(spark, d):
    water = fx.water(spark, d).withColumn("x1", F.col("x1") + F.when(F.col("wid") % 10 == 0, 30).otherwise(0))
    return fx.with_geom(water.withColumnRenamed("wid", "fid"))


def diff_modified(spark, d):
    register(spark)
    return qa.modified(_revised(spark, d), _layer(spark, d)).select("fid", F.round(st("st_area", "geom")).cast("bigint").alias("area"))


def diff_added(spark, d):
    base = fx.water(spark, d).agg(F.max("wid")).first()[0]
    more = fx.area(spark, d).filter("rid = 0").select((F.col("aid") + base).alias("fid"), *ENVELOPE)
    revised = fx.water(spark, d).withColumnRenamed("wid", "fid").unionByName(more)
    return qa.added(revised, fx.water(spark, d).withColumnRenamed("wid", "fid")).select("fid", *ENVELOPE)


def _deltas(spark, d):
    changed = fx.water(spark, d).filter("wid % 10 = 0").select(F.col("wid").alias("did"), F.col("x1").alias("x0"), "y0", (F.col("x1") + 30).alias("x1"), "y1")
    return changed.withColumn("area", (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))


def diff_clusters(spark, d):
    deltas = _deltas(spark, d)
    return deltas.join(qa.clusters(deltas, WIDEN, WIDEN, CELL), "did").groupBy("cluster").agg(F.count("*").alias("n"), F.sum("area").alias("area"))


def diff_atlas(spark, d):
    deltas = _deltas(spark, d).withColumns({"fid": F.col("did"), "area_km2": F.col("area").cast("double")})
    out = qa.atlas(deltas, qa.clusters(deltas, WIDEN, WIDEN, CELL), 1000.0, 20)
    return out.select("cluster", F.col("added_km2").cast("bigint").alias("added"), "fids")


def diff_atlas_km(spark, d):
    """Clusters of what a revised layer has gained within a window, by kilometres; the layers are in degrees."""
    register(spark)
    degrees = lambda df: fx.with_geom(df.select("fid", *((F.col(c) / 100.0).alias(c) for c in ENVELOPE)))
    base = fx.water(spark, d).withColumnRenamed("wid", "fid")
    grown = base.withColumn("x1", F.col("x1") + F.when(F.col("fid") % 10 == 0, 30).otherwise(0))
    found = scratch.materialize(qa.deltas(degrees(grown), degrees(base), WINDOW), "deltas")
    out = qa.atlas(found, qa.clusters(found, *qa.widened(KM_APART)))
    return out.select("fids", F.round(F.col("added_km2") * 1000).cast("bigint").alias("added"), F.round(F.col("center_x") * 1000).cast("bigint").alias("milli_x"), F.round(F.col("center_y") * 1000).cast("bigint").alias("milli_y"))


NAMES = (
    "scan_water_bounds filter_subtype filter_osm_tags water_features select_regions_ordered envelope_candidates overlap_pairs exact_pairs first_match unmatched_areas overlap_groups cap_box cap_clip host_union_area delta_area append_fids patch_area "
    "fold_metrics patches merged_water fold_one_region fold_one_region_patches fold_one_region_output manifest_match refresh_plan refresh_counts missing_inputs backoff_schedule viewport simplify_tolerance feature_color geojson_features diff_modified diff_added diff_clusters diff_atlas diff_atlas_km"
).split()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in NAMES}


# ---- SQL ----

_W, _A, _O = f"water as ({fx.WATER_SQL})", f"area as ({fx.AREA_SQL})", f"features as ({fx.FEATURES_SQL})"
_MEET = "a.x0 <= w.x1 and a.x1 >= w.x0 and a.y0 <= w.y1 and a.y1 >= w.y0"
_IN = "a.x0 >= w.x0 and a.x1 <= w.x1 and a.y0 >= w.y0 and a.y1 <= w.y1"
_CAND = f"cand as (select a.aid, a.rid, w.wid, ({_IN}) inside from area a join water w on {_MEET})"
_PAIRS = f"with {_W}, {_A}, {_CAND}, matched as (select aid, min(wid) wid from cand where not inside group by aid)"
_IS_WATER = "(otype = 'w' and nat in ('water','shoal')) or (otype = 'r' and nat in ('water','waterway','shoal')) or (otype in ('w','r') and waterway = 'riverbank')"
_IS_AREA = "water is null or water not in ('stream','canal','ditch','drain')"
_STATES = """with ranked as (select user_id key, event_type, cast(cast(ts as date) as varchar) lm, ts, row_number() over (partition by user_id order by ts desc, event_id desc) n from events),
 old as (select user_id key, event_type, cast(cast(ts as date) as varchar) lm, row_number() over (partition by user_id order by ts desc, event_id desc) n from events where ts < timestamp '2024-01-16'),
 states as (select r.key, r.event_type r_etag, r.lm r_lm, o.event_type m_etag, o.lm m_lm, r.key%37=0 force, r.key%11<>0 head_ok, r.key%5<>0 have_shp, r.key%3<>0 have_pbf, r.key%40 age,
  coalesce(r.event_type = o.event_type, false) or coalesce(r.lm = o.lm, false) same from (select * from ranked where n = 1) r left join (select * from old where n = 1) o using (key)),
 ruled as (select *, case when force then 1 when not head_ok then 2 when have_shp and same then 3 when have_shp and age < 7 then 4 when have_pbf and same and not have_shp then 5 else 6 end rule from states)"""


def _sweep(with_host: bool) -> str:
    """The area of unions of rectangles, by compressed coordinates."""
    host = "select wid, x0, y0, x1, y1 from water where wid in (select wid from matched) union all " if with_host else ""
    return f"""{_PAIRS}, b as ({host}select m.wid, a.x0, a.y0, a.x1, a.y1 from matched m join area a using (aid)),
 xs as (select wid, v l, lead(v) over (partition by wid order by v) r from (select wid, x0 v from b union select wid, x1 from b)),
 ys as (select wid, v l, lead(v) over (partition by wid order by v) r from (select wid, y0 v from b union select wid, y1 from b)),
 u as (select wid, cast(sum((xr-xl)*(yr-yl)) as bigint) area from (select distinct xs.wid, xs.l xl, xs.r xr, ys.l yl, ys.r yr from xs join ys on xs.wid = ys.wid
  join b on b.wid = xs.wid and b.x0 <= xs.l and b.x1 >= xs.r and b.y0 <= ys.l and b.y1 >= ys.r where xs.r is not null and ys.r is not null) group by wid)"""


def _color_sql() -> str:
    m2 = geo.LIGHTNESS + geo.SATURATION - geo.LIGHTNESS * geo.SATURATION
    m1 = 2 * geo.LIGHTNESS - m2
    part = lambda s: f"cast(floor(255 * (case when h{s} < 1.0/6 then {m1!r} + ({m2!r}-{m1!r})*h{s}*6.0 when h{s} < 0.5 then {m2!r} when h{s} < 2.0/3 then {m1!r} + ({m2!r}-{m1!r})*(2.0/3 - h{s})*6.0 else {m1!r} end)) as int)"
    turn = lambda s: f"(cast(wid%360 as double)/360.0 + {s}) - floor(cast(wid%360 as double)/360.0 + {s})"
    return f"with {_W}, hues as (select wid, {turn('cast(1 as double)/3')} h1, {turn('0')} h2, {turn('-(cast(1 as double)/3)')} h3 from water) select wid, printf('#%02x%02x%02x', {part(1)}, {part(2)}, {part(3)}) color from hues"


def _geojson_sql() -> str:
    """Rectangles keep their corners when simplified; the ring starts at the lower left one and goes up."""
    corner = lambda x, y: f"'[' || {x} || '.0,' || {y} || '.0]'"
    ring = " || ',' || ".join(corner(x, y) for x, y in (("x0", "y0"), ("x0", "y1"), ("x1", "y1"), ("x1", "y0"), ("x0", "y0")))
    own = " || ".join(f"',\"{c}\":' || {c}" for c in ENVELOPE)
    return f"""with colors as ({_color_sql()}), {_W}, seen as (select * from water where x0 <= {VIEW[2]} and x1 >= {VIEW[0]} and y0 <= {VIEW[3]} and y1 >= {VIEW[1]} order by wid limit {MOST})
 select wid fid, '{{"type":"Feature","id":' || wid || ',"geometry":{{"type":"Polygon","coordinates":[[' || {ring} || ']]}},"properties":{{"_fid":' || wid || {own} || ',"_color":"' || color || '"}}}}' feature from seen join colors using (wid)"""


def oracle_sql() -> dict[str, str]:
    cap = "greatest(0.01, cos(radians((y0+y1)/200.0)))"
    dlon, dlat = f"({CAP_KM}/(111.0*{cap}))", f"({CAP_KM}/111.0)"
    milli = lambda e: f"cast(round(({e})*1000) as bigint)"
    clusters = f"""with recursive {_W}, d as (select wid did, x1 x0, y0, x1+30 x1, y1 from water where wid%10 = 0),
 e as (select a.did, b.did oid from d a join d b on a.x0-{WIDEN} <= b.x1+{WIDEN} and a.x1+{WIDEN} >= b.x0-{WIDEN} and a.y0-{WIDEN} <= b.y1+{WIDEN} and a.y1+{WIDEN} >= b.y0-{WIDEN}),
 reach as (select did, did oid from d union select r.did, e.oid from reach r join e on e.did = r.oid),
 label as (select did, min(oid) cluster from reach group by did)"""
    wide = f"({KM_APART}/2.0/111.0)"
    km = f"""with recursive {_W}, d as (select wid did, x1/100.0 x0, y0/100.0 y0, (x1+30)/100.0 x1, y1/100.0 y1, greatest(0.01, cos(radians((y0+y1)/200.0))) c from water
  where wid%10 = 0 and x0/100.0 <= {WINDOW[2]} and (x1+30)/100.0 >= {WINDOW[0]} and y0/100.0 <= {WINDOW[3]} and y1/100.0 >= {WINDOW[1]}),
 e as (select a.did, b.did oid from d a join d b on a.x0-{wide}/a.c <= b.x1+{wide}/b.c and a.x1+{wide}/a.c >= b.x0-{wide}/b.c and a.y0-{wide} <= b.y1+{wide} and a.y1+{wide} >= b.y0-{wide}),
 reach as (select did, did oid from d union select r.did, e.oid from reach r join e on e.did = r.oid),
 label as (select did, min(oid) cluster from reach group by did)"""
    return {
        "diff_atlas_km": f"""{km} select array_to_string(list_sort(list(did)), ' ') fids, cast(round(sum((x1-x0)*(y1-y0)*111.0*111.0*c)*1000) as bigint) added,
 cast(round((min(x0)+max(x1))/2*1000) as bigint) milli_x, cast(round((min(y0)+max(y1))/2*1000) as bigint) milli_y from d join label using (did) group by cluster having sum((x1-x0)*(y1-y0)*111.0*111.0*c) >= {qa.LEAST_KM2}""",
        "scan_water_bounds": f"with {_W} select min(x0) x0, min(y0) y0, max(x1) x1, max(y1) y1 from water",
        "filter_subtype": f"with {_O} select * from features where {_IS_AREA}",
        "filter_osm_tags": f"with {_O} select * from features where {_IS_WATER}",
        "water_features": f"with {_O} select * from features where ({_IS_WATER}) and ({_IS_AREA})",
        "select_regions_ordered": f"select cast(n_nationkey as bigint) ord, n_name region from nation where n_name in {SELECTED} order by ord",
        "envelope_candidates": f"{_PAIRS} select aid, rid, wid from cand",
        "overlap_pairs": f"{_PAIRS} select aid, rid, wid from cand where not inside",
        "exact_pairs": f"{_PAIRS} select aid, rid, wid from cand where not inside",
        "first_match": f"{_PAIRS} select aid, wid from matched",
        "unmatched_areas": f"{_PAIRS} select aid, rid from area a where not exists (select 1 from matched m where m.aid = a.aid)",
        "overlap_groups": f"{_PAIRS} select wid, count(*) n_areas, cast(sum(aid) as bigint) sum_aid from matched group by wid",
        "cap_box": f"with {_W} select wid, {milli(f'x0/100.0 - {dlon}')} milli_x0, {milli(f'greatest(-90.0, y0/100.0 - {dlat})')} milli_y0, {milli(f'x1/100.0 + {dlon}')} milli_x1, {milli(f'least(90.0, y1/100.0 + {dlat})')} milli_y1 from water",
        "cap_clip": f"""{_PAIRS}, c as (select m.aid, m.wid, greatest(a.x0, w.x0-{CLIP_BY}) x0, greatest(a.y0, w.y0-{CLIP_BY}) y0, least(a.x1, w.x1+{CLIP_BY}) x1, least(a.y1, w.y1+{CLIP_BY}) y1,
 a.x0 >= w.x0-{CLIP_BY} and a.y0 >= w.y0-{CLIP_BY} and a.x1 <= w.x1+{CLIP_BY} and a.y1 <= w.y1+{CLIP_BY} whole from matched m join area a using (aid) join water w using (wid))
 select aid, wid, whole, (x1-x0)*(y1-y0) area from c where x0 < x1 and y0 < y1""",
        "host_union_area": f"{_sweep(True)} select wid, area from u",
        "patch_area": f"{_sweep(False)} select wid, area from u",
        "fold_one_region": f"{_sweep(True)} select wid, area from u union all select wid, (x1-x0)*(y1-y0) area from water where wid not in (select wid from matched)",
        "fold_one_region_patches": f"{_sweep(False)} select wid, area from u",
        "fold_one_region_output": f"""{_sweep(True)}, every as (select area from u union all select (x1-x0)*(y1-y0) area from water where wid not in (select wid from matched))
 select (select count(*) from water) hosts, cast(0 as bigint) twice, cast(0 as bigint) least, cast(-1 as bigint) gap, cast(sum(area) as bigint) area, (select count(*) from area) polygons, (select count(distinct wid) from matched) matched_hosts from every""",
        "delta_area": f"{_sweep(True)} select wid, u.area - (x1-x0)*(y1-y0) added from u join water using (wid)",
        "append_fids": f"{_PAIRS} select (select count(*) from water) + row_number() over (order by rid, wid, aid) - 1 fid, aid, wid, rid from matched join (select aid, rid from area) using (aid)",
        "manifest_match": f"{_STATES} select key, same matches from states",
        "refresh_plan": f"{_STATES} select key, cast(rule as bigint) rule, rule in (1,5,6) needs_refresh, rule in (3,5,6) or (rule = 1 and head_ok) records_metadata, rule in (1,6) deletes_cache from ruled",
        "refresh_counts": f"{_STATES} select count(*) filter (rule in (1,5,6)) to_refresh, count(*) filter (rule not in (1,5,6)) up_to_date from ruled",
        "missing_inputs": "select n_name region from nation where n_nationkey % 3 = 0",
        "backoff_schedule": "select cast(n_nationkey+1 as bigint) attempt, cast(least(5*pow(2, n_nationkey), 120) as bigint) as seconds from nation",
        "viewport": f"with {_W} select wid fid, x0, y0, x1, y1 from water where x0 <= {VIEW[2]} and x1 >= {VIEW[0]} and y0 <= {VIEW[3]} and y1 >= {VIEW[1]} order by wid limit {MOST}",
        "simplify_tolerance": f"with {_W} select wid, cast(round(greatest(x1-x0, y1-y0)/{DIVISOR}.0*1000000) as bigint) micro from water",
        "feature_color": _color_sql(),
        "geojson_features": _geojson_sql(),
        "diff_modified": f"with {_W} select wid fid, 30*(y1-y0) area from water where wid%10 = 0",
        "diff_added": f"with {_W}, {_A} select aid + (select max(wid) from water) fid, x0, y0, x1, y1 from area where rid = 0",
        "diff_clusters": f"{clusters} select cluster, count(*) n, cast(sum((x1-x0)*(y1-y0)) as bigint) area from d join label using (did) group by cluster",
        "diff_atlas": f"{clusters} select cluster, cast(sum((x1-x0)*(y1-y0)) as bigint) added, string_agg(cast(did as varchar), ' ' order by did) fids from d join label using (did) group by cluster having sum((x1-x0)*(y1-y0)) >= 1000 order by added desc, cluster limit 20",
    }
