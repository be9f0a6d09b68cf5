"""Region order: predicates see hosts as earlier regions left them, candidates do not."""

import pytest
from pyspark.sql import functions as F

from littoral import fixtures as fx
from littoral.kernel import register, st
from littoral.operators.spatial_join import grid_join
from littoral.plans.fold import fold


def boxes(spark, rows, ids):
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in (*ids, "x0", "y0", "x1", "y1")))
    return fx.with_geom(df)


def test_regions_follow_each_other(spark):
    register(spark)
    water = boxes(spark, [(1, 0, 0, 10, 10), (2, 100, 0, 110, 10)], ["wid"])
    # Region 0 grows host 1; region 1's polygon 11 lies within that growth; 12 meets the growth alone.
    area = boxes(spark, [(10, 0, 8, 2, 20, 8), (11, 1, 9, 3, 15, 7), (12, 1, 18, 3, 25, 7), (13, 1, 105, 5, 120, 6)], ["aid", "rid"])
    done = fold(water, area, cell=10)
    assert [tuple(r) for r in done.metrics.orderBy("ord").collect()] == [(0, 1, 1, 0, 1), (1, 3, 1, 0, 1)]
    areas = {r.wid: r.a for r in done.water.select("wid", st("st_area", "geom").alias("a")).collect()}
    assert areas == {1: 160.0, 2: 110.0}
    assert done.output().count() == 2


def test_one_region_is_a_batch_and_extras_follow(spark):
    register(spark)
    water = boxes(spark, [(1, 0, 0, 10, 10)], ["wid"])
    area = boxes(spark, [(10, 0, 10, 10, 12, 12), (11, 1, 12, 12, 14, 14)], ["aid", "rid"])
    done = fold(water, area, cell=4)
    # A point touch leaves the polygon beside the host, where it takes nothing from later regions.
    assert [tuple(r) for r in done.metrics.orderBy("ord").collect()] == [(0, 1, 1, 1, 1), (1, 1, 0, 0, 0)]
    assert sorted(r.fid for r in done.output().collect()) == [0, 1]


def region_by_region(water, area):
    """The fold as it is defined, one region at a time, on rectangles and by way of the same kernel."""
    from littoral.operators import merge, overlap
    from littoral.scratch import materialize

    pairs = materialize(overlap.candidates(water, area, 50), "t")
    now, rows = water.select("wid", "geom"), {}
    for rid in sorted(r.rid for r in area.select("rid").distinct().collect()):
        taken = materialize(overlap.takes(pairs.filter(F.col("rid") == rid), now, area), "t")
        best = taken.join(overlap.first_match(taken), ["aid", "wid"])
        united = materialize(merge.unions(overlap.groups(overlap.pieces(best))), "t")
        done = materialize(merge.merged(united, now), "t")
        rows[rid] = (done.count(), done.agg(F.coalesce(F.sum(F.size("extras")), F.lit(0))).first()[0], merge.patches(united).count())
        now = materialize(merge.replaced(now, done), "t")
    areas = {r.wid: round(r.a, 6) for r in now.select("wid", st("st_area", "geom").alias("a")).collect()}
    return rows, areas


def test_levels_are_the_fold_region_by_region(spark):
    import random

    register(spark)
    rng = random.Random(4)
    box = lambda size: (lambda x, y: (x, y, x + rng.randrange(5, size), y + rng.randrange(5, size)))(rng.randrange(120), rng.randrange(120))
    water = boxes(spark, [(k, *box(30)) for k in range(14)], ["wid"])
    area = boxes(spark, [(100 + k, k % 4, *box(25)) for k in range(28)], ["aid", "rid"])
    rows, areas = region_by_region(water, area)
    done = fold(water, area, cell=50)
    assert {r.ord: (r.matched_hosts, r.extras, r.patches) for r in done.metrics.collect()} == rows
    assert {r.wid: round(r.a, 6) for r in done.water.select("wid", st("st_area", "geom").alias("a")).collect()} == areas


def test_empty(spark):
    register(spark)
    water = boxes(spark, [(1, 0, 0, 10, 10)], ["wid"])
    none = fold(water, boxes(spark, [], ["aid", "rid"]))
    assert none.metrics.count() == 0 and none.output().count() == 1 and none.patches.count() == 0


@pytest.mark.parametrize("cell", [1.0, 7.0, 1000.0])
def test_grid_join_is_the_theta_join(spark, cell):
    a = spark.range(120).selectExpr("id aid", "cast((id*37)%200-100 as double) x0", "cast((id*53)%100-50 as double) y0", "cast((id*37)%200-100+id%9*if(id%11=0,90,1) as double) x1", "cast((id*53)%100-50+id%7 as double) y1")
    b = a.select(F.col("aid").alias("bid"), *(F.col(c).alias(f"b_{c}") for c in ("x0", "y0", "x1", "y1")))
    env = [f"b_{c}" for c in ("x0", "y0", "x1", "y1")]
    got = sorted((r.aid, r.bid) for r in grid_join(a, b, cell, right_env=env).collect())
    rows = a.collect()
    want = sorted((p.aid, q.aid) for p in rows for q in rows if p.x0 <= q.x1 and p.x1 >= q.x0 and p.y0 <= q.y1 and p.y1 >= q.y0)
    assert got == want


def test_hosts_of_many_chunks(spark, monkeypatch):
    """Chunks of a few polygons change neither who takes what nor the area."""
    import random

    from littoral.operators import merge, overlap

    register(spark)
    rng = random.Random(9)
    box = lambda size: (lambda x, y: (x, y, x + rng.randrange(5, size), y + rng.randrange(5, size)))(rng.randrange(60), rng.randrange(60))
    water = boxes(spark, [(k, *box(60)) for k in range(4)], ["wid"])
    area = boxes(spark, [(100 + k, 0, *box(25)) for k in range(60)], ["aid", "rid"])
    pairs = overlap.candidates(water, area, 20)

    def result():
        taken = overlap.takes(pairs, water, area)
        found = overlap.pieces(taken.join(overlap.first_match(taken), ["aid", "wid"]))
        united = merge.unions(overlap.groups(found))
        areas = {r.wid: round(r.a, 6) for r in merge.patches(united).groupBy("wid").agg(F.sum(st("st_area", "geom")).alias("a")).collect()}
        return sorted((r.aid, r.wid) for r in taken.collect()), areas

    one = result()
    plain = pairs.join(area.select("aid", F.col("geom").alias("a")), "aid").join(water.select("wid", F.col("geom").alias("w")), "wid").filter(st("st_takes", "w", "a"))
    assert one[0] == sorted((r.aid, r.wid) for r in plain.collect())
    monkeypatch.setattr(overlap, "CHUNK", 300)
    assert result() == one
