"""Geometry is worked on once, and dealt by the work and not by the number of shuffle partitions or bytes."""

import pytest

from littoral import scratch
from littoral.functions.geo import polygon_wkb
from littoral.kernel import register, st
from littoral.operators import merge, overlap, spatial_join
from littoral.plans import fold as folding

from .test_large import sides


def box(x0, y0, x1, y1):
    return bytearray(polygon_wkb([[(x0, y0), (x0, y1), (x1, y1), (x1, y0)]]))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fold_deals_hosts_to_tasks(spark, monkeypatch):
    """F6 patches, F16 merged_water: few bytes of offers were one task."""
    register(spark)
    water, area = sides(spark)
    plans, write = [], scratch.materialize

    def noted(df, name, by=()):
        if name == "evolved":
            plans.append(plan(df))
        return write(df, name, by)

    monkeypatch.setattr(scratch, "materialize", noted)
    assert folding.fold(water, area, cell=50).patches.count() > 0
    assert plans and all("RepartitionByExpression [wid" in p for p in plans)


def test_lists_are_few_tasks(spark, monkeypatch):
    """F5 overlap_groups, F12 unmatched_areas: 200 tasks of next to nothing took eight seconds."""
    water, area = sides(spark)
    hosts = overlap._hosts(water)
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        lists = spatial_join.grid_lists(area.drop("geom"), hosts, 20, 1_000_000, overlap.ENVELOPE, overlap.HOST_ENV)
        assert lists.count() > 0 and lists.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_unions_are_computed_once(spark):
    """F10 host_union_area, F13 delta_area, F17 patch_area, F4, F15: a filter computed each union again."""
    register(spark)
    found = spark.createDataFrame([(1, 1, box(0, 0, 4, 4)), (2, 1, box(1, 1, 2, 2))], "aid long, wid long, piece binary")
    united = merge.unions(found.groupBy("wid").agg({"piece": "collect_list"}).toDF("wid", "pieces"))
    assert plan(united).count("st_union_all") == 1
    done = merge.merged(united, found.filter("aid = 1").withColumnRenamed("piece", "geom"))
    assert plan(done.filter("size(extras) >= 0")).count("st_merge") == 1
    assert done.select(st("st_area", "geom")).first()[0] == 16


def test_rectangles_in_rectangles_add_nothing_to_a_union(spark):
    """F4 and others: the side of the small one lies on that of the large one and left corners on it."""
    register(spark)
    triangle = bytearray(polygon_wkb([[(1.0, 1.0), (1.0, 3.0), (3.0, 1.0)]]))
    rows = [([box(0, 0, 4, 4), box(0, 1, 2, 2), box(0, 0, 4, 4), triangle, None],), ([box(0, 0, 4, 4), box(2, 2, 6, 3)],), ([triangle, box(1, 1, 2, 2)],)]
    united = spark.createDataFrame(rows, "g array<binary>").select(st("st_union_all", "g").alias("u"))
    got = [[(round(a, 9), s) for a, s in r.x] for r in united.selectExpr("transform(u, p -> struct(st_area(p) as a, length(p) as s)) x").collect()]
    assert got[0] == [(16.0, 93)]
    assert [a for a, _ in got[1]] == [18.0] and [a for a, _ in got[2]] == [2.0]


@pytest.mark.parametrize("cap, want", [((1, 1, 3, 9), 6.0), ((4, 0, 9, 9), None), ((-1, -1, 9, 9), 16.0)])
def test_clipped_rectangles(spark, cap, want):
    """F7 cap_clip: by their corners alone, with the parts that an overlay gives."""
    register(spark)
    df = spark.createDataFrame([(box(0, 0, 4, 4), *map(float, cap))], "g binary, a double, b double, c double, d double")
    got = df.select(st("st_clip", "g", "a", "b", "c", "d").alias("p")).selectExpr("transform(p, x -> st_area(x)) x").first().x
    assert got == ([] if want is None else [want])
