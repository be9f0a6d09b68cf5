"""Polygons and hosts piled on one place: what is asked for each polygon does not form all pairs."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from littoral import queries as core
from littoral.functions.geo import polygon_wkb
from littoral.kernel import register, st
from littoral.operators import overlap, spatial_join
from littoral.plans import fold as folding

from .check_oracles import compare, connect
from .test_fold import region_by_region

N = 400


@pytest.fixture(scope="module")
def pile(tmp_path_factory):
    """All polygons and hosts have nearly one corner (keys that are equal modulo 36,000), but different sides."""
    folder = tmp_path_factory.mktemp("pile")
    duckdb.sql(f"copy (select cast(36000*i + 28 as bigint) c_custkey, cast(i%5 as int) c_nationkey from range({N}) r(i)) to '{folder}/customer.parquet' (format parquet)")
    duckdb.sql(f"copy (select cast(36000*i + 5857 as bigint) p_partkey, cast(1 + i*7%50 as int) p_size from range({N}) r(i)) to '{folder}/part.parquet' (format parquet)")
    return str(folder)


@pytest.fixture
def formed(monkeypatch):
    """How many pairs the grid joins of a query give."""
    counts, join = [], overlap.grid_join

    def counted(*args, **kwargs):
        out = join(*args, **kwargs)
        counts.append(out.count())
        return out

    monkeypatch.setattr(overlap, "grid_join", counted)
    monkeypatch.setattr(overlap, "FEW", 1000, raising=False)
    return counts


ONE_HOST_EACH = ["first_match", "append_fids", "overlap_groups", "cap_clip", "host_union_area", "unmatched_areas", "delta_area", "patch_area"]


@pytest.mark.parametrize("name", ONE_HOST_EACH)
def test_few_pairs_for_one_host_each(spark, pile, formed, name):
    got, want = compare(spark, connect(pile), pile, core.queries()[name], core.oracle_sql()[name])
    assert got == want
    assert 0 < sum(formed) < N * N / 4


ONE_REGION = ["fold_one_region_patches", "fold_one_region", "fold_one_region_output"]


@pytest.mark.parametrize("name", ONE_REGION)
def test_few_pairs_for_a_fold_of_one_region(spark, pile, formed, name):
    got, want = compare(spark, connect(pile), pile, core.queries()[name], core.oracle_sql()[name])
    assert got == want
    assert 0 < sum(formed) < N * N / 4


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
@pytest.mark.parametrize("name, n", [("envelope_candidates", 274_388), ("overlap_pairs", None)])
def test_pairs_of_one_small_file_are_many_tasks(spark, monkeypatch, name, n):
    monkeypatch.setattr(spatial_join, "MANY", 1000, raising=False)
    pairs = core.queries()[name](spark, "/root/testdata/sf0.1")
    tasks = pairs.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 6 and n in (None, sum(r[1] for r in tasks))


def sides(spark, n_water=40, n_area=90, regions=3):
    """Boxes, and triangles among them, on one place."""
    rng = random.Random(5)

    def rows(n, size, odd):
        out = []
        for k in range(n):
            x, y = float(rng.randrange(60)), float(rng.randrange(60))
            w, h = float(rng.randrange(4, size)), float(rng.randrange(4, size))
            ring = [(x, y), (x, y + h), (x + w, y + h), (x + w, y)]
            out.append((k, k % regions, x, y, x + w, y + h, bytearray(polygon_wkb([ring[:3] if k % odd == 0 else ring]))))
        return out

    columns = "long, rid long, x0 double, y0 double, x1 double, y1 double, geom binary"
    water = spark.createDataFrame(rows(n_water, 30, 3), f"wid {columns}").drop("rid")
    return water, spark.createDataFrame(rows(n_area, 15, 4), f"aid {columns}")


def test_exact_pairs_are_the_exact_predicate(spark, monkeypatch):
    register(spark)
    monkeypatch.setattr(overlap, "FEW", 100, raising=False)
    water, area = sides(spark)
    plain = area.select("aid", F.col("geom").alias("a")).crossJoin(water.select("wid", F.col("geom").alias("w"))).filter(st("st_takes", "w", "a"))
    want = sorted((r.aid, r.wid) for r in plain.select("aid", "wid").collect())
    water, area = overlap.boxed(water), overlap.boxed(area)
    assert sorted((r.aid, r.wid) for r in overlap.exact_pairs(water, area, 20).collect()) == want
    firsts = {}
    for aid, wid in want:
        firsts.setdefault(aid, wid)
    assert {r.aid: r.wid for r in overlap.first_exact(water, area, 20).collect()} == firsts


def test_rectangles_need_no_geometry(spark, monkeypatch):
    def none(*args):
        raise AssertionError("geometry of rectangles met")

    monkeypatch.setattr(overlap, "takes", none)
    sf = "/root/testdata/sf0.001"
    got, want = compare(spark, connect(sf), sf, core.exact_pairs, core.oracle_sql()["exact_pairs"])
    assert got == want


@pytest.mark.parametrize("what", ["metrics", "patches", "output"])
def test_crowded_regions_follow_each_other_without_all_pairs(spark, monkeypatch, what):
    register(spark)
    water, area = sides(spark)
    rows, areas = region_by_region(water, area)
    monkeypatch.setattr(folding, "levels", None)
    done = folding.fold(water, area, cell=50)
    if what == "metrics":
        assert {r.ord: (r.matched_hosts, r.extras, r.patches) for r in done.metrics.collect()} == rows
    elif what == "patches":
        assert {r.ord: r["count"] for r in done.patches.groupBy("ord").count().collect()} == {k: v[2] for k, v in rows.items() if v[2]}
    else:
        assert {r.fid: round(r.a, 6) for r in done.output().filter("fid < 40").select("fid", st("st_area", "geom").alias("a")).collect()} == areas
