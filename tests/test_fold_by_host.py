"""The fold by hosts is the fold region by region."""

import pytest
from pyspark.sql import functions as F

from littoral.kernel import register, st
from littoral.operators import overlap
from littoral.plans import fold as folding

from .test_fold import region_by_region
from .test_large import sides


@pytest.mark.parametrize("first", [2, 16])
def test_fold_by_hosts(spark, monkeypatch, first):
    """Triangles among boxes; some polygons are refused by all candidates looked up at first."""
    register(spark)
    water, area = sides(spark, 12, 60, 4)
    want, areas = region_by_region(water, area)
    monkeypatch.setattr(folding, "FIRST", first, raising=False)
    monkeypatch.setattr(folding, "levels", None)
    monkeypatch.setattr(folding, "_by_region", None)
    done = folding.fold(water, area, cell=50)
    assert {r.ord: (r.matched_hosts, r.extras, r.patches) for r in done.metrics.collect()} == want
    assert {r.ord: r["count"] for r in done.patches.groupBy("ord").count().collect()} == {k: v[2] for k, v in want.items() if v[2]}
    assert {r.fid: round(r.a, 6) for r in done.output().filter("fid < 12").select("fid", st("st_area", "geom").alias("a")).collect()} == areas


@pytest.mark.parametrize("most", [1, 4])
def test_first_hosts_are_the_first_candidates(spark, most):
    water, area = sides(spark)
    register(spark)
    water = overlap.boxed(water)
    pairs = overlap.candidates(water, area, 20).join(water.select("wid", "box"), "wid").filter(~F.col("box") | overlap.box_takes())
    want = {r.aid: sorted(r.w)[:most] for r in pairs.groupBy("aid").agg(F.collect_list("wid").alias("w")).collect()}
    assert {r.aid: list(r.wids) for r in overlap.first_hosts(water, area, 20, most).collect()} == want
