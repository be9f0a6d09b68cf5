import math

import pytest
from pyspark.sql import functions as F

from littoral.functions.geo import polygon_wkb
from littoral.kernel import register, st
from littoral.operators import merge, overlap

H = [(0, 0), (0, 10), (10, 10), (10, 0), (0, 0)]
CASES = [
    ("overlap", [(8, 4), (8, 6), (14, 6), (14, 4), (8, 4)], True, False, 1, 108),
    ("inside", [(2, 2), (2, 3), (3, 3), (3, 2), (2, 2)], True, True, 1, 100),
    ("inside edge", [(0, 2), (0, 3), (3, 3), (3, 2), (0, 2)], True, True, 1, 100),
    ("equal", H, True, True, 1, 100),
    ("edge touch", [(10, 4), (10, 6), (12, 6), (12, 4), (10, 4)], True, False, 1, 104),
    ("point touch", [(10, 10), (10, 12), (12, 12), (12, 10), (10, 10)], True, False, 2, 104),
    ("disjoint", [(20, 20), (20, 21), (21, 21), (21, 20), (20, 20)], False, False, 2, 101),
    ("covers", [(-1, -1), (-1, 11), (11, 11), (11, -1), (-1, -1)], True, False, 1, 144),
    ("u shape", [(9, 1), (9, 9), (14, 9), (14, 8), (11, 8), (11, 2), (14, 2), (14, 1), (9, 1)], True, False, 1, 114),
    ("open ring", [(8, 4), (8, 6), (14, 6), (14, 4)], True, False, 1, 108),
    ("counter-clockwise", [(8, 4), (14, 4), (14, 6), (8, 6), (8, 4)], True, False, 1, 108),
    ("bow tie", [(9, 4), (11, 6), (11, 4), (9, 6), (9, 4)], True, False, 2, 101),
]


def test_cases(spark):
    register(spark)
    rows = [(name, polygon_wkb([H]), polygon_wkb([ring])) for name, ring, *_ in CASES]
    df = spark.createDataFrame(rows, "name string, h binary, a binary")
    got = {r.name: r for r in df.select("name", st("st_intersects", "h", "a").alias("i"), st("st_within", "a", "h").alias("w"), st("st_takes", "h", "a").alias("t"), st("st_union", "h", "a").alias("u")).collect()}
    area = {r.name: r.area for r in df.select("name", F.explode(st("st_union", "h", "a")).alias("p")).groupBy("name").agg(F.sum(st("st_area", "p")).alias("area")).collect()}
    for name, _, meets, within, parts, total in CASES:
        r = got[name]
        assert (r.i, r.w, r.t, len(r.u)) == (meets, within, meets and not within, parts), name
        assert area[name] == pytest.approx(total), name


def test_holes_and_nulls(spark):
    register(spark)
    hole = [(3, 3), (7, 3), (7, 7), (3, 7), (3, 3)]
    rows = [("fills", [(3, 3), (3, 7), (7, 7), (7, 3), (3, 3)], 1, 100), ("island", [(4, 4), (4, 6), (6, 6), (6, 4), (4, 4)], 2, 88), ("bridge", [(2, 4), (2, 5), (8, 5), (8, 4), (2, 4)], 1, 88)]
    df = spark.createDataFrame([(n, polygon_wkb([H, hole]), polygon_wkb([a])) for n, a, *_ in rows], "name string, h binary, a binary")
    got = {r.name: (r.n, r.area) for r in df.select("name", F.explode(st("st_union", "h", "a")).alias("p")).groupBy("name").agg(F.count("*").alias("n"), F.sum(st("st_area", "p")).alias("area")).collect()}
    assert got == {n: (parts, pytest.approx(area)) for n, _, parts, area in rows}
    empty = spark.createDataFrame([(None, None)], "a binary, b binary").select(st("st_union", "a", "b").alias("u"), st("st_area", "a").alias("s"), st("st_takes", "a", "b").alias("t"), st("st_asgeojson", "a").alias("j")).first()
    assert list(empty) == [None] * 4


def test_merge_modes(spark):
    register(spark)
    host, near, far = polygon_wkb([H]), polygon_wkb([[(9, 0), (9, 1), (12, 1), (12, 0), (9, 0)]]), polygon_wkb([[(9, 5), (9, 8), (12, 8), (12, 5), (9, 5)]])
    water = spark.createDataFrame([(1, host)], "wid long, geom binary")
    grouped = spark.createDataFrame([(1, [near, far])], "wid long, pieces array<binary>")
    united = merge.unions(grouped)
    assert [len(r.united) for r in united.collect()] == [2]
    contract = merge.merged(united, water).select(st("st_area", "geom").alias("area"), F.size("extras").alias("n")).first()
    assert (contract.area, contract.n) == (pytest.approx(100 + 2 + 6), 0)
    compat = merge.merged(united, water, "compat").select(st("st_area", "geom").alias("area"), F.size("extras").alias("n")).first()
    assert (compat.area, compat.n) == (pytest.approx(106), 1)
    touch = spark.createDataFrame([(1, [polygon_wkb([[(10, 10), (10, 40), (40, 40), (40, 10), (10, 10)]])])], "wid long, pieces array<binary>")
    kept = merge.merged(merge.unions(touch), water).select(st("st_area", "geom").alias("area"), F.size("extras").alias("n")).first()
    assert (kept.area, kept.n) == (pytest.approx(100), 1)


def test_cap():
    assert overlap.check_km(None) is overlap.check_km(0) is overlap.check_km(math.inf) is None
    for bad in (-1, math.nan):
        with pytest.raises(ValueError):
            overlap.check_km(bad)
