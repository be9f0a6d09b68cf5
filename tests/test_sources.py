import json
import struct
import urllib.error

import numpy as np
import pytest

from littoral.cli import parser
from littoral.functions.geo import polygon_wkb
from littoral.kernel import register, st
from littoral.plans import refresh
from littoral.sources import ingest, regions, shapefile

H = [(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (10.0, 0.0), (0.0, 0.0)]
HOLE = [(3.0, 3.0), (7.0, 3.0), (7.0, 7.0), (3.0, 7.0), (3.0, 3.0)]
FAR = [(20.0, 0.0), (20.0, 5.0), (25.0, 5.0), (25.0, 0.0), (20.0, 0.0)]


def content(rings, kind=5, n_parts=None, first=0):
    points = [p for r in rings for p in r]
    starts = np.cumsum([first, *map(len, rings[:-1])]).astype("<i4")
    flat = np.array(points, "<f8")
    return struct.pack("<i4dii", kind, 0, 0, 30, 30, len(rings) if n_parts is None else n_parts, len(points)) + starts.tobytes() + flat.tobytes()


def test_round_trip(spark, tmp_path):
    register(spark)
    path = str(tmp_path / "a.shp")
    rows = spark.createDataFrame([(1, polygon_wkb([FAR])), (0, polygon_wkb([H, HOLE]))], "fid long, geom binary")
    shapefile.write(rows, path)
    back = shapefile.read(spark, path).orderBy("fid")
    assert [(r.fid, r.part, r.x0, r.y0, r.x1, r.y1) for r in back.collect()] == [(0, 0, 0, 0, 10, 10), (1, 0, 20, 0, 25, 5)]
    assert [r.a for r in back.select(st("st_area", "geom").alias("a")).collect()] == [84.0, 25.0]
    assert (tmp_path / "a.dbf").read_bytes().endswith(b"          0           1\x1a")
    assert shapefile.read(spark, path, bbox=(-1, -1, 2, 2)).count() == 1
    cut = shapefile.clipped(spark, path, (5.0, 0.0, 22.0, 20.0)).select(st("st_area", "geom").alias("a")).collect()
    assert sorted(r.a for r in cut) == [10.0, 42.0]
    assert spark.read.format("shapefile").option("records", 1).load(path).rdd.getNumPartitions() == 2


def test_an_empty_table_replaces_what_was_there(spark, tmp_path):
    path = str(tmp_path / "a.shp")
    rows = spark.createDataFrame([(0, polygon_wkb([H])), (1, polygon_wkb([FAR]))], "fid long, geom binary")
    shapefile.write(rows, path)
    shapefile.write(rows.filter("fid = 1"), path)
    assert shapefile.read(spark, path).count() == 1
    shapefile.write(rows.filter("fid > 5"), path)
    assert shapefile.read(spark, path).count() == 0
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["a.dbf", "a.prj", "a.shp", "a.shx"]


def test_records():
    two = shapefile.decode(content([H, FAR, HOLE]))
    assert [len(p) for p in two] == [2, 1]
    assert [len(p) for p in shapefile.decode(content([H, FAR, HOLE]), "compat")] == [3]
    assert shapefile.decode(content([H], kind=15)) is None and shapefile.decode(struct.pack("<i", 0)) is None
    assert shapefile.decode(content([[]])) is None
    for bad in (content([H], n_parts=0), content([H, FAR], first=1), content([H])[:-8]):
        with pytest.raises(shapefile.BadShapefile):
            shapefile.decode(bad)
    assert len(shapefile.decode(content([H[:-1]]))[0][0]) == 5


def test_manifest(spark, tmp_path):
    path = tmp_path / "m" / "manifest.json"
    assert ingest.load_manifest(path) == {}
    ingest.save_manifest(path, {"b": {"etag": "1", "last_modified": None, "url": "u"}, "a": {}})
    assert list(json.loads(path.read_text())) == ["a", "b"]
    old = ingest.manifest_table(spark, ingest.load_manifest(path))
    fresh = spark.createDataFrame([("b", "x", "2", "u"), ("c", None, None, "u")], "key string, last_modified string, etag string, url string")
    assert sorted((r.key, r.etag) for r in refresh.recorded(old, fresh).collect()) == [("a", None), ("b", "2")]
    path.write_text("{")
    assert ingest.load_manifest(path) == {}


def test_retries():
    waits, calls = [], []

    def job():
        calls.append(1)
        if len(calls) < 3:
            raise urllib.error.HTTPError("u", 503, "busy", None, None)
        return "ok"

    assert ingest.with_retries(job, "x", sleep=waits.append) == "ok"
    assert len(waits) == 2 and 4 <= waits[0] <= 6 and 8 <= waits[1] <= 12
    assert not ingest.is_retryable(urllib.error.HTTPError("u", 404, "", None, None)) and ingest.is_retryable(TimeoutError())
    with pytest.raises(ValueError):
        ingest.with_retries(lambda: (_ for _ in ()).throw(ValueError()), "x", sleep=waits.append)


def test_refresh_side_by_side():
    done = []
    ingest.refresh_all(range(5), lambda x: x, lambda x: x, done.append)
    assert sorted(done) == list(range(5))
    with pytest.raises(RuntimeError):
        ingest.refresh_all([1], lambda x: (_ for _ in ()).throw(RuntimeError()), print, done.append)


def test_regions(spark):
    rows = regions.table(spark).collect()
    assert len(rows) == 77 and rows[0].region == "albania" and rows[-1].region == "south-america"
    paths = regions.select_paths(spark, ["russia", "quebec"], "/d").collect()
    assert [p.shp for p in paths] == ["/d/shapefiles/russia/water.shp", "/d/shapefiles/north-america/canada/quebec/water.shp"]


def test_arguments():
    args = parser().parse_args(["merge", "w.shp", "r.shp", "--max-inland-km", "3"])
    assert args.max_inland_km == 3 and args.regions == ["r.shp"]
    for bad in (["merge", "w.shp"], ["merge", "w.shp", "r.shp", "--max-inland-km", "-1"], ["merge", "w.shp", "r.shp", "--max-inland-km", "nan"]):
        with pytest.raises(SystemExit):
            parser().parse_args(bad)


def test_skipped_records_are_counted(spark, tmp_path, caplog):
    records = [content([H]), content([H], kind=15), content([H], kind=15), content([[]]), struct.pack("<i", 0), content([FAR])]
    shapes, index = bytearray(100), bytearray(struct.pack(">i", shapefile.FILE_CODE) + bytes(96))
    for k, c in enumerate(records):
        index += struct.pack(">ii", len(shapes) // 2, len(c) // 2)
        shapes += struct.pack(">ii", k + 1, len(c) // 2) + c
    path = str(tmp_path / "mixed.shp")
    (tmp_path / "mixed.shp").write_bytes(shapes)
    (tmp_path / "mixed.shx").write_bytes(index)
    assert sorted(r.fid for r in shapefile.read(spark, path).collect()) == [0, 5]
    for step in (2, 20_000):
        assert {r.kind: r.records for r in shapefile.skipped(spark, path, step).collect()} == {15: 2, 5: 1, 0: 1}
    reader = shapefile.ShapefileReader({"path": path})
    for p in reader.partitions():
        list(reader.read(p))
    assert "skipped 4" in caplog.text
