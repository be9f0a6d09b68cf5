"""The update command against a made-up server and extraction; differences as a report."""

import csv
import glob
import urllib.error
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from littoral import fixtures as fx
from littoral.cli import load, parser, run_diff, run_update
from littoral.kernel import register, st
from littoral.sources import ingest, shapefile, update

AREAS = ["malta", "quebec"]


def boxes(spark, rows):
    return fx.with_geom(spark.createDataFrame(rows, "fid long, x0 long, y0 long, x1 long, y1 long")).select("fid", "geom")


class Server:
    """States by address; downloads write a marker, or the archive of base polygons."""

    def __init__(self, base):
        self.base, self.tags, self.fetched, self.down = base, {}, [], False

    def head(self, url, attempts):
        if self.down:
            raise urllib.error.URLError("down")
        return {"etag": self.tags.get(url, "1"), "last_modified": None}

    def fetch(self, url, target, attempts):
        self.fetched.append(url)
        target = Path(target)
        target.parent.mkdir(parents=True, exist_ok=True)
        if url.endswith(".zip"):
            with zipfile.ZipFile(target, "w") as z:
                for p in glob.glob(f"{self.base}/*"):
                    z.write(p, f"{update.BASE}/{Path(p).name}")
        else:
            target.write_text("pbf")


@pytest.fixture
def world(spark, tmp_path):
    register(spark)
    made = tmp_path / "made"
    made.mkdir()
    shapefile.write(boxes(spark, [(0, 0, 0, 10, 10), (1, 50, 50, 60, 60)]), str(made / "water_polygons.shp"))
    region = tmp_path / "region.shp"
    shapefile.write(boxes(spark, [(0, 8, 2, 20, 8)]), str(region))

    def extract(pbf, shp):
        Path(shp).parent.mkdir(parents=True, exist_ok=True)
        for p in glob.glob(str(region.with_suffix(".*"))):
            Path(shp).with_suffix(Path(p).suffix).write_bytes(Path(p).read_bytes())

    return tmp_path / "data", Server(made), extract


def update_args(root, *more):
    return parser().parse_args(["update", str(root), "--areas", *AREAS, *more])


def test_update(spark, world, capsys):
    root, server, extract = world
    run = lambda *more: run_update(spark, update_args(root, *more), server.head, server.fetch, extract)
    with pytest.raises(SystemExit):
        run("--no-download")
    run("--check-only")
    assert capsys.readouterr().out.split() == ["europe/malta", "north-america/canada/quebec"] and not server.fetched
    run()
    assert len(server.fetched) == 3
    assert sorted(ingest.load_manifest(root / "manifest.json")) == [update.BASE_KEY, "europe/malta", "north-america/canada/quebec"]
    out = load(spark, str(root / "corrected-water-polygons.shp"))
    assert sorted(r.a for r in out.select(st("st_area", "geom").alias("a")).collect()) == [100.0, 160.0]
    assert (root / "patches.shp").exists()

    # Nothing has changed: nothing is fetched. One region changes: it alone is.
    server.fetched.clear()
    capsys.readouterr()
    run("--check-only")
    assert not capsys.readouterr().out.split() and not server.fetched
    server.tags = {"https://download.geofabrik.de/europe/malta-latest.osm.pbf": "2"}
    run("--no-patches")
    assert [Path(u).name for u in server.fetched] == ["malta-latest.osm.pbf"]

    # A failed extraction is not recorded, what went before it is.
    server.tags = {u: "3" for u in ("https://download.geofabrik.de/europe/malta-latest.osm.pbf", "https://download.geofabrik.de/north-america/canada/quebec-latest.osm.pbf")}

    def failing(pbf, shp):
        if "quebec" in str(pbf):
            raise RuntimeError("no extract")
        extract(pbf, shp)

    with pytest.raises(RuntimeError):
        run_update(spark, update_args(root, "--jobs", "1"), server.head, server.fetch, failing)
    tags = {k: v["etag"] for k, v in ingest.load_manifest(root / "manifest.json").items()}
    assert tags["europe/malta"] == "3" and tags["north-america/canada/quebec"] == "1"

    # Without a server the base polygons stay.
    server.down = True
    assert update.refresh_base(root, {}, head=lambda url: server.head(url, 1)) is False
    with pytest.raises(urllib.error.URLError):
        update.refresh_base(root, {}, force=True, head=lambda url: server.head(url, 1))


def test_extraction_puts_the_shapefile_in_place_last(tmp_path):
    ran = []

    def run(command, check, env):
        ran.append(command[0])
        assert env["OGR_GEOMETRY_ACCEPT_UNCLOSED_RING"] == "YES"
        if command[0] == "ogr2ogr":
            for s in (".shp", ".shx", ".dbf"):
                Path(command[-2]).with_suffix(s).write_text(s)

    shp = tmp_path / "a" / "water.shp"
    update.extract(tmp_path / "a.osm.pbf", shp, run)
    assert ran == list(update.TOOLS) and sorted(p.name for p in shp.parent.iterdir()) == ["water.dbf", "water.shp", "water.shx"]
    update.delete_cache(tmp_path / "a.osm.pbf", shp)
    assert not list(shp.parent.iterdir())


def test_diff_report(spark, tmp_path):
    register(spark)
    degrees = lambda rows: spark.createDataFrame(rows, "fid long, x0 double, y0 double, x1 double, y1 double").withColumn("geom", st("st_box", "x0", "y0", "x1", "y1"))
    before = degrees([(0, 0.0, 0.0, 1.0, 1.0), (1, 1.02, 0.0, 2.0, 1.0), (2, 30.0, 0.0, 31.0, 1.0)])
    after = degrees([(0, 0.0, 0.0, 1.01, 1.0), (1, 1.02, 0.0, 2.0, 1.01), (2, 30.0, 0.0, 31.1, 1.0), (3, 70.0, 0.0, 70.0001, 0.0001)])
    paths = [str(tmp_path / f"{n}.parquet") for n in ("before", "after")]
    for df, p in zip((before, after), paths):
        df.write.parquet(p)
    report = lambda *more: run_diff(spark, parser().parse_args(["diff", "--reference", paths[0], "--revised", paths[1], "--output", str(tmp_path / "out"), *more]))

    def rows():
        return [r for p in sorted(glob.glob(str(tmp_path / "out" / "clusters.csv" / "*.csv"))) for r in csv.DictReader(open(p))]

    # Rows 0 and 1 gain strips a kilometre apart; the new polygon of a few square metres is too small.
    report()
    assert [r["fids"] for r in rows()] == ["2", "0 1"]
    assert abs(float(rows()[0]["added_km2"]) - 0.1 * 111**2) < 1
    report("--bbox", "0", "0", "5", "5", "--cluster-buffer-km", "0.5")
    assert sorted(r["fids"] for r in rows()) == ["0", "1"]
    report("--min-delta-km2", "0", "--most", "1")
    assert len(rows()) == 1
    assert load(spark, paths[1]).filter(F.col("fid") == 3).count() == 1
