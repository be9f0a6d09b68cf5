"""Bringing the local inputs up to date: what a plan asks for is fetched, extracted and recorded.

Extraction calls two tools outside (see ``TOOLS``); another function of
``(pbf, shp)`` can stand in for it. An input is there whole or not at all: each is
written beside its place first.
"""

from __future__ import annotations

import logging
import os
import shutil
import subprocess
import urllib.error
import zipfile
from collections.abc import Callable, Iterable
from pathlib import Path

from ..functions import osm
from . import ingest
from .regions import BASE_URL

LOG = logging.getLogger(__name__)
TOOLS = ("osmium", "ogr2ogr")
SIDECARS = (".shx", ".dbf", ".prj", ".cpg")

# The archive of base polygons, its folder, and its key in the manifest.
BASE = "water-polygons-split-4326"
BASE_KEY = f"base/{BASE}.zip"


def base_shp(root: str | Path) -> Path:
    return Path(root) / BASE / "water_polygons.shp"


def missing_tools() -> list[str]:
    return [t for t in TOOLS if not shutil.which(t)]


def delete_cache(pbf: str | Path, shp: str | Path) -> None:
    """The extract, its filtered form, and the shapefile with its sidecars."""
    pbf, shp = Path(pbf), Path(shp)
    for old in (pbf, _filtered(pbf), shp, *(shp.with_suffix(s) for s in SIDECARS)):
        old.unlink(missing_ok=True)


def _filtered(pbf: Path) -> Path:
    return pbf.with_name(pbf.name.removesuffix(".osm.pbf") + "-water.osm.pbf")


def extract_commands(pbf: str | Path, shp: str | Path) -> list[list[str]]:
    """Features that ``osm.is_water`` describes, then those of ``osm.is_area_water`` as polygons."""
    pbf, listed = Path(pbf), ",".join
    water = "hstore_get_value(other_tags, 'water')"
    left_out = ", ".join(f"'{w}'" for w in osm.LEFT_OUT)
    tags = [f"w/natural={listed(osm.WAY_NATURAL)}", f"r/natural={listed(osm.RELATION_NATURAL)}", f"wr/waterway={osm.RIVERBANK}"]
    return [
        ["osmium", "tags-filter", "--overwrite", "-o", str(_filtered(pbf)), str(pbf), *tags],
        ["ogr2ogr", "-f", "ESRI Shapefile", "-dialect", "SQLite", "-sql", f"select * from multipolygons where {water} is null or {water} not in ({left_out})", str(shp), str(_filtered(pbf))],
    ]


def extract(pbf: str | Path, shp: str | Path, run: Callable = subprocess.run) -> None:
    """The shapefile is put in place last, after its sidecars: where it is, all is."""
    shp = Path(shp)
    shp.parent.mkdir(parents=True, exist_ok=True)
    aside = shp.with_name(f"part-{shp.name}")
    for old in (aside, *(aside.with_suffix(s) for s in SIDECARS)):
        old.unlink(missing_ok=True)
    for command in extract_commands(pbf, aside):
        run(command, check=True, env=os.environ | {"OGR_GEOMETRY_ACCEPT_UNCLOSED_RING": "YES"})
    for suffix in (*SIDECARS, ".shp"):
        if aside.with_suffix(suffix).exists():
            os.replace(aside.with_suffix(suffix), shp.with_suffix(suffix))


def apply(planned: Iterable, manifest: dict[str, dict], path: str | Path, fetch: Callable = ingest.download, extractor: Callable = extract, jobs: int = 4, extract_jobs: int = 2) -> list[str]:
    """Fetch and extract the rows of ``refresh.plan`` that need it; keys of those that were asked for.

    A row has ``key, url, pbf, shp, r_etag, r_lm`` beside the plan's columns. Its cache
    goes when its turn comes. The manifest takes what succeeded, even if a later one fails.
    """
    due = [r for r in planned if r.needs_refresh]

    def fetched(r) -> None:
        if r.deletes_cache:
            delete_cache(r.pbf, r.shp)
        if not Path(r.pbf).exists() and not Path(r.shp).exists():
            fetch(r.url, r.pbf)

    def extracted(r) -> None:
        if not Path(r.shp).exists():
            extractor(r.pbf, r.shp)

    def recorded(r) -> None:
        if r.records_metadata and (r.r_etag or r.r_lm):
            manifest[r.key] = {"etag": r.r_etag, "last_modified": r.r_lm, "url": r.url}

    try:
        ingest.refresh_all(due, fetched, extracted, recorded, jobs, extract_jobs)
    finally:
        ingest.save_manifest(path, manifest)
    return [r.key for r in due]


def refresh_base(root: str | Path, manifest: dict[str, dict], force: bool = False, head: Callable = ingest.remote_metadata, fetch: Callable = ingest.download) -> bool:
    """Whether the base polygons were fetched anew. An unreachable server leaves what is there, unless forced."""
    root, shp, url = Path(root), base_shp(root), f"{BASE_URL}/download/{BASE}.zip"
    try:
        now = head(url)
    except (urllib.error.URLError, TimeoutError) as e:
        if shp.exists() and not force:
            LOG.warning("%s: %s; base polygons stay as they are", url, e)
            return False
        raise
    then = manifest.get(BASE_KEY, {})
    same = any(now.get(k) and now.get(k) == then.get(k) for k in ("etag", "last_modified"))
    if same and shp.exists() and not force:
        return False
    archive, aside = root / f"{BASE}.zip", root / f"part-{BASE}"
    fetch(url, archive)
    shutil.rmtree(aside, ignore_errors=True)
    with zipfile.ZipFile(archive) as z:
        z.extractall(aside)
    shutil.rmtree(root / BASE, ignore_errors=True)
    os.replace(aside / BASE, root / BASE)
    shutil.rmtree(aside)
    archive.unlink()
    manifest[BASE_KEY] = {"etag": now.get("etag"), "last_modified": now.get("last_modified"), "url": url}
    return True
