"""``python -m littoral.cli merge|plan|update|diff|serve``."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path
from urllib.parse import parse_qs, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch
from .functions.geo import ENVELOPE
from .kernel import register
from .operators import merge, overlap, qa
from .plans import fold as folding
from .plans import refresh
from .sources import ingest, regions, shapefile, update

LOG = logging.getLogger(__name__)


def kilometres(text: str) -> float:
    value = float(text)
    if not value >= 0:
        raise argparse.ArgumentTypeError("a distance is not negative")
    return value


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="littoral")
    commands = out.add_subparsers(dest="command", required=True)
    m = commands.add_parser("merge", help="merge regional polygons into the base polygons")
    m.add_argument("water")
    m.add_argument("regions", nargs="+")
    m.add_argument("-o", "--output")
    m.add_argument("--max-inland-km", type=kilometres, default=0.0)
    m.add_argument("--patches-output")
    m.add_argument("--mode", choices=merge.MODES, default="contract")
    p = commands.add_parser("plan", help="what would be fetched again")
    p.add_argument("manifest")
    p.add_argument("root")
    u = commands.add_parser("update", help="fetch and extract what has changed, then merge all selected regions")
    u.add_argument("root")
    u.add_argument("-o", "--output")
    u.add_argument("--jobs", type=int, default=4)
    u.add_argument("--extract-jobs", type=int, default=2)
    u.add_argument("--check-only", action="store_true")
    u.add_argument("--no-download", action="store_true")
    u.add_argument("--max-inland-km", type=kilometres, default=0.0)
    u.add_argument("--patches-output")
    u.add_argument("--no-patches", action="store_true")
    u.add_argument("--mode", choices=merge.MODES, default="contract")
    for c in (p, u):
        c.add_argument("--areas", nargs="*", choices=[r for r, _ in regions.REGIONS])
        c.add_argument("--force", action="store_true")
        c.add_argument("--min-cache-age-days", type=float, default=0.0)
        c.add_argument("--max-retries", type=int, default=ingest.ATTEMPTS)
    d = commands.add_parser("diff", help="what a revised layer has gained, in clusters")
    d.add_argument("--reference", required=True)
    d.add_argument("--revised", required=True)
    d.add_argument("--output", required=True)
    d.add_argument("--min-delta-km2", type=float, default=qa.LEAST_KM2)
    d.add_argument("--cluster-buffer-km", type=kilometres, default=qa.BUFFER_KM)
    d.add_argument("--bbox", type=float, nargs=4)
    d.add_argument("--most", type=int, default=0)
    s = commands.add_parser("serve", help="viewports as GeoJSON over HTTP")
    s.add_argument("--patches", required=True)
    s.add_argument("--coastline")
    s.add_argument("--host", default="127.0.0.1")
    s.add_argument("--port", type=int, default=8000)
    s.add_argument("--max-features", type=int, default=qa.MOST_FEATURES)
    s.add_argument("--simplify-divisor", type=float, default=qa.DIVISOR)
    return out


def load(spark: SparkSession, path: str) -> DataFrame:
    """``fid, geom, x0..y1`` of a shapefile or a Parquet table."""
    if path.endswith(".shp"):
        rows = shapefile.read(spark, path)
        return merge.append_fids(rows.withColumnRenamed("fid", "record"), ["record", "part"], 0).select("fid", "geom", *ENVELOPE)
    return spark.read.parquet(path).select("fid", "geom", *ENVELOPE)


def save(rows: DataFrame, path: str) -> None:
    if path.endswith(".shp"):
        shapefile.write(rows, path)
    else:
        merge.with_envelope(rows).write.mode("overwrite").parquet(path)


def run_merge(spark: SparkSession, args: argparse.Namespace) -> None:
    register(spark)
    water = load(spark, args.water).withColumnRenamed("fid", "wid")
    area = None
    for order, path in enumerate(args.regions):
        one = load(spark, path).select(F.lit(order).cast("long").alias("rid"), F.col("fid").alias("own"), "geom", *ENVELOPE)
        area = one if area is None else area.unionByName(one)
    area = merge.append_fids(area, ["rid", "own"], 0).select(F.col("fid").alias("aid"), "rid", "geom", *ENVELOPE)
    done = folding.fold(water, area, overlap.check_km(args.max_inland_km), args.mode)
    default = str(Path(args.water).with_name(Path(args.water).stem + "_updated" + Path(args.water).suffix))
    save(done.output(), args.output or default)
    if args.patches_output:
        save(merge.append_fids(done.patches, ["ord", "wid", "piece"], 0).select("fid", "geom"), args.patches_output)
    for r in done.metrics.orderBy("ord").collect():  # as many rows as regions were named
        print(*r, sep="\t")


def states(spark: SparkSession, args: argparse.Namespace, head=ingest.remote_metadata) -> DataFrame:
    """The state of each selected region: server, manifest and disk."""
    selected = regions.select_paths(spark, args.areas, args.root).collect()
    manifest, rows = ingest.load_manifest(args.manifest), []
    for r in selected:
        try:
            now, ok = head(r.url, args.max_retries), True
        except OSError as e:
            LOG.warning("%s: %s", r.url, e)
            now, ok = {}, False
        then = manifest.get(r.key, {})
        rows.append((r.key, r.url, r.pbf, r.shp, args.force, ok, now.get("etag"), now.get("last_modified"), then.get("etag"), then.get("last_modified"), Path(r.shp).exists(), Path(r.pbf).exists(), ingest.age_days(r.shp), args.min_cache_age_days))
    return spark.createDataFrame(rows, "key string, url string, pbf string, shp string, force boolean, head_ok boolean, r_etag string, r_lm string, m_etag string, m_lm string, have_shp boolean, have_pbf boolean, shp_age_days double, min_age double")


def run_update(spark: SparkSession, args: argparse.Namespace, head=ingest.remote_metadata, fetch=ingest.download, extractor=update.extract) -> None:
    """Fetched, extracted and recorded first, then all selected regions merged anew: a union cannot be taken back."""
    root = Path(args.root)
    path, selected = root / "manifest.json", regions.select_paths(spark, args.areas, args.root).collect()
    if args.no_download:
        gone = [str(p) for p in (update.base_shp(root), *(Path(r.shp) for r in selected)) if not p.exists()]
        if gone:
            sys.exit("missing: " + ", ".join(gone))
    else:
        args.manifest, args.max_retries = str(path), max(1, args.max_retries)
        planned = refresh.plan(states(spark, args, head)).collect()  # as many rows as regions
        if args.check_only:
            print(*(r.key for r in planned if r.needs_refresh), sep="\n")
            return
        if extractor is update.extract and update.missing_tools():
            sys.exit("not installed: " + ", ".join(update.missing_tools()))
        manifest = ingest.load_manifest(path)
        update.apply(planned, manifest, path, lambda url, to: fetch(url, to, args.max_retries), extractor, args.jobs, args.extract_jobs)
        try:
            update.refresh_base(root, manifest, args.force, lambda url: head(url, args.max_retries), lambda url, to: fetch(url, to, args.max_retries))
        finally:
            ingest.save_manifest(path, manifest)
    args.water, args.regions = str(update.base_shp(root)), [r.shp for r in selected if Path(r.shp).exists()]
    args.output = args.output or str(root / "corrected-water-polygons.shp")
    args.patches_output = None if args.no_patches else args.patches_output or str(root / "patches.shp")
    run_merge(spark, args)


def run_diff(spark: SparkSession, args: argparse.Namespace) -> None:
    """``clusters.csv`` in the output folder: centre, area and rows of each cluster, largest first."""
    register(spark)
    found = qa.deltas(load(spark, args.revised), load(spark, args.reference), args.bbox)
    found = scratch.materialize(found, "deltas")
    out = qa.atlas(found, qa.clusters(found, *qa.widened(args.cluster_buffer_km)), args.min_delta_km2, args.most or None)
    out.write.mode("overwrite").csv(f"{args.output.rstrip('/')}/clusters.csv", header=True)


def handler(layers: dict[str, DataFrame], most: int, divisor: float) -> type[BaseHTTPRequestHandler]:
    """``/api/<layer>?bbox=x0,y0,x1,y1[&limit=n]``."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            url = urlparse(self.path)
            query, name = parse_qs(url.query), url.path.removeprefix("/api/")
            if url.path in ("/", "/index.html"):
                return self._send(200, json.dumps({"layers": sorted(layers)}).encode())
            if not url.path.startswith("/api/") or name not in layers:
                return self._send(404, b"{}")
            try:
                box = qa.parse_bbox(query.get("bbox", [""])[0])
                limit = int(query.get("limit", [most])[0])
            except ValueError as e:
                return self._send(400, json.dumps({"error": str(e)}).encode())
            rows = qa.simplified(qa.viewport(layers[name], box, limit), box, divisor)
            self._send(200, qa.collection(qa.features(rows, color=name == "patches")).encode())

        def _send(self, code: int, body: bytes) -> None:
            self.send_response(code)
            for k, v in {"Content-Type": "application/json", "Content-Length": str(len(body)), "Access-Control-Allow-Origin": "*", "Cache-Control": "no-store"}.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            LOG.debug(*args)

    return Handler


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("littoral").getOrCreate()
    if args.command == "merge":
        run_merge(spark, args)
    elif args.command == "plan":
        for r in refresh.plan(states(spark, args)).collect():
            print(r.key, r.rule, r.needs_refresh, sep="\t")
    elif args.command == "update":
        run_update(spark, args)
    elif args.command == "diff":
        run_diff(spark, args)
    else:
        register(spark)
        layers = {k: load(spark, p).cache() for k, p in (("patches", args.patches), ("coastline", args.coastline)) if p}
        ThreadingHTTPServer((args.host, args.port), handler(layers, args.max_features, args.simplify_divisor)).serve_forever()


if __name__ == "__main__":
    main()
