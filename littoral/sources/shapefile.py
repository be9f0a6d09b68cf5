"""Polygon shapefiles as a Spark data source, read in parallel by record ranges, and as a single-file sink.

``spark.read.format("shapefile")`` gives ``fid, part, geom, x0, y0, x1, y1``:
``fid`` is the record's number, ``geom`` WKB. Records of other types (Z and M
ones too) and records without points are skipped; each task warns of those it
skipped, and ``skipped`` counts them by type. Options:

* ``rings``: ``split`` (default) makes a polygon of each outer ring (clockwise)
  with its holes, ``part`` numbering them; ``compat`` takes the first ring as the
  outer one and all others as holes.
* ``bbox``: ``x0,y0,x1,y1``; records whose envelope lies outside are not decoded.
  ``clipped`` also cuts to it.
* ``records``: records of a partition.

Writing makes ``.shp``, ``.shx`` and ``.dbf`` (one field, ``FID``: the number in
the file) and takes all rows in one task, as the format has one file: it is for
handing results to other programs. Tables are kept as Parquet.
"""

from __future__ import annotations

import io
import logging
import struct
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..functions.geo import ENVELOPE, covered_by
from ..kernel import register, st

SCHEMA = "fid long, part int, geom binary, x0 double, y0 double, x1 double, y1 double"
POLYGON, FILE_CODE = 5, 9994


class BadShapefile(ValueError):
    pass


def _open(path: str):
    fs, name = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    try:
        return fs, name, fs.open_input_file(name)
    except (FileNotFoundError, OSError) as e:
        raise BadShapefile(f"cannot open {path}") from e


def _index(path: str) -> np.ndarray:
    """Offset and length in bytes of each record."""
    *_, source = _open(path[:-4] + ".shx")
    with source:
        raw = source.read()
    if len(raw) < 100 or struct.unpack_from(">i", raw)[0] != FILE_CODE:
        raise BadShapefile(f"{path}: no shape index")
    return np.frombuffer(raw, ">i4", (len(raw) - 100) // 8 * 2, 100).astype(np.int64).reshape(-1, 2) * 2


def _ring_area(ring: np.ndarray) -> float:
    """Signed: positive where the ring runs counter-clockwise."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1])) / 2


def _closed(ring: np.ndarray) -> np.ndarray:
    return ring if (ring[0] == ring[-1]).all() else np.vstack([ring, ring[:1]])


def _holds(ring: np.ndarray, point: np.ndarray) -> bool:
    """Whether a ring runs around a point, by crossings."""
    (x, y), a, b = point, ring[:-1], ring[1:]
    cross = (a[:, 1] > y) != (b[:, 1] > y)
    a, b = a[cross], b[cross]
    return bool(np.count_nonzero(a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1]) > x) % 2)


def decode(content: bytes, rings: str = "split") -> list[list[np.ndarray]] | None:
    """The polygons of a record, each a list of rings, outer first; None for a record that is skipped."""
    if len(content) < 4 or struct.unpack_from("<i", content)[0] != POLYGON:
        return None
    n_parts, n_points = struct.unpack_from("<ii", content, 36)
    if n_points == 0:
        return None
    if n_parts <= 0 or len(content) < 44 + 4 * n_parts + 16 * n_points:
        raise BadShapefile("a record without parts or cut short")
    starts = np.frombuffer(content, "<i4", n_parts, 44)
    if starts[0] != 0:
        raise BadShapefile("the first part does not start at the first point")
    points = np.frombuffer(content, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2)
    parts = [_closed(p) for p in np.split(points, starts[1:]) if len(p)]
    if rings == "compat" or len(parts) == 1:
        return [parts]
    areas = [_ring_area(p) for p in parts]
    # Where no ring is clockwise the first one is taken as the outer one.
    outer = [k for k, a in enumerate(areas) if a < 0] or [0]
    out = {k: [parts[k]] for k in outer}
    for k, p in enumerate(parts):
        if k not in out:
            around = [o for o in outer if _holds(parts[o], p[0])] or outer[:1]
            out[min(around, key=lambda o: abs(areas[o]))].append(p)
    return list(out.values())


def _kind(content: bytes) -> int:
    """The type of a record; -1 for one too short to have one."""
    return struct.unpack_from("<i", content)[0] if len(content) >= 4 else -1


def to_wkb(rings: list[np.ndarray]) -> bytes:
    out = [struct.pack("<BII", 1, 3, len(rings))]
    for r in rings:
        out += [struct.pack("<I", len(r)), np.ascontiguousarray(r, "<f8").tobytes()]
    return b"".join(out)


def from_wkb(wkb: bytes) -> list[np.ndarray]:
    """The rings of a polygon."""
    order = "<" if wkb[0] == 1 else ">"
    kind, n = struct.unpack_from(order + "II", wkb, 1)
    if kind != 3:
        raise ValueError("not a polygon")
    out, at = [], 9
    for _ in range(n):
        (k,) = struct.unpack_from(order + "I", wkb, at)
        out.append(np.frombuffer(wkb, order + "f8", 2 * k, at + 4).reshape(-1, 2).astype("<f8"))
        at += 4 + 16 * k
    return out


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo, self.hi = lo, hi


class ShapefileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.rings = options["path"], options.get("rings", "split")
        if self.rings not in ("split", "compat"):
            raise ValueError("rings is split or compat")
        self.bbox = tuple(map(float, options["bbox"].split(","))) if options.get("bbox") else None
        self.step = int(options.get("records", 20_000))

    def partitions(self) -> list[InputPartition]:
        n = len(_index(self.path))
        return [_Range(lo, min(n, lo + self.step)) for lo in range(0, max(n, 1), self.step)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        index = _index(self.path)[partition.lo : partition.hi]
        *_, source = _open(self.path)
        rows: list[tuple] = []
        left: Counter = Counter()
        with source:
            for fid, (at, size) in enumerate(index.tolist(), partition.lo):
                source.seek(at + 8)
                content = source.read(size)
                if len(content) < size:
                    raise BadShapefile(f"record {fid} cannot be read")
                if self.bbox and len(content) >= 36:
                    x0, y0, x1, y1 = struct.unpack_from("<4d", content, 4)
                    if x0 > self.bbox[2] or x1 < self.bbox[0] or y0 > self.bbox[3] or y1 < self.bbox[1]:
                        continue
                polygons = decode(content, self.rings)
                if polygons is None:
                    left[_kind(content)] += 1
                for part, rings in enumerate(polygons or []):
                    low, high = rings[0].min(axis=0), rings[0].max(axis=0)
                    rows.append((fid, part, to_wkb(rings), *low, *high))
                if len(rows) >= 2000:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)
        if left:
            logging.getLogger(__name__).warning("%s, records %d to %d: skipped %d (number by type: %s)", self.path, partition.lo, partition.lo + len(index) - 1, left.total(), dict(left))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.binary(), *[pa.float64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["fid", "part", "geom", *ENVELOPE])


# Fixed value: the coordinate system of the layers.
WGS84 = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'


class _Written(WriterCommitMessage):
    def __init__(self, n: int, names: dict[str, str]):
        self.n, self.names = n, names


class ShapefileWriter(DataSourceWriter):
    """Each attempt of a task writes files of its own; only the commit puts them in place, also where there are no rows."""

    def __init__(self, options: dict, schema):
        self.path, self.at = options["path"], schema.fieldNames().index("geom")

    def write(self, rows) -> WriterCommitMessage:
        shapes, index, bounds, n = io.BytesIO(), io.BytesIO(), [], 0
        for row in rows:
            rings = from_wkb(bytes(row[self.at]))
            # The format's outer rings run clockwise, its holes the other way.
            rings = [r[::-1] if (_ring_area(r) > 0) == (k == 0) else r for k, r in enumerate(rings)]
            points = np.vstack(rings)
            starts = np.cumsum([0, *map(len, rings[:-1])])
            low, high = points.min(axis=0), points.max(axis=0)
            bounds.append((*low, *high))
            content = struct.pack("<i4dii", POLYGON, *low, *high, len(rings), len(points)) + starts.astype("<i4").tobytes() + np.ascontiguousarray(points, "<f8").tobytes()
            index.write(struct.pack(">ii", (100 + shapes.tell()) // 2, len(content) // 2))
            shapes.write(struct.pack(">ii", n + 1, len(content) // 2) + content)
            n += 1
        return _Written(n, self._files(shapes.getvalue(), index.getvalue(), bounds) if n else {})

    def _files(self, shapes: bytes, index: bytes, bounds: list) -> dict[str, str]:
        """The parts of a shapefile, written under names of this attempt."""
        n = len(bounds)
        b = np.array(bounds) if bounds else np.zeros((1, 4))
        box = (*b[:, :2].min(axis=0), *b[:, 2:].max(axis=0))
        header = lambda size: struct.pack(">7i", FILE_CODE, 0, 0, 0, 0, 0, (100 + size) // 2) + struct.pack("<ii8d", 1000, POLYGON, *box, 0, 0, 0, 0)
        dbf = struct.pack("<B3BIHH20x", 3, 95, 7, 26, n, 65, 12) + struct.pack("<11sc4xBB14x", b"FID", b"N", 11, 0) + b"\r" + b"".join(b" %11d" % k for k in range(n)) + b"\x1a"
        names, attempt = {}, uuid.uuid4().hex
        for end, data in ((".shp", header(len(shapes)) + shapes), (".shx", header(len(index)) + index), (".dbf", dbf), (".prj", WGS84.encode())):
            fs, name = self._target(end)
            names[end] = f"{name}.{attempt}.tmp"
            with fs.open_output_stream(names[end]) as out:
                out.write(data)
        return names

    def commit(self, messages: list) -> None:
        written = [m for m in messages if m is not None and m.n]
        if len(written) > 1:
            raise ValueError("a shapefile is written by one task")
        for end, name in (written[0].names if written else self._files(b"", b"", [])).items():
            fs, target = self._target(end)
            if fs.get_file_info(target).type != pafs.FileType.NotFound:
                fs.delete_file(target)
            fs.move(name, target)

    def abort(self, messages: list) -> None:
        for m in messages:
            for end, name in (m.names if m is not None else {}).items():
                fs = self._target(end)[0]
                if fs.get_file_info(name).type != pafs.FileType.NotFound:
                    fs.delete_file(name)

    def _target(self, end: str):
        path = self.path[:-4] + end
        return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class ShapefileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ShapefileReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return ShapefileWriter(self.options, schema)


def read(spark: SparkSession, path: str, bbox: tuple[float, float, float, float] | None = None, rings: str = "split") -> DataFrame:
    spark.dataSource.register(ShapefileSource)
    reader = spark.read.format("shapefile").option("rings", rings)
    return (reader.option("bbox", ",".join(map(repr, bbox))) if bbox else reader).load(path)


def skipped(spark: SparkSession, path: str, step: int = 20_000) -> DataFrame:
    """``kind, records``: how many records of the file ``read`` skips, by their type (5: polygons without points)."""
    n = len(_index(path))

    def each(batches):
        for batch in batches:
            for lo in batch.column(0).to_pylist():
                left: Counter = Counter()
                *_, source = _open(path)
                with source:
                    for at, size in _index(path)[lo : lo + step].tolist():
                        source.seek(at + 8)
                        # Type, box, number of parts and of points.
                        head = source.read(min(size, 44))
                        if _kind(head) != POLYGON or len(head) == 44 and struct.unpack_from("<i", head, 40)[0] == 0:
                            left[_kind(head)] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(left), pa.int32()), pa.array(list(left.values()), pa.int64())], names=["kind", "records"])

    ranges = spark.range(0, n, step, max(1, -(-n // step)))
    return ranges.mapInArrow(each, "kind int, records long").groupBy("kind").agg(F.sum("records").alias("records"))


def clipped(spark: SparkSession, path: str, bbox: tuple[float, float, float, float], rings: str = "split") -> DataFrame:
    """Read and cut to a box: each polygon of what is left is a row."""
    register(spark)
    box = [F.lit(float(v)).alias(f"b{c}") for v, c in zip(bbox, ENVELOPE)]
    names = [f"b{c}" for c in ENVELOPE]
    rows = read(spark, path, bbox, rings).select("*", *box)
    pieces = F.when(covered_by(ENVELOPE, names), F.array("geom")).otherwise(st("st_clip", "geom", *names))
    cut = rows.select("fid", F.posexplode(pieces).alias("part", "geom"))
    b = st("st_bounds", "geom")
    return cut.select("*", *(F.element_at(b, k + 1).alias(c) for k, c in enumerate(ENVELOPE)))


def write(rows: DataFrame, path: str) -> None:
    """``fid, geom`` as a shapefile, in the order of ``fid``."""
    rows.sparkSession.dataSource.register(ShapefileSource)
    rows.select("fid", "geom").orderBy("fid").coalesce(1).write.format("shapefile").mode("append").save(path)
