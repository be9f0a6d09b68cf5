"""Column expressions on polygons: envelopes, caps, clips, colours, GeoJSON."""

from __future__ import annotations

import struct
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..kernel import st

# Kilometres of a degree of latitude, the least cosine, saturation and lightness of colours.
KM_PER_DEGREE = 111.0
LEAST_COS = 0.01
LIGHTNESS, SATURATION = 0.55, 0.7

ENVELOPE = ("x0", "y0", "x1", "y1")


def polygon_wkb(rings: Sequence[Sequence[tuple[float, float]]]) -> bytes:
    """Little-endian WKB of a polygon; open rings are closed."""
    out = [struct.pack("<BII", 1, 3, len(rings))]
    for ring in rings:
        ring = list(ring)
        if ring and ring[0] != ring[-1]:
            ring.append(ring[0])
        out.append(struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", *p) for p in ring))
    return b"".join(out)


def envelope(geom: str | Column = "geom") -> list[Column]:
    """``x0, y0, x1, y1`` of a geometry."""
    b = st("st_bounds", geom)
    return [F.element_at(b, k + 1).alias(c) for k, c in enumerate(ENVELOPE)]


def cap_box(km: float, x0: Column, y0: Column, x1: Column, y1: Column) -> list[Column]:
    """The envelope widened by ``km``: latitude stays within the poles, longitude is not wrapped."""
    dlat = km / KM_PER_DEGREE
    dlon = F.lit(km) / (F.lit(KM_PER_DEGREE) * F.greatest(F.lit(LEAST_COS), F.cos(F.radians((y0 + y1) / 2))))
    return [(x0 - dlon).alias("cx0"), F.greatest(F.lit(-90.0), y0 - dlat).alias("cy0"), (x1 + dlon).alias("cx1"), F.least(F.lit(90.0), y1 + dlat).alias("cy1")]


def covered_by(inner: Sequence[str], outer: Sequence[str]) -> Column:
    """Whether an envelope lies within a box, borders included."""
    ix0, iy0, ix1, iy1 = map(F.col, inner)
    ox0, oy0, ox1, oy1 = map(F.col, outer)
    return (ix0 >= ox0) & (iy0 >= oy0) & (ix1 <= ox1) & (iy1 <= oy1)


def meets(a: Sequence[str], b: Sequence[str]) -> Column:
    """Whether two envelopes meet, borders included."""
    ax0, ay0, ax1, ay1 = map(F.col, a)
    bx0, by0, bx1, by1 = map(F.col, b)
    return (ax0 <= bx1) & (ax1 >= bx0) & (ay0 <= by1) & (ay1 >= by0)


def clipped_pieces(geom: str, env: Sequence[str], cap: Sequence[str]) -> Column:
    """The polygons of ``geom`` within the cap; ``geom`` as it is where its envelope lies in the cap."""
    return F.when(covered_by(env, cap), F.array(F.col(geom))).otherwise(st("st_clip", geom, *cap))


def hex_color(fid: Column) -> Column:
    """A stable colour of a feature: its hue by its id."""
    hue = F.pmod(fid, F.lit(360)) / F.lit(360.0)
    m2 = LIGHTNESS + SATURATION - LIGHTNESS * SATURATION
    m1 = 2 * LIGHTNESS - m2

    def part(shift: float) -> Column:
        h = F.pmod(hue + shift, F.lit(1.0))
        value = F.when(h < 1 / 6, m1 + (m2 - m1) * h * 6.0).when(h < 0.5, m2).when(h < 2 / 3, m1 + (m2 - m1) * (2 / 3 - h) * 6.0).otherwise(m1)
        return F.floor(value * 255).cast("int")

    return F.format_string("#%02x%02x%02x", part(1 / 3), part(0.0), part(-1 / 3))


def feature_json(fid: str, geom: str, fields: Sequence[str], color: bool = False) -> Column:
    """A GeoJSON feature: ``id``, ``geometry`` and ``properties`` of the id, six fields at most, and the colour."""
    own = [F.col(fid).alias("_fid"), *(F.col(f"`{c}`") for c in list(fields)[:6])]
    if color:
        own.append(hex_color(F.col(fid)).alias("_color"))
    return F.concat(
        F.lit('{"type":"Feature","id":'), F.col(fid).cast("string"), F.lit(',"geometry":'), st("st_asgeojson", geom), F.lit(',"properties":'), F.to_json(F.struct(*own), {"ignoreNullFields": "false"}), F.lit("}")
    )


def simplify_tolerance(x0: Column, y0: Column, x1: Column, y1: Column, divisor: float) -> Column:
    """The larger side of a viewport by the divisor."""
    return F.greatest(x1 - x0, y1 - y0) / divisor
