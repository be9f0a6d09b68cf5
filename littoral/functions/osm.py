"""Filters of tagged features, by columns ``otype`` (n, w, r), ``nat`` (the natural tag), ``waterway`` and ``water``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The tags that make a feature water, by its type, and the kinds of water left out.
WAY_NATURAL = ("water", "shoal")
RELATION_NATURAL = ("water", "waterway", "shoal")
RIVERBANK = "riverbank"
LEFT_OUT = ("stream", "canal", "ditch", "drain")


def is_water(otype: str = "otype", nat: str = "nat", waterway: str = "waterway") -> Column:
    kind, natural = F.col(otype), F.col(nat)
    hit = ((kind == "w") & natural.isin(*WAY_NATURAL)) | ((kind == "r") & natural.isin(*RELATION_NATURAL)) | (kind.isin("w", "r") & (F.col(waterway) == RIVERBANK))
    return F.coalesce(hit, F.lit(False))


def is_area_water(water: str = "water") -> Column:
    """Not one of the kinds left out; features without the tag stay."""
    return F.col(water).isNull() | ~F.col(water).isin(*LEFT_OUT)


def laundered(name: str) -> str:
    """An attribute name of a tag."""
    return re.sub(r"[^0-9A-Za-z_]", "_", name)


def water_features(features: DataFrame) -> DataFrame:
    return features.filter(is_water() & is_area_water())


def select_regions(regions: DataFrame, wanted: list[str] | None = None, name: str = "region", order: str = "ord") -> DataFrame:
    """The wanted regions (all, if none are named) in the order of the table."""
    return (regions if wanted is None else regions.filter(F.col(name).isin(*wanted))).orderBy(order)
