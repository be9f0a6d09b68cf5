"""The regions whose extracts are merged, in the order of merging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import osm
from ..plans import refresh

# Regions by their parent path at the download site, in the order of merging.
EUROPE = "europe"
CANADA, US, AMERICA = "north-america/canada", "north-america/us", "north-america"
REGIONS = (
    *((r, EUROPE) for r in "albania azores belgium bulgaria croatia cyprus denmark estonia faroe-islands finland france germany greece iceland ireland-and-northern-ireland isle-of-man italy latvia lithuania malta montenegro netherlands norway poland portugal romania".split()),
    ("russia", ""),
    *((r, EUROPE) for r in "slovenia spain sweden turkey ukraine united-kingdom".split()),
    *((r, CANADA) for r in "british-columbia manitoba new-brunswick newfoundland-and-labrador northwest-territories nova-scotia nunavut ontario prince-edward-island quebec yukon".split()),
    *((r, US) for r in "alabama alaska california connecticut delaware florida georgia hawaii louisiana maine maryland massachusetts mississippi new-hampshire new-jersey new-york north-carolina oregon pennsylvania puerto-rico rhode-island south-carolina texas virginia washington".split()),
    *((r, AMERICA) for r in "greenland mexico".split()),
    *((r, "") for r in "africa antarctica asia australia-oceania central-america south-america".split()),
)

# Where extracts and the base polygons are downloaded.
EXTRACT_URL = "https://download.geofabrik.de"
BASE_URL = "https://osmdata.openstreetmap.de"


def table(spark: SparkSession) -> DataFrame:
    """``ord, region, sub_region``."""
    return spark.createDataFrame([(k, r, p) for k, (r, p) in enumerate(REGIONS)], "ord long, region string, sub_region string")


def select_paths(spark: SparkSession, wanted: list[str] | None, root: str) -> DataFrame:
    """The wanted regions in order, with ``url``, ``pbf`` and ``shp``."""
    return refresh.region_paths(osm.select_regions(table(spark), wanted), EXTRACT_URL, root)
