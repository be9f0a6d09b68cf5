"""Which regions are fetched again: decisions over a manifest, as columns.

A state row has ``force, head_ok, r_etag, r_lm, m_etag, m_lm, have_shp, have_pbf,
shp_age_days, min_age``: what the server says now (``r_``), what the manifest
says (``m_``), and what is on disk. Planning is pure; ``deletes_cache`` says what
the applying step has to remove.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Backoff in seconds: first, most.
FIRST_BACKOFF, MOST_BACKOFF = 5, 120


def metadata_matches(r_etag: str = "r_etag", r_lm: str = "r_lm", m_etag: str = "m_etag", m_lm: str = "m_lm") -> Column:
    """Equal and not empty, the tag or the date; dates are compared as they are written."""
    same = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit("")) == F.col(b), F.lit(False))
    return same(r_etag, m_etag) | same(r_lm, m_lm)


def rule() -> Column:
    """The number of the first rule that holds, 1 to 6."""
    match = metadata_matches()
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    age = F.coalesce(F.col("shp_age_days").cast("double"), F.lit(float("inf")))
    return (
        F.when(yes("force"), 1)
        .when(~yes("head_ok"), 2)
        .when(yes("have_shp") & match, 3)
        .when(yes("have_shp") & (F.col("min_age") > 0) & (age < F.col("min_age")), 4)
        .when(yes("have_pbf") & match & ~yes("have_shp"), 5)
        .otherwise(6)
    )


def plan(states: DataFrame) -> DataFrame:
    """``states`` with ``rule, needs_refresh, records_metadata, deletes_cache``."""
    ruled = states.withColumn("rule", rule())
    return ruled.withColumns(
        {
            "needs_refresh": F.col("rule").isin(1, 5, 6),
            "records_metadata": F.col("rule").isin(3, 5, 6) | ((F.col("rule") == 1) & F.coalesce("head_ok", F.lit(False))),
            "deletes_cache": F.col("rule").isin(1, 6),
        }
    )


def counts(planned: DataFrame) -> DataFrame:
    return planned.agg(F.count_if("needs_refresh").alias("to_refresh"), F.count_if(~F.col("needs_refresh")).alias("up_to_date"))


def recorded(manifest: DataFrame, fresh: DataFrame) -> DataFrame:
    """The manifest with new entries in place of old ones of the same key; entries without metadata change nothing."""
    real = fresh.filter(F.col("etag").isNotNull() | F.col("last_modified").isNotNull())
    return manifest.join(real, "key", "left_anti").unionByName(real)


def missing(selected: DataFrame, present: DataFrame, key: str = "region") -> DataFrame:
    """Selected regions without their file."""
    return selected.join(present.select(key), key, "left_anti")


def backoff(attempt: Column) -> Column:
    """Seconds before the next attempt, without jitter."""
    return F.least(F.lit(FIRST_BACKOFF) * F.pow(F.lit(2.0), attempt - 1), F.lit(float(MOST_BACKOFF)))


def region_paths(regions: DataFrame, base_url: str, root: str) -> DataFrame:
    """``key, url, pbf, shp`` of each region, by ``region`` and its parent ``sub_region`` (may be empty)."""
    parent = F.when(F.coalesce("sub_region", F.lit("")) != "", F.col("sub_region"))
    return regions.select(
        "*",
        F.concat_ws("/", parent, "region").alias("key"),
        F.concat_ws("/", F.lit(base_url), parent, F.concat("region", F.lit("-latest.osm.pbf"))).alias("url"),
        F.concat_ws("/", F.lit(root), F.lit("pbf"), parent, F.concat("region", F.lit(".osm.pbf"))).alias("pbf"),
        F.concat_ws("/", F.lit(root), F.lit("shapefiles"), parent, "region", F.lit("water.shp")).alias("shp"),
    )
