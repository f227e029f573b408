"""Refreshing stored layers: bronze folders to silver, gold and mart tables.

Each step reads stored tables and writes stored tables, so a step can be re-run on its own
and no lineage grows across steps. Marts read gold from storage, where Spark knows the real
sizes and picks the joins by them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from placetide.plans import layers, marts
from placetide.schemas import (
    BOUNDARY_BRONZE,
    BOUNDARY_SILVER,
    COUNTY_FLOW_BRONZE,
    FLOW_GOLD,
    FLOW_SILVER,
    LEVELS,
    PLACE_GOLD,
    STATE_FLOW_BRONZE,
    SURVEY_BRONZE,
    SURVEY_SILVER,
)
from placetide.sources import storage

# Years written by one backfill job.
YEAR_BATCH = 6

FLOW_LEVELS = ("states", "counties")
FLOW_STEM = {"states": "irs_state_outflows", "counties": "irs_county_outflows"}
FLOW_MART = {"states": "mart_migration_flows_states", "counties": "mart_migration_flows_counties"}


@dataclass(frozen=True)
class Layout:
    """Where the layers live: a root folder, and a prefix (say ``db.``) for table names."""

    root: str
    prefix: str = ""

    def bronze(self, source: str, level: str) -> str:
        return f"{self.root}/bronze/{source}/{level}"

    def table(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def location(self, name: str) -> str:
        return f"{self.root}/tables/{name}"


@dataclass(frozen=True)
class Source:
    """One bronze source and the silver table made of it."""

    folder: str
    level: str
    schema: T.StructType
    silver: str
    silver_schema: T.StructType
    to_silver: Callable[[DataFrame], DataFrame]


def silver_sources(levels: Sequence[str] = LEVELS, flow_levels: Sequence[str] = FLOW_LEVELS) -> list[Source]:
    flow_schema = {"states": STATE_FLOW_BRONZE, "counties": COUNTY_FLOW_BRONZE}
    out = []
    for level in levels:
        out.append(
            Source("census_acs5", level, SURVEY_BRONZE, f"silver_acs5_{level}", SURVEY_SILVER, lambda df, x=level: layers.survey_silver(df, x))
        )
        out.append(Source("tiger", level, BOUNDARY_BRONZE, f"silver_tiger_{level}", BOUNDARY_SILVER, layers.boundary_silver))
    for level in flow_levels:
        out.append(
            Source("irs", level, flow_schema[level], f"silver_{FLOW_STEM[level]}", FLOW_SILVER, lambda df, x=level: layers.flow_silver(df, x))
        )
    return out


def refresh_silver(
    spark: SparkSession, layout: Layout, sources: Sequence[Source], years: Sequence[int]
) -> dict[str, dict[int, int | None]]:
    """Replace the given years of every silver table; returns rows per table and year.

    A year that a source has not landed is left as it is and reported as None: sources end
    in different years.
    """
    written: dict[str, dict[int, int | None]] = {}
    for source in sources:
        table = layout.table(source.silver)
        storage.create_table(spark, table, source.silver_schema, location=layout.location(source.silver))
        path = layout.bronze(source.folder, source.level)
        landed = set(storage.landed_years(spark, path))
        counts: dict[int, int | None] = {y: None for y in years}
        due = [y for y in years if y in landed]
        for start in range(0, len(due), YEAR_BATCH):
            batch = due[start : start + YEAR_BATCH]
            frames = [source.to_silver(storage.read_bronze(spark, path, source.schema, y)) for y in batch]
            counts |= storage.backfill_years(reduce(DataFrame.unionByName, frames), table, batch)
        written[source.silver] = counts
    return written


def refresh_gold(
    spark: SparkSession,
    layout: Layout,
    levels: Sequence[str] = LEVELS,
    flow_levels: Sequence[str] = FLOW_LEVELS,
    years: Sequence[int] | None = None,
) -> None:
    """Rebuild gold from silver: whole tables, or only some years when given."""

    def store(name: str, df: DataFrame, schema: T.StructType) -> None:
        if years is None:
            storage.full_refresh(df, layout.table(name), location=layout.location(name))
        else:
            storage.create_table(spark, layout.table(name), schema, location=layout.location(name))
            storage.backfill_years(df, layout.table(name), years)

    for level in levels:
        survey = spark.table(layout.table(f"silver_acs5_{level}"))
        shapes = spark.table(layout.table(f"silver_tiger_{level}"))
        store(f"gold_{level}", layers.place_gold(survey, shapes), PLACE_GOLD)
    for level in flow_levels:
        flows = spark.table(layout.table(f"silver_{FLOW_STEM[level]}"))
        store(f"gold_{FLOW_STEM[level]}", layers.flow_gold(flows), FLOW_GOLD)


def staging_views(
    spark: SparkSession, layout: Layout, levels: Sequence[str] = LEVELS, flow_levels: Sequence[str] = FLOW_LEVELS
) -> dict[str, DataFrame]:
    """The staging projections over gold, also registered as session views."""
    views = {f"stg_acs_{level}": marts.staging_places(spark.table(layout.table(f"gold_{level}")), level) for level in levels}
    views |= {
        f"stg_{FLOW_STEM[level]}": marts.staging_flows(spark.table(layout.table(f"gold_{FLOW_STEM[level]}"))) for level in flow_levels
    }
    for name, df in views.items():
        storage.create_view(df, name)
    return views


def refresh_marts(
    spark: SparkSession,
    layout: Layout,
    levels: Sequence[str] = LEVELS,
    flow_levels: Sequence[str] = FLOW_LEVELS,
    years: Sequence[int] | None = None,
) -> None:
    """Rebuild the place marts, then the flow marts that read them: whole tables, or only some
    years when given. A flow joins profiles of its own year, so years are independent."""

    def store(name: str, df: DataFrame) -> None:
        table, bucket = layout.table(name), marts.MART_BUCKETS.get(name)
        if years is not None and spark.catalog.tableExists(table):
            storage.backfill_years(df, table, years, bucket_by=bucket)
        else:
            storage.full_refresh(df, table, bucket_by=bucket, location=layout.location(name))

    views = staging_views(spark, layout, levels, flow_levels)
    for level in levels:
        store(f"mart_socioeconomic_{level}", marts.socioeconomic_mart(views[f"stg_acs_{level}"], level))
    for level in flow_levels:
        profile = spark.table(layout.table(f"mart_socioeconomic_{level}"))
        store(FLOW_MART[level], marts.flow_mart(views[f"stg_{FLOW_STEM[level]}"], profile, level))


def refresh_all(
    spark: SparkSession,
    layout: Layout,
    years: Sequence[int],
    levels: Sequence[str] = LEVELS,
    flow_levels: Sequence[str] = FLOW_LEVELS,
) -> dict[str, dict[int, int | None]]:
    """New bronze years through every layer: silver by year, then gold and marts.

    Returns rows per silver table and year, None for a year that has not landed.
    """
    written = refresh_silver(spark, layout, silver_sources(levels, flow_levels), years)
    refresh_gold(spark, layout, levels, flow_levels)
    refresh_marts(spark, layout, levels, flow_levels)
    return written
