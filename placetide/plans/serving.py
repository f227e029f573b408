"""Map-layer and flow queries: lazy DataFrames over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placetide.functions.keys import clamp_flow_year
from placetide.operators.scale import colour_layer, require_metric
from placetide.schemas import BASE_MEASURES, LEVEL_CODES, METRICS, RATES
from placetide.sources import storage

DEFAULT_YEAR = 2024
DEFAULT_FLOW_YEAR = 2023
DEFAULT_METRIC = "median_household_income"
MIN_HOUSEHOLDS = 1000
TOP_FLOWS = 200


def metric_list(spark: SparkSession) -> DataFrame:
    """The listed metrics with label, description and format."""
    rows = [(k, m["label"], m["description"], m["format"]) for k, m in METRICS.items()]
    return spark.createDataFrame(rows, "metric string, label string, description string, format string")


def layer_columns(level: str) -> list[str]:
    extra = ["centroid_lat", "centroid_lon"] if level == "states" else []
    return [
        "geography_id", "geography_name", *LEVEL_CODES[level], "survey_year", *BASE_MEASURES, *RATES, *extra, "geometry_wkt",
    ]


def layer(
    mart: DataFrame,
    level: str,
    metric: str = DEFAULT_METRIC,
    year: int = DEFAULT_YEAR,
    state_fips: str | None = None,
    county_fips: str | None = None,
) -> DataFrame:
    """Coloured rows of one year; counties and tracts need a state, tracts may add a county.

    The filters are plain column predicates, so they prune partitions and buckets.
    """
    require_metric(metric)
    if level != "states" and not state_fips:
        raise ValueError("state_fips is required below state level")
    rows = mart.select(*layer_columns(level)).filter(F.col("survey_year") == year)
    if level != "states":
        rows = rows.filter(F.col("state_fips") == str(state_fips).zfill(2))
    if level == "tracts" and county_fips:
        rows = rows.filter(F.col("county_fips") == str(county_fips).zfill(3))
    return colour_layer(rows, metric)


FLOW_COLUMNS = (
    "origin_geography_id", "dest_geography_id", "survey_year", "households", "individuals", "agi",
    "is_non_migrant", "origin_state_name", "origin_median_income", "origin_poverty_rate",
    "dest_state_name", "dest_median_income", "dest_poverty_rate", "income_differential",
    "agi_per_household", "origin_lat", "origin_lon", "dest_lat", "dest_lon",
)


def flows(
    mart: DataFrame,
    year: int = DEFAULT_FLOW_YEAR,
    state_fips: str | None = None,
    min_households: int = MIN_HOUSEHOLDS,
    last_year: int | None = None,
) -> DataFrame:
    """Migrant flows of a year, largest first: all that touch one state, else the top 200.

    Ties are broken by origin and destination so the cut is repeatable; the national list
    is a top-k, never a full sort.
    """
    wanted = clamp_flow_year(year, last_year) if last_year else clamp_flow_year(year)
    rows = mart.select(*FLOW_COLUMNS).filter(
        (F.col("survey_year") == wanted) & (F.col("households") >= min_households) & ~F.col("is_non_migrant")
    )
    order = (F.desc("households"), F.asc("origin_geography_id"), F.asc("dest_geography_id"))
    if state_fips:
        code = str(state_fips).zfill(2)
        either = (F.col("origin_geography_id") == code) | (F.col("dest_geography_id") == code)
        return rows.filter(either).orderBy(*order)
    return rows.orderBy(*order).limit(TOP_FLOWS)


def years_available(gold: DataFrame) -> DataFrame:
    """Years of any frame, from its rows."""
    return gold.select("survey_year").distinct().orderBy("survey_year")


def years_held(spark: SparkSession, table: str) -> DataFrame:
    """Years of a stored table, from its partition list where it is partitioned by year."""
    return storage.partition_keys(spark, table, ["survey_year"]).orderBy("survey_year")
