"""Bronze to silver to gold as lazy transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetide.functions.geo import OUTLINE, with_outline
from placetide.functions.keys import county_code, geography_id, state_code, typed_measures
from placetide.schemas import (
    AGGREGATE_CODES,
    FLOW_SILVER,
    MEASURES,
    SUPPRESSED_TEXT,
    SURVEY_VARIABLES,
)


def rename_variables(df: DataFrame) -> DataFrame:
    """Survey variable codes to column names; unknown columns pass through."""
    return df.withColumnsRenamed(SURVEY_VARIABLES)


def _or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string").alias(name)


def survey_silver(
    bronze: DataFrame, level: str, lenient: bool = False, missing_codes: tuple[int, ...] = ()
) -> DataFrame:
    """Typed survey rows with padded codes and the place id of the level."""
    return bronze.select(
        F.col("NAME").alias("geography_name"),
        state_code("state").alias("state_fips"),
        county_code(_or_null(bronze, "county")).alias("county_fips"),
        _or_null(bronze, "tract").alias("tract_fips"),
        geography_id(level).alias("geography_id"),
        F.col("survey_year").cast("int").alias("survey_year"),
        *typed_measures(lenient, missing_codes),
    )


# Boundary columns: source name -> silver name.
BOUNDARY_NAMES = {
    "GEOID": "geography_id",
    "survey_year": "survey_year",
    "NAME": "geography_name",
    "STATEFP": "state_fips",
    "COUNTYFP": "county_fips",
    "TRACTCE": "tract_fips",
    "NAMELSAD": "namelsad",
    "MTFCC": "mtfcc",
    "FUNCSTAT": "funcstat",
    "ALAND": "ALAND",
    "AWATER": "AWATER",
    "INTPTLAT": "intptlat",
    "INTPTLON": "intptlon",
    "geometry_wkt": "geometry_wkt",
}


def boundary_silver(bronze: DataFrame) -> DataFrame:
    """Boundary rows under their silver names, values unchanged, with their outlines' boxes,
    centres and validity: the only place where the text is parsed for them."""
    named = bronze.select(*(F.col(old).alias(new) for old, new in BOUNDARY_NAMES.items()))
    return with_outline(named.withColumn("survey_year", F.col("survey_year").cast("int")))


def real_flows(bronze: DataFrame) -> DataFrame:
    """Drop total rows and withheld flows.

    The counts are compared as text, before any cast; a NULL code or count drops the row.
    """
    is_total = F.col("y2_statefips").cast("int").isin(*AGGREGATE_CODES)
    return bronze.filter(~is_total & (F.col("n1") != SUPPRESSED_TEXT) & (F.col("n2") != SUPPRESSED_TEXT))


def flow_silver(bronze: DataFrame, level: str) -> DataFrame:
    """Typed origin-destination rows at state or county level."""
    county = level == "counties"
    ends = "counties" if county else "states"
    typed = real_flows(bronze).select(
        geography_id(ends, "y1_statefips", "y1_countyfips").alias("origin_geography_id"),
        geography_id(ends, "y2_statefips", "y2_countyfips").alias("dest_geography_id"),
        F.col("y2_state").alias("dest_state"),
        F.col("y2_countyname" if county else "y2_state_name").alias("dest_name"),
        F.col("n1").cast("bigint").alias("households"),
        F.col("n2").cast("bigint").alias("individuals"),
        F.col("agi").cast("bigint").alias("agi"),
        F.col("survey_year").cast("int").alias("survey_year"),
    )
    return typed.select(*FLOW_SILVER.fieldNames())


def place_gold(survey: DataFrame, boundary: DataFrame) -> DataFrame:
    """Survey rows with their boundary; places found on one side only drop out.

    An equi-join on the stored key and year. Always merged: Spark takes the size of derived or well
    compressed outlines from their files, and would gather millions of them on the driver to send
    them to all tasks. AQE splits a skewed key.
    """
    shapes = boundary.select("geography_id", "survey_year", "ALAND", "AWATER", "geometry_wkt", *OUTLINE)
    return survey.join(shapes.hint("merge"), ["geography_id", "survey_year"], "inner").select(
        "geography_id",
        "survey_year",
        "geography_name",
        "state_fips",
        "county_fips",
        "tract_fips",
        *MEASURES,
        "ALAND",
        "AWATER",
        "geometry_wkt",
        *OUTLINE,
    )


def flag_non_migrants(flows: DataFrame) -> DataFrame:
    """``is_non_migrant``: origin equals destination; a NULL end gives false."""
    same = F.col("origin_geography_id") == F.col("dest_geography_id")
    return flows.withColumn("is_non_migrant", F.when(same, True).otherwise(False))


flow_gold = flag_non_migrants
