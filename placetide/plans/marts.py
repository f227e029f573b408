"""The five wide marts and the staging projections they read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placetide.functions.geo import OUTLINE, read_outline
from placetide.functions.numeric import per_unit, share_sql
from placetide.schemas import BASE_MEASURES, FLOW_GOLD, LEVEL_CODES, MEASURES, RATES
from placetide.sources import storage


def staging_places(gold: DataFrame, level: str) -> DataFrame:
    """Gold columns that exist at the level, nothing else."""
    return gold.select(
        "geography_id", "survey_year", "geography_name", *LEVEL_CODES[level], *MEASURES, "ALAND", "AWATER", "geometry_wkt", *OUTLINE
    )


def staging_flows(gold: DataFrame) -> DataFrame:
    return gold.select(*FLOW_GOLD.fieldNames())


def socioeconomic_mart(gold: DataFrame, level: str) -> DataFrame:
    """One row per place and year: base measures, the twelve rates, geometry.

    Only the state mart carries centroids, as gold stores them; a geometry that could not be read
    raises there.
    """
    places = staging_places(gold, level)
    centre = ("centroid_lat", "centroid_lon") if level == "states" else ()
    return places.select(
        "geography_id",
        "survey_year",
        "geography_name",
        *LEVEL_CODES[level],
        *BASE_MEASURES,
        *(F.expr(f"{share_sql(' + '.join(parts), whole)} AS {name}") for name, (parts, whole) in RATES.items()),
        "geometry_wkt",
        "ALAND",
        "AWATER",
        *(read_outline(places, c).alias(c) for c in centre),
    )


# Profile columns each flow mart takes for both ends: mart column -> output suffix.
FLOW_CONTEXT = {
    "states": {
        "geography_name": "state_name",
        "total_population": "total_population",
        "median_household_income": "median_income",
        "poverty_rate": "poverty_rate",
        "remote_work_rate": "remote_work_rate",
        "centroid_lat": "lat",
        "centroid_lon": "lon",
    },
    "counties": {
        "geography_name": "county_name",
        "state_fips": "state_fips",
        "total_population": "total_population",
        "median_household_income": "median_income",
        "poverty_rate": "poverty_rate",
    },
}


def migrants(flows: DataFrame) -> DataFrame:
    return flows.filter(~F.col("is_non_migrant"))


def flow_mart(gold_flows: DataFrame, profile: DataFrame, level: str) -> DataFrame:
    """Migrant flows with the profile of both ends; a flow without a profile keeps NULLs.

    The profile is cut to the needed columns first. Spark's own size check picks the join, and
    AQE splits a hot origin or destination.
    """
    context = FLOW_CONTEXT[level]

    def end(role: str) -> DataFrame:
        return profile.select(
            F.col("geography_id").alias(f"{role}_geography_id"),
            "survey_year",
            *(F.col(c).alias(f"{role}_{name}") for c, name in context.items()),
        )

    joined = migrants(staging_flows(gold_flows)).drop("dest_state", "dest_name")
    for role in ("origin", "dest"):
        joined = joined.join(end(role), [f"{role}_geography_id", "survey_year"], "left")
    return joined.select(
        "origin_geography_id",
        "dest_geography_id",
        "survey_year",
        "households",
        "individuals",
        "agi",
        "is_non_migrant",
        *(f"origin_{name}" for name in context.values()),
        *(f"dest_{name}" for name in context.values()),
        (F.col("dest_median_income") - F.col("origin_median_income")).alias("income_differential"),
        per_unit("agi", "households").alias("agi_per_household"),
    )


def colocated_profile(flows: DataFrame, profile: DataFrame, level: str, role: str = "origin") -> DataFrame:
    """Flows with the profile of one end, joined bucket by bucket.

    For flows bucketed by that end's place and a profile table bucketed alike by
    ``geography_id``: neither side is shuffled. The join is by the place alone, which is what the
    buckets are by; a place's years (one row each, so a few dozen) are gathered first and the
    flow takes its own. A flow without a profile keeps NULLs; several profiles of one place and
    year give several rows, as in any join.
    """
    end = f"{role}_geography_id"
    names = {c: f"{role}_{name}" for c, name in FLOW_CONTEXT[level].items()}
    one = F.struct("survey_year", *(F.col(c).alias(name) for c, name in names.items()))
    places = profile.groupBy(F.col("geography_id").alias(end)).agg(F.collect_list(one).alias("_years"))
    # Merged even where the profile is small: sending it to all tasks would be a shuffle of its own.
    joined = flows.join(places.hint("merge"), end, "left")
    year = F.col("survey_year")
    own = joined.withColumn("_own", F.explode_outer(F.filter("_years", lambda p: p["survey_year"] == year)))
    return own.select(*flows.columns, *(F.col(f"_own.{name}") for name in names.values()))


def flows_with_origin(spark: SparkSession, flow_table: str, place_table: str, level: str) -> DataFrame:
    """Migrant flows of a stored table with the profile of their origin.

    Two tables with as many buckets by place are joined without a shuffle, unless one bucket is
    far above the others (a hot origin): a bucket is one task, so such tables and all others go
    by an ordinary join, whose hot keys adaptive execution splits.
    """
    flows = migrants(staging_flows(spark.table(flow_table))).drop("dest_state", "dest_name")
    profile = spark.table(place_table)
    by_flow, by_place = (storage.buckets_of(spark, t) for t in (flow_table, place_table))
    alike = by_flow and by_place and by_flow[0] == ["origin_geography_id"] and by_place == (["geography_id"], by_flow[1])
    if alike and storage.even_buckets(spark, flow_table):
        return colocated_profile(flows, profile, level)
    names = {c: f"origin_{name}" for c, name in FLOW_CONTEXT[level].items()}
    end = profile.select(F.col("geography_id").alias("origin_geography_id"), "survey_year", *(F.col(c).alias(n) for c, n in names.items()))
    return flows.join(end, ["origin_geography_id", "survey_year"], "left").select(*flows.columns, *names.values())


# Bucket column of each bucketed mart; the state profile is partitioned only.
MART_BUCKETS = {
    "mart_socioeconomic_counties": "state_fips",
    "mart_socioeconomic_tracts": "state_fips",
    "mart_migration_flows_states": "origin_geography_id",
    "mart_migration_flows_counties": "origin_state_fips",
}
