"""Joins of tables bucketed alike."""

import re

import pytest
from support import plan_of
from pyspark.sql import functions as F

from placetide.plans import marts
from placetide.schemas import FLOW_GOLD
from placetide.sources import storage as S

CONTEXT = ["geography_name", "state_fips", "total_population", "median_household_income", "poverty_rate"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Flows of 40 places over 3 years, one of them the origin of a third; profiles lack place 7, have
    place 8 twice, and one has no id."""
    base = tmp_path_factory.mktemp("colocated")
    flows = spark.range(3000).selectExpr(
        "CAST(IF(id % 3 = 0, 1, id % 40) AS string) AS origin_geography_id", "CAST(id AS string) AS dest_geography_id",
        "'S' AS dest_state", "'N' AS dest_name", "id AS households", "id AS individuals", "id AS agi",
        "CAST(2020 + id % 3 AS int) AS survey_year", "id % 10 = 0 AS is_non_migrant",
    ).withColumn("origin_geography_id", F.when(F.col("households") % 500 != 499, F.col("origin_geography_id")))
    flows = flows.select(*[F.col(f.name).cast(f.dataType) for f in FLOW_GOLD])
    places = spark.range(40 * 2).filter("id % 40 <> 7").selectExpr(
        "CAST(id % 40 AS string) AS geography_id", "CAST(2020 + id div 40 AS int) AS survey_year",
        *(f"CAST(id AS {'string' if c in ('geography_name', 'state_fips') else 'double'}) AS {c}" for c in CONTEXT),
    )
    twice = places.filter("geography_id = '8'").withColumn("geography_name", F.lit("again"))
    nameless = places.filter("geography_id = '9'").withColumn("geography_id", F.lit(None).cast("string"))
    places = places.unionByName(twice).unionByName(nameless)
    S.full_refresh(flows, "t_col_flows", bucket_by="origin_geography_id", buckets=8, location=f"{base}/flows")
    S.full_refresh(places, "t_col_places", bucket_by="geography_id", buckets=8, location=f"{base}/places")
    S.full_refresh(places, "t_col_plain", location=f"{base}/plain")


def bag(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_bucketed_tables_join_without_a_shuffle(spark, tables):
    near = marts.flows_with_origin(spark, "t_col_flows", "t_col_places", "counties")
    far = marts.flows_with_origin(spark, "t_col_flows", "t_col_plain", "counties")
    assert "Exchange" not in plan_of(near) and "Exchange" in plan_of(far)
    assert "SortMergeJoin" in plan_of(near)
    assert near.columns == far.columns and bag(near) == bag(far)
    found = near.groupBy().agg(F.count("*").alias("n"), F.count("origin_poverty_rate").alias("known")).first()
    doubled = spark.table("t_col_flows").filter("NOT is_non_migrant AND origin_geography_id = '8' AND survey_year < 2022").count()
    assert doubled > 0 and found["n"] == 2700 + doubled and found["known"] < found["n"]


def test_hot_bucket_goes_by_the_ordinary_join(spark, tables):
    counted = {r["bucket"]: r["n"] for r in S.bucket_rows(spark, "t_col_flows").collect()}
    assert sum(counted.values()) == 3000 and set(counted) <= set(range(8)) and max(counted.values()) > 1000
    assert S.even_buckets(spark, "t_col_flows") and not S.even_buckets(spark, "t_col_flows", rows=10, times=2)
    assert not S.even_buckets(spark, "t_col_plain")
    assert "ReadSchema: struct<>" in re.sub(r"\n", " ", plan_of(S.bucket_rows(spark, "t_col_flows")))


def test_replayed_years_keep_the_join_without_a_shuffle(spark, tables):
    again = spark.table("t_col_flows").filter("survey_year = 2021").withColumn("households", F.col("households") + 1)
    S.backfill_years(again, "t_col_flows", [2021], bucket_by="origin_geography_id")
    near = marts.flows_with_origin(spark, "t_col_flows", "t_col_places", "counties")
    assert "Exchange" not in plan_of(near)
    assert bag(near) == bag(marts.flows_with_origin(spark, "t_col_flows", "t_col_plain", "counties"))


def test_no_flows(spark, tables):
    S.create_table(spark, "t_col_none", FLOW_GOLD, bucket_by="origin_geography_id", buckets=8)
    assert S.even_buckets(spark, "t_col_none")
    assert marts.flows_with_origin(spark, "t_col_none", "t_col_places", "counties").collect() == []
