import pytest
from support import rows
from pyspark.sql import functions as F

from placetide.functions import keys as K
from placetide.functions.numeric import per_unit, round_half_away, share
from placetide.functions.geo import OUTLINE, with_outline
from placetide.plans import layers, marts
from placetide.schemas import BOUNDARY_SILVER, FLOW_SILVER, MEASURES, PLACE_GOLD, STATE_FIPS_CODES, SURVEY_SILVER


def survey_row(spark, **values):
    names = ["NAME", *MEASURES, "state", "county", "tract"]
    base = {m: "10" for m in MEASURES} | {"NAME": "X", "state": "6", "county": "37", "tract": "000100"} | values
    ddl = ", ".join(f"{n} string" for n in names) + ", survey_year bigint"
    return spark.createDataFrame([tuple(base[n] for n in names) + (2020,)], ddl)


def test_codes_are_padded_and_cut(spark):
    df = spark.createDataFrame([("6", "37", "1"), ("06", "037", "1"), ("123", "12345", "1"), (None, "1", "1")], "state string, county string, tract string")
    out = rows(df.select(K.geography_id("states"), K.geography_id("counties"), K.geography_id("tracts")))
    assert out == [("06", "06037", "060371"), ("06", "06037", "060371"), ("12", "12123", "121231"), (None, None, None)]
    with pytest.raises(ValueError):
        K.geography_id("cities")


def test_survey_silver_schema_and_values(spark):
    out = layers.survey_silver(survey_row(spark, median_age="38.5"), "tracts")
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in SURVEY_SILVER]
    row = out.first()
    assert (row.state_fips, row.county_fips, row.tract_fips, row.geography_id) == ("06", "037", "000100", "06037000100")
    assert row.median_age == 38.5 and row.total_population == 10 and row.survey_year == 2020


def test_state_rows_have_no_county(spark):
    out = layers.survey_silver(survey_row(spark).drop("county", "tract"), "states").first()
    assert out.county_fips is None and out.tract_fips is None and out.geography_id == "06"


@pytest.mark.parametrize("text", ["12.0", "abc", ""])
def test_malformed_number_raises_or_is_null(spark, text):
    bad = survey_row(spark, total_population=text)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        layers.survey_silver(bad, "states").collect()
    assert layers.survey_silver(bad, "states", lenient=True).first().total_population is None


def test_missing_codes_are_kept_unless_asked(spark):
    row = survey_row(spark, median_household_income="-666666666")
    assert layers.survey_silver(row, "states").first().median_household_income == -666666666
    clean = layers.survey_silver(row, "states", missing_codes=(-666666666,)).first()
    assert clean.median_household_income is None and clean.total_population == 10


FLOW_DDL = "y1_statefips string, y2_statefips string, y2_state string, y2_state_name string, n1 string, n2 string, AGI string, survey_year bigint"


def flow(spark, *specs):
    data = [(o, d, "S", "N", n1, n2, "100", 2020) for o, d, n1, n2 in specs]
    return spark.createDataFrame(data, FLOW_DDL)


def test_total_codes_are_dropped_and_99_kept(spark):
    df = flow(spark, *(("6", c, "5", "9") for c in ("57", "58", "59", "96", "97", "98", "99", "1", "06")))
    out = rows(layers.flow_silver(df, "states").select("dest_geography_id"), "dest_geography_id")
    assert out == [("01",), ("06",), ("99",)]


def test_suppression_is_a_text_comparison(spark):
    df = flow(spark, ("1", "2", "-1", "9"), ("1", "3", "9", "-1"), ("1", "4", None, "9"), ("1", None, "9", "9"), ("1", "5", " -1", "9"), ("1", "6", "9", "9"))
    out = rows(layers.real_flows(df).select("y2_statefips"), "y2_statefips")
    # ' -1' is not the marker text, so it stays; NULLs drop the row.
    assert out == [("5",), ("6",)]


def test_flow_schema(spark):
    out = layers.flow_silver(flow(spark, ("6", "1", "5", "9")), "states")
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in FLOW_SILVER]


def test_non_migrant_flag_with_null_end_is_false(spark):
    df = spark.createDataFrame([("06", "06"), ("06", "01"), (None, "06"), (None, None)], "origin_geography_id string, dest_geography_id string")
    assert [r.is_non_migrant for r in layers.flag_non_migrants(df).collect()] == [True, False, False, False]


def gold_rows(spark, *dicts):
    names = PLACE_GOLD.fieldNames()
    base = {n: None for n in names} | {m: 100 for m in MEASURES} | {"median_age": 40.0, "geography_id": "06", "survey_year": 2020, "geography_name": "X", "state_fips": "06"}
    return with_outline(spark.createDataFrame([tuple((base | d)[n] for n in names) for d in dicts], PLACE_GOLD).drop(*OUTLINE))


def test_join_drops_one_sided_rows(spark):
    survey = spark.createDataFrame([tuple({"geography_id": g, "survey_year": y}.get(f.name) for f in SURVEY_SILVER) for g, y in (("01", 2020), ("02", 2020), ("01", 2021))], SURVEY_SILVER)
    shapes = spark.createDataFrame([tuple({"geography_id": g, "survey_year": 2020, "ALAND": 5}.get(f.name) for f in BOUNDARY_SILVER) for g in ("01", "60", "66", "69", "78")], BOUNDARY_SILVER)
    out = layers.place_gold(survey, shapes)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in PLACE_GOLD]
    assert rows(out.select("geography_id", "survey_year", "ALAND")) == [("01", 2020, 5)]


def test_share_rules(spark):
    df = spark.createDataFrame([(1, 3, 1, 1), (1, 0, 1, 1), (1, None, 1, 1), (None, 3, 1, 1), (2, 3, None, 1)], "a bigint, b bigint, c bigint, d bigint")
    out = rows(df.select(share("a", "b"), share(("a", "c", "d"), "b"), per_unit("a", "b")))
    assert out == [(33.33, 100.0, 0.33), (None, None, None), (None, None, None), (None, None, None), (66.67, None, 0.67)]


def test_rounding_scales_the_binary_value(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (-0.125,), (-1.5,), (None,)], "v double")
    out = [r[0] for r in df.select(round_half_away(F.col("v"), 2)).collect()]
    # Scaled by 100, 1.005 lands below the tie and 2.675 on it; 0.125 is an exact tie.
    assert out == [1.0, 2.68, 0.13, -0.13, -1.5, None]


def test_mart_nulls_and_level_columns(spark):
    gold = gold_rows(spark, {"masters_degree": None, "total_population": 0}, {"geography_id": "01", "education_total_25y_plus": 800})
    mart = marts.socioeconomic_mart(gold, "states")
    got = {r.geography_id: r for r in mart.collect()}
    assert got["06"].bachelors_plus_rate is None and got["06"].pct_white_alone is None
    assert got["01"].bachelors_plus_rate == 50.0 and got["01"].renter_rate == 100.0
    assert "centroid_lat" in mart.columns and "county_fips" not in mart.columns
    counties = marts.socioeconomic_mart(gold, "counties").columns
    assert "centroid_lat" not in counties and "county_fips" in counties and "tract_fips" not in counties
    assert "tract_fips" in marts.socioeconomic_mart(gold, "tracts").columns


def test_flow_mart_keeps_unmatched_and_drops_non_migrants(spark):
    square = "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"
    profile = marts.socioeconomic_mart(
        gold_rows(spark, {"geography_id": "06", "geometry_wkt": square, "median_household_income": 900}, {"geography_id": "01", "geometry_wkt": square, "median_household_income": 700}), "states"
    )
    silver = spark.createDataFrame(
        [("06", "01", "S", "N", 4, 9, 10, 2020), ("06", "01", "S", "N", 0, 9, 10, 2012), ("06", "06", "S", "N", 4, 9, 10, 2020)], FLOW_SILVER
    )
    out = marts.flow_mart(layers.flow_gold(silver), profile, "states").orderBy("survey_year").collect()
    assert [(r.survey_year, r.income_differential, r.agi_per_household, r.origin_lat) for r in out] == [(2012, None, None, None), (2020, -200, 2.5, 1.0)]


def test_release_years(spark):
    days = spark.createDataFrame([("2025-11-30",), ("2025-12-01",), ("2013-01-05",), ("2026-06-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    out = rows(days.select(K.latest_survey_year("d"), K.latest_flow_year("d"), F.size(K.available_years(K.latest_survey_year("d")))))
    assert out == [(2023, 2023, 12), (2024, 2023, 13), (2011, 2012, 0), (2024, 2023, 13)]
    assert len(STATE_FIPS_CODES) == 51
    assert K.clamp_flow_year(2024) == 2023 and K.clamp_flow_year(2019) == 2019
