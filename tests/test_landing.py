import json

import pytest
from support import rows
from pyspark.sql import functions as F

from placetide.plans.layers import boundary_silver, survey_silver
from placetide.schemas import BOUNDARY_BRONZE, MEASURES, SURVEY_BRONZE, SURVEY_VARIABLES
from placetide.sources import landing as L


def test_header_json_file(spark, tmp_path):
    doc = [["NAME", *SURVEY_VARIABLES, "state"], ["Alabama", *["1"] * 26, "1"], ["Alaska", *[None] * 26, "2"]]
    other = [["state", "NAME", *SURVEY_VARIABLES], ["4", "Arizona", *["2"] * 26]]
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "b.json").write_text(json.dumps(other))
    (tmp_path / "empty.json").write_text(json.dumps([["NAME"]]))
    (tmp_path / "short.json").write_text(json.dumps([["NAME", "state", "B01001_001E"], ["Short", "9"]]))
    bronze = L.survey_bronze(spark, str(tmp_path), list(SURVEY_VARIABLES), 2020, "2021-12-05")
    assert bronze.columns == SURVEY_BRONZE.fieldNames()
    assert dict(bronze.dtypes) == {f.name: f.dataType.simpleString() for f in SURVEY_BRONZE}
    out = rows(bronze.select("NAME", "total_population", "state", "county", "survey_year", "ingest_date"), "NAME")
    assert out == [
        ("Alabama", "1", "1", None, 2020, "2021-12-05"),
        ("Alaska", None, "2", None, 2020, "2021-12-05"),
        ("Arizona", "2", "4", None, 2020, "2021-12-05"),
        ("Short", None, "9", None, 2020, "2021-12-05"),
    ]
    silver = survey_silver(bronze, "states")
    assert rows(silver.select("geography_id", MEASURES[0]), "geography_id") == [("01", 1), ("02", None), ("04", 2), ("09", None)]


def test_csv_stays_text_and_keeps_bad_bytes(spark, tmp_path):
    path = tmp_path / "countyoutflow1213.csv"
    path.write_bytes(b"y1_statefips,y2_countyname,n1\n01,Do\xf1a Ana,-1\n06,Plain,007\n")
    out = rows(L.flow_bronze(spark, str(path), "2020-01-01"), "y1_statefips")
    assert out == [("01", "Do�a Ana", "-1", 2013, "2020-01-01"), ("06", "Plain", "007", 2013, "2020-01-01")]


@pytest.mark.parametrize("name,year", [("stateoutflow1112.csv", 2012), ("x/countyoutflow2223.csv", 2023), ("notes.csv", None)])
def test_period_year(spark, name, year):
    assert spark.range(1).select(L.period_year(F.lit(name))).first()[0] == year


def test_object_normaliser(spark):
    df = spark.createDataFrame([(1, 2.5, True, "a"), (2, float("nan"), None, None)], "i int, v double, b boolean, s string")
    assert rows(L.normalise_objects(df, ["v", "b"]), "i") == [(1, "2.5", "true", "a"), (2, None, None, None)]
    # Numbers keep their type unless named.
    assert dict(L.normalise_objects(df).dtypes) == {"i": "int", "v": "double", "b": "string", "s": "string"}


def test_boundary_file(spark, tmp_path):
    path = str(tmp_path / "b")
    df = spark.createDataFrame([("06", "06", "California", 5, "POLYGON EMPTY")], "STATEFP string, GEOID string, name string, ALAND int, geometry_wkt string")
    df.write.parquet(path)
    bronze = L.read_boundaries(spark, path, 2020, "2021-01-01")
    assert bronze.dtypes == [(f.name, f.dataType.simpleString()) for f in BOUNDARY_BRONZE]
    out = boundary_silver(bronze).first()
    assert (out.geography_id, out.survey_year, out.geography_name, out.county_fips, out.ALAND) == ("06", 2020, "California", None, 5)


def test_wkt_from_geojson(spark):
    texts = [
        '{"type":"Polygon","coordinates":[[[0,0],[4.5,0],[4,4],[0,0]],[[1,1],[2,1],[2,2],[1,1]]]}',
        '{"type":"MultiPolygon","coordinates":[[[[0,0,9],[4,0,9],[4,4,9],[0,0,9]]],[[[6,0],[8,0],[8,2],[6,0]]]]}',
        '{"type":"Point","coordinates":[0,0]}',
        None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "g string")
    out = [r[0] for r in df.select(L.wkt_from_geojson(F.col("g"))).collect()]
    assert out[0] == "POLYGON ((0 0, 4.5 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))"
    assert out[1] == "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)), ((6 0, 8 0, 8 2, 6 0)))"
    assert out[2:] == [None, None]
