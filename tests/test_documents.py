"""JSON documents written in parts."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from placetide.operators.scale import colour_layer
from placetide.sources import geojson


def document(path):
    """The part files, one after the other by name."""
    parts = sorted(glob.glob(f"{path}/part-*"))
    return json.loads("".join(open(p, encoding="utf-8").read() for p in parts)), len(parts)


@pytest.fixture(scope="module")
def layer(spark):
    """500 tracts; a third has the same id, some no geometry, no name or an odd one."""
    return spark.range(500).selectExpr(
        "IF(id % 3 = 0, '06001000000', lpad(CAST(id AS string), 11, '0')) AS geography_id",
        "CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'é \"quoted\", \\n line' ELSE 'Tract' END AS geography_name",
        "'06' AS state_fips", "'001' AS county_fips", "CAST(2024 AS int) AS survey_year", "id / 10 AS renter_rate",
        "CASE WHEN id % 5 > 0 THEN concat('POLYGON ((0 0, ', id + 1, ' 0, 2 2, 0 2, 0 0))') END AS geometry_wkt",
    )


def test_collection_in_parts_equals_the_one_of_the_driver(spark, layer, tmp_path):
    coloured = colour_layer(layer, "renter_rate")
    path = str(tmp_path / "collection")
    # So few rows would be merged into one part.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        geojson.write_collection(coloured.repartition(7), "renter_rate", path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got, parts = document(path)
    want = json.loads(geojson.feature_collection(coloured, "renter_rate"))
    assert parts > 1 and got["type"] == "FeatureCollection" and got["meta"] == want["meta"]
    text = lambda doc: sorted(json.dumps(f, sort_keys=True) for f in doc["features"])
    assert len(got["features"]) == 500 and text(got) == text(want)
    ids = [f["properties"]["geography_id"] for f in got["features"]]
    assert ids == sorted(ids)


def test_equal_rows_and_null_keys_stay(spark, tmp_path):
    flows = spark.createDataFrame([(None, "02", 5)] * 3 + [("01", "02", 6)] * 40, "origin_geography_id string, dest_geography_id string, households int")
    path = str(tmp_path / "flows")
    geojson.write_flow_document(flows.repartition(5), path)
    got, _ = document(path)
    assert [f["households"] for f in got["flows"]] == [5] * 3 + [6] * 40
    assert got["flows"][0]["origin_geography_id"] is None


@pytest.mark.parametrize("kept", [0, 1])
def test_short_documents(spark, layer, tmp_path, kept):
    coloured = colour_layer(layer, "renter_rate").filter(F.col("renter_rate") < 0.1 * kept)
    geojson.write_collection(coloured, "renter_rate", str(tmp_path / "short"))
    got, _ = document(tmp_path / "short")
    assert len(got["features"]) == kept and (got["meta"] is None) == (kept == 0)
    geojson.write_flow_document(coloured.select("geography_id", "renter_rate"), str(tmp_path / "rows"), ["geography_id"])
    assert len(document(tmp_path / "rows")[0]["flows"]) == kept
