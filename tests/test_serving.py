import json
import math
import random
import re
import struct

import pytest
from support import plan_of, rows
from pyspark.sql import functions as F

from placetide.operators.scale import (
    arc_width, colour_layer, colour_layers, ordered_bits, percentile_bounds, percentile_table, ramp_colour,
)
from placetide.plans import serving
from placetide.schemas import METRICS, PALETTES
from placetide.sources import geojson

SQUARE = "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"


def values(spark, *vs):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vs)], "i int, renter_rate double")


def test_bounds_interpolate(spark):
    df = values(spark, *(float(v) for v in range(1, 12)))
    assert rows(percentile_bounds(df, "renter_rate")) == [(1.5, 10.5)]


def test_null_is_read_as_zero_before_the_percentiles(spark):
    df = values(spark, None, 10.0, 10.0)
    assert rows(percentile_bounds(df, "renter_rate"))[0][0] == pytest.approx(1.0)
    assert rows(percentile_bounds(df, "renter_rate", null_as_zero=False)) == [(10.0, 10.0)]


def test_sketch_for_unbounded_values(spark):
    df = spark.range(10_000).selectExpr("CAST(id AS double) AS renter_rate")
    low, high = percentile_bounds(df, "renter_rate", accuracy=1000).first()
    assert abs(low - 500) <= 20 and abs(high - 9500) <= 20


def test_percentile_state_is_one_entry_per_distinct_value(spark):
    plan = plan_of(percentile_bounds(values(spark, 1.0, 1.0, 2.0), "renter_rate"))
    assert "partial_count(1)" in plan and "percentile(" not in plan


@pytest.mark.parametrize("seed", range(4))
def test_percentiles_match_plain_interpolation(spark, seed):
    rng = random.Random(seed)
    data = [rng.choice([0.0, -1.5, rng.uniform(-1e6, 1e6), rng.gauss(0, 1), 1e-9, 7.25]) for _ in range(rng.choice([1, 2, 3, 50, 401]))]
    got = percentile_bounds(spark.createDataFrame([(x,) for x in data], "v double"), "v").first()
    data.sort()
    for name, share in (("p5", 0.05), ("p95", 0.95)):
        at = share * (len(data) - 1)
        low, high = data[int(at)], data[min(len(data) - 1, int(at) + (at > int(at)))]
        assert got[name] == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-9, abs=1e-12)


def test_percentiles_of_nothing(spark):
    assert tuple(percentile_bounds(spark.createDataFrame([], "v double"), "v").first()) == (None, None)


def test_key_of_a_double_is_its_bits(spark):
    rng = random.Random(7)
    data = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    data = [x for x in data if x == x] + [0.0, -0.0, math.inf, -math.inf]
    for e in range(-1074, 1024, 7):
        x = math.ldexp(1.0, e)
        data += [x, -x, math.nextafter(x, 0), math.nextafter(x, math.inf)]
    got = spark.createDataFrame([(x,) for x in data], "v double").select("v", ordered_bits(F.col("v")).alias("k"))
    for r in got.collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.k == (-bits if r.v < 0 else bits)


def test_values_close_together_are_not_sorted_in_one_task(spark):
    """A million different values from 100 to 101: one count is shared, no window over values."""
    n = 1_000_000
    df = spark.range(n).select((F.lit(100.0) + (F.col("id") * 7919 % n) / n).alias("v"))
    out = percentile_bounds(df, "v")
    low, high = out.first()
    assert low == pytest.approx(100 + 0.05 * (n - 1) / n, abs=1e-9) and high == pytest.approx(100 + 0.95 * (n - 1) / n, abs=1e-9)
    out.collect()
    plan = plan_of(out)
    assert plan.count("ReusedExchange") >= 3
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert windows and not any(re.search(r"\bv#\d+ ASC", line) for line in windows)


def test_bounds_of_several_columns(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (math.nan, None)], "a double, b double")
    assert rows(percentile_table(df, ["a", "b"], null_as_zero=False)) == [("a", pytest.approx(1.1), pytest.approx(2.9))]
    assert rows(percentile_table(df, ["a", "b"]), "metric")[1] == ("b", 0.0, 0.0)


def test_layers_of_all_metrics_equal_single_ones(spark):
    rng = random.Random(3)
    data = [(i, *(rng.choice([None, rng.uniform(0, 100)]) for _ in METRICS)) for i in range(40)]
    df = spark.createDataFrame(data, "i int, " + ", ".join(f"{m} double" for m in METRICS))
    every = colour_layers(df, ["i"])
    for metric in METRICS:
        one = colour_layer(df, metric).select("i", "norm", "fill_color", "scale_min", "scale_max")
        assert rows(every.filter(F.col("metric") == metric).select(one.columns), "i") == rows(one, "i")
    assert colour_layers(df.filter("i < 0"), ["i"]).collect() == []
    with pytest.raises(ValueError):
        colour_layers(df, ["i"], ["height"])


def test_equal_values_take_the_lowest_colour(spark):
    out = colour_layer(values(spark, 5.0, 5.0), "renter_rate").collect()
    lowest = [*bytes.fromhex(PALETTES["PuRd"][0]), 180]
    assert [(r.norm, list(r.fill_color)) for r in out] == [(0.0, lowest)] * 2


def test_grey_only_without_zero_fill(spark):
    df = values(spark, None, 1.0, 2.0)
    grey = colour_layer(df, "renter_rate", null_as_zero=False).filter("i = 0").first()
    assert list(grey.fill_color) == [128, 128, 128, 180]
    filled = colour_layer(df, "renter_rate").filter("i = 0").first()
    assert list(filled.fill_color) != [128, 128, 128, 180]


def test_empty_layer_stays_empty(spark):
    df = values(spark, 1.0).filter("i > 5")
    assert colour_layer(df, "renter_rate").collect() == []
    assert geojson.layer_meta(colour_layer(df, "renter_rate"), "renter_rate").collect() == []


def test_ramp_ends_and_monotone_steps(spark):
    df = spark.range(0, 1001).select((F.col("id") / 1000).alias("x"))
    for name, palette in PALETTES.items():
        out = [list(r[0]) for r in df.orderBy("x").select(ramp_colour(F.col("x"), name)).collect()]
        assert out[0] == [*bytes.fromhex(palette[0]), 180] and out[-1] == [*bytes.fromhex(palette[-1]), 180]
        assert len({tuple(c) for c in out}) <= 256
        assert all(0 <= v <= 255 for c in out for v in c)


def test_ramp_steps_are_the_linear_mix_of_their_neighbours(spark):
    df = spark.range(256).select("id", ((F.col("id") + 0.5) / 256).alias("x"))
    for name, palette in PALETTES.items():
        colours = [bytes.fromhex(c) for c in palette]
        for r in df.select("id", ramp_colour(F.col("x"), name).alias("c")).collect():
            at = r.id / 255 * (len(colours) - 1)
            low = min(int(at), len(colours) - 2)
            mixed = [int(a + (b - a) * (at - low) + 1e-9) for a, b in zip(colours[low], colours[low + 1], strict=True)]
            assert list(r.c) == [*mixed, 180]
    odd = spark.createDataFrame([(None,), (float("nan"),), (-0.5,), (2.0,)], "x double")
    got = [list(r[0]) for r in odd.select(ramp_colour(F.col("x"), "PuRd")).collect()]
    assert got == [[128, 128, 128, 180]] * 2 + [[None, None, None, 180], [*bytes.fromhex(PALETTES["PuRd"][-1]), 180]]


def test_colours_are_compiled(spark, capsys):
    # Above 8,000 bytes the JVM interprets a method.
    df = spark.range(10).select("id", *(F.col("id").cast("double").alias(m) for m in METRICS))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        colour_layers(df, ["id"]).select("id", "metric", "norm", *(F.col("fill_color")[i] for i in range(4))).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_arc_width(spark):
    df = spark.createDataFrame([(10,), (100,), (1000,)], "households bigint")
    assert [r.arc_width for r in arc_width(df).orderBy("households").collect()] == [1.0, 1.0, 8.0]
    assert [r.arc_width for r in arc_width(df, widest=6).orderBy("households").collect()] == [1.0, 1.0, 6.0]
    assert "Window" not in plan_of(arc_width(df))


@pytest.fixture(scope="module")
def mart(spark):
    cols = serving.layer_columns("tracts")
    base = {c: 1.0 for c in cols} | {"geography_name": "X", "geometry_wkt": SQUARE, "survey_year": 2024, "total_population": 10, "median_household_income": 5}
    def row(state, county, tract, rate, wkt=SQUARE):
        d = base | {"geography_id": state + county + tract, "state_fips": state, "county_fips": county, "tract_fips": tract, "renter_rate": rate, "geometry_wkt": wkt}
        return tuple(d[c] for c in cols)
    data = [row("06", "001", "000100", 1.0), row("06", "003", "000100", 2.0, None), row("01", "001", "000100", None, "")]
    text = {"geography_id", "geography_name", "state_fips", "county_fips", "tract_fips", "geometry_wkt"}
    whole = {"survey_year": "int", "total_population": "bigint", "median_household_income": "bigint"}
    ddl = ", ".join(f"{c} {'string' if c in text else whole.get(c, 'double')}" for c in cols)
    return spark.createDataFrame(data, ddl)


def test_layer_filters(mart):
    assert serving.layer(mart, "tracts", "renter_rate", 2024, "6").count() == 2
    assert serving.layer(mart, "tracts", "renter_rate", 2024, "06", "3").count() == 1
    assert serving.layer(mart, "tracts", "renter_rate", 2023, "06").count() == 0
    with pytest.raises(ValueError, match="unknown metric"):
        serving.layer(mart, "tracts", "median_rent", 2024, "06")
    with pytest.raises(ValueError, match="state_fips"):
        serving.layer(mart, "counties")


def test_values_are_not_spliced_into_text(mart):
    assert serving.layer(mart, "tracts", "renter_rate", 2024, "06' OR '1'='1").count() == 0


def test_feature_collection(mart):
    layer = serving.layer(mart, "tracts", "renter_rate", 2024, "06").orderBy("county_fips")
    doc = json.loads(geojson.feature_collection(layer, "renter_rate"))
    assert doc["type"] == "FeatureCollection" and len(doc["features"]) == 2
    first, second = doc["features"]
    assert first["geometry"]["coordinates"] == [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]
    assert second["geometry"] is None and len(first["properties"]["fill_color"]) == 4
    assert "geometry_wkt" not in first["properties"]
    assert doc["meta"]["label"] == METRICS["renter_rate"]["label"] and doc["meta"]["min"] == pytest.approx(1.05)
    with pytest.raises(ValueError):
        geojson.feature_collection(layer, "renter_rate", max_features=1)


def test_properties_keep_nulls(mart):
    out = geojson.features(mart.filter("state_fips = '01'").select("geography_id", "renter_rate", "geometry_wkt")).first()[0]
    assert json.loads(out) == {"type": "Feature", "geometry": None, "properties": {"geography_id": "01001000100", "renter_rate": None}}


@pytest.fixture(scope="module")
def flow_mart(spark):
    data = [(f"{o:02d}", f"{d:02d}", 2023, 1000 + (o % 7), o == d) for o in range(1, 30) for d in range(1, 30)]
    data += [("01", "02", 2022, 9999, False), ("01", "03", 2023, 999, False)]
    base = spark.createDataFrame(data, "origin_geography_id string, dest_geography_id string, survey_year int, households bigint, is_non_migrant boolean")
    return base.select("*", *(F.lit(None).cast("double").alias(c) for c in serving.FLOW_COLUMNS if c not in base.columns))


def test_top_flows_cut_is_repeatable_on_ties(flow_mart):
    top = serving.flows(flow_mart).collect()
    assert len(top) == 200
    keys = [(-r.households, r.origin_geography_id, r.dest_geography_id) for r in top]
    assert keys == sorted(keys)
    shuffled = serving.flows(flow_mart.repartition(7, "dest_geography_id")).collect()
    assert shuffled == top
    assert "TakeOrdered" in plan_of(serving.flows(flow_mart))


def test_one_state_flows(flow_mart):
    out = serving.flows(flow_mart, 2024, state_fips="1").collect()
    # 2024 shows 2023; 28 flows out, 28 in; the thin one and the non-migrants are out.
    assert len(out) == 56 and all("01" in (r.origin_geography_id, r.dest_geography_id) for r in out)
    assert [r.households for r in out] == sorted((r.households for r in out), reverse=True)


def test_flow_document(flow_mart):
    doc = json.loads(geojson.flow_document(serving.flows(flow_mart)))
    assert len(doc["flows"]) == 200 and doc["flows"][0]["agi"] is None
    with pytest.raises(ValueError):
        geojson.flow_document(serving.flows(flow_mart), max_rows=10)


def test_metric_list_and_years(spark, mart):
    assert serving.metric_list(spark).count() == 5
    assert rows(serving.years_available(mart)) == [(2024,)]
