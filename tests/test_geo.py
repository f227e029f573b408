import json
import random

import pytest
from support import plan_of, rows

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from placetide.functions.geo import (
    bounding_box,
    centroid,
    geojson_geometry,
    is_sound,
    polygons,
    selection_bounds,
    split_unsound,
    with_outline,
    within,
)
from placetide.functions.numeric import haversine_distance

SQUARE = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"
BACKWARD = "POLYGON ((0 0, 0 4, 4 4, 4 0, 0 0))"
HOLE = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 3, 1 3, 1 1))"
SAME_WAY_HOLE = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 2 3, 2 1, 1 1))"
MULTI = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0)), ((6 0, 8 0, 8 2, 6 2, 6 0)))"
FLAT = "POLYGON ((0 0, 2 2, 0 0))"


@pytest.fixture(scope="module")
def shapes(spark):
    texts = [SQUARE, BACKWARD, HOLE, SAME_WAY_HOLE, MULTI, FLAT, "POLYGON EMPTY", "MULTIPOLYGON EMPTY", None]
    return spark.createDataFrame(list(enumerate(texts)), "i int, w string")


def test_parse(shapes):
    out = [r[0] for r in shapes.orderBy("i").select(polygons("w")).collect()]
    assert out[0] == [[[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]]
    assert [len(p) for p in out[2]] == [2] and [len(p) for p in out[4]] == [1, 1]
    assert out[6] == [] and out[7] == [] and out[8] is None


def test_parse_spacing_exponents_and_z(spark):
    df = spark.createDataFrame([("polygon Z((-1.5e1 2 7,3   4 7 , 5 6 7,-15 2 7))",)], "w string")
    assert df.select(polygons("w")).first()[0] == [[[[-15.0, 2.0], [3.0, 4.0], [5.0, 6.0], [-15.0, 2.0]]]]


def test_centroids(shapes):
    out = [r[0] for r in shapes.orderBy("i").select(centroid("w")).collect()]
    hole = ((16 * 2 - 2 * 1.5) / 14, 2.0)
    want = [(2, 2), (2, 2), hole, hole, ((16 * 2 + 4 * 7) / 20, (16 * 2 + 4 * 1) / 20), (2 / 3, 2 / 3), None, None, None]
    for got, expected in zip(out, want):
        if expected is None:
            assert got is None
        else:
            assert (got.lon, got.lat) == pytest.approx(expected, abs=1e-12)


def test_centroid_far_from_origin_stays_exact(spark):
    df = spark.createDataFrame([("POLYGON ((1e7 1e7, 10000001 1e7, 10000001 10000001, 1e7 10000001, 1e7 1e7))",)], "w string")
    c = df.select(centroid("w")).first()[0]
    assert (c.lon, c.lat) == pytest.approx((10000000.5, 10000000.5), abs=1e-8)


def test_centroid_against_plain_shoelace(spark):
    rng = random.Random(5)
    texts, want = [], []
    for _ in range(30):
        ring = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(rng.randint(3, 9))]
        ring.append(ring[0])
        area = mx = my = 0.0
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            cross = ax * by - bx * ay
            area, mx, my = area + cross, mx + (ax + bx) * cross, my + (ay + by) * cross
        texts.append("POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))")
        want.append((mx / (3 * area), my / (3 * area)))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, w string").orderBy("i")
    for row, expected in zip(df.select(centroid("w").alias("c")).collect(), want):
        assert (row.c.lon, row.c.lat) == pytest.approx(expected, rel=1e-6, abs=1e-6)


def test_geojson(shapes):
    out = [json.loads(r[0]) for r in shapes.orderBy("i").select(geojson_geometry("w")).collect()]
    assert out[2]["type"] == "Polygon" and len(out[2]["coordinates"]) == 2
    assert out[4]["type"] == "MultiPolygon" and len(out[4]["coordinates"]) == 2
    assert out[6] == {"type": "Polygon", "coordinates": []} and out[8] is None


def test_boxes(shapes):
    out = [r[0] and tuple(r[0]) for r in shapes.orderBy("i").select(bounding_box("w")).collect()]
    assert out[0] == (0, 0, 4, 4) and out[4] == (0, 0, 8, 4)
    assert out[6:] == [None, None, None]
    assert rows(selection_bounds(shapes, "w")) == [(0, 0, 8, 4)]
    assert rows(selection_bounds(shapes.filter("i > 5"), "w")) == [(None,) * 4]


def test_haversine(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    miles, km = df.select(haversine_distance("a", "b", "c", "d"), haversine_distance("a", "b", "c", "d", "km")).first()
    assert miles == pytest.approx(267.4, abs=0.5) and km == pytest.approx(miles * 1.60934)
    with pytest.raises(ValueError):
        haversine_distance("a", "b", "c", "d", "furlong")


BAD = [
    "POLYGON ((0 0, 1 1", "MULTIPOLYGON (((0 0, 1 1, 0 0))", "POINT (1 2)", "GEOMETRYCOLLECTION (POINT (1 2))", "POLYGON ((a b, 1 1, 0 0))",
    "POLYGON ((0, 1 1, 0 0))", "POLYGON ()", "POLYGON (())", "POLYGON ((0 0, 1 1, 0 0)) tail", "LINESTRING (0 0, 1 1)", "nonsense", "EMPTY",
]


@pytest.mark.parametrize("text", BAD)
def test_text_that_cannot_be_read_raises_and_is_told_apart(spark, text):
    df = spark.createDataFrame([(1, text)], "i int, w string")
    assert df.select(is_sound("w")).first()[0] is False
    for use in (polygons, geojson_geometry, centroid, bounding_box):
        with pytest.raises(PySparkException, match="cannot parse geometry"):
            df.select(use("w")).collect()


def test_rejects_are_counted_and_nothing_is_blank(spark):
    good = [SQUARE, HOLE, MULTI, "POLYGON EMPTY", " multipolygon empty ", None, "  "]
    df = spark.createDataFrame(list(enumerate(good + BAD)), "i int, w string")
    sound, rejected = split_unsound(df, "w")
    assert sorted(r["i"] for r in sound.collect()) == list(range(len(good)))
    assert rejected.count() == len(BAD)
    shapes = [r[0] for r in sound.orderBy("i").select(geojson_geometry("w")).collect()]
    assert None not in shapes and shapes[-2:] == ["null", "null"]
    assert df.select(F.count_if(is_sound("w"))).first()[0] == 5


def test_outline_agrees_with_the_single_functions(shapes):
    out = with_outline(shapes.withColumns({"b": bounding_box("w"), "c": centroid("w")}), "w").collect()
    for r in out:
        assert tuple(r.b or [None] * 4) == (r.min_lon, r.min_lat, r.max_lon, r.max_lat)
        assert tuple(r.c or [None] * 2) == (r.centroid_lon, r.centroid_lat)
        assert r.geometry_sound is (None if r.i == 8 else True)


@pytest.mark.parametrize("text", [
    "POLYGON ((0 0, 1 x, 1 1, 0 0))", "POLYGON ((0 0, 1, 1 1, 0 0))", "POLYGON ((0 0, 1 1, 0 0)", "POLYGON ()", "POLYGON (())", "POINT (1 2)",
    "POLYGON ((0 0, 1 1, 0 0)) tail", "POLYGON (([1], [1,2,3]))", "MULTIPOLYGON (((0 0, 1 1, 0 0)), ())", "((0 0, 1 1, 0 0))", "POLYGON EMPTY x",
])
def test_unsound_outlines_are_marked_and_raise_where_read(spark, text):
    df = spark.createDataFrame([("a", text), ("b", SQUARE), ("c", " ")], "geography_id string, geometry_wkt string")
    stored = with_outline(df)
    assert rows(stored.select("geography_id", "geometry_sound", "max_lon"), "geography_id") == [("a", False, None), ("b", True, 4.0), ("c", None, None)]
    assert rows(df.select("geography_id", is_sound("geometry_wkt")), "geography_id") == [("a", False), ("b", True), ("c", None)]
    with pytest.raises(PySparkException):
        selection_bounds(stored).collect()


def test_stored_outlines_are_read_without_parsing(spark, tmp_path):
    df = spark.range(400).selectExpr(
        "CAST(id AS STRING) AS geography_id",
        "format_string('POLYGON ((%1$d 0, %2$d 0, %2$d 2, %1$d 2, %1$d 0))', id, id + 1) AS geometry_wkt",
    )
    with_outline(df).repartitionByRange(4, "min_lon").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    near = within(stored, 10.5, 0, 12.5, 1)
    plan = plan_of(near)
    assert "PushedFilters: [IsNotNull(min_lon)" in plan and "regexp_replace" not in plan
    assert sorted(r.geography_id for r in near.collect()) == ["10", "11", "12"]
    assert "regexp_replace" not in plan_of(selection_bounds(stored)) and "geometry_wkt" not in plan_of(selection_bounds(stored))
    assert tuple(selection_bounds(near).first()) == (10.0, 0.0, 13.0, 2.0)
