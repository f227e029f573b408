import pytest
from support import rows
from pyspark.sql import functions as F

from placetide.functions import numeric as N
from placetide.functions import text as X


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "s string")


def test_slugify_examples(spark):
    words = ["Venmo App", "ca$h money", "1337pay", "a - - b", "", "$$$", None, "9"]
    want = ["venmo_app", "cah_money", "_1337pay", "a_b", "", "", None, "_9"]
    assert [r[0] for r in texts(spark, *words).select(X.slugify("s")).collect()] == want
    assert [X.slug(w) for w in words if w is not None] == [w for w in want if w is not None]


def test_url_parts(spark):
    urls = [
        "https://a.example.com:8080/x/y?z=1", "android-app://com.app/path", "http://host?q=1", "bare-host",
        "http://host/", "https://h/p?ref=&k=1", "https://h/p?xref=5#top",
    ]
    out = rows(texts(spark, *urls).select(X.url_host("s"), X.url_path("s"), X.url_parameter("s", "ref")))
    assert out == [
        ("a.example.com:8080", "x/y", None),
        ("com.app", "/com.app/path", None),
        ("host", "", None),
        ("bare-host", "bare-host", None),
        ("host", "", None),
        ("h", "p", None),
        ("h", "p", "5#top"),
    ]


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(X.surrogate_key(["x", "y"])).collect()]
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)


def test_lenient_value(spark):
    values = [" 12 ", "-3", "12.5", "1e3", ".5", "abc", "", "None", "NULL", None, "1d", "nan", "99999999999999999999", "5."]
    out = [tuple(r[0]) for r in texts(spark, *values).select(X.lenient_value("s")).collect()]
    kinds = [k for k, *_ in out]
    assert kinds == ["int", "int", "real", "real", "real", "text", "null", "null", "null", "null", "text", "real", "real", "real"]
    assert out[0][1] == 12 and out[3][2] == 1000.0 and out[5][3] == "abc" and out[12][2] == 1e20


def test_display(spark):
    df = spark.createDataFrame([(1234.5, 12.25), (None, None), (999.4, 0.0)], "a double, b double")
    out = rows(df.select(X.display_value("a", "currency"), X.display_value("b", "percent"), X.legend_labels("a", "b", "percent")["high"]))
    assert out == [("$1,235", "12.3%", "12.3%+"), ("N/A", "N/A", "N/A+"), ("$999", "0.0%", "0.0%+")]


def test_width_bucket(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 2, 9.99, 10, 12)], "v double")
    assert [r[0] for r in df.select(N.width_bucket("v", 0.0, 10.0, 5)).collect()] == [0, 1, 2, 5, 6, 6]


def test_safe_math(spark):
    df = spark.createDataFrame([(6, 0, None), (6, 3, 1)], "a int, b int, c int")
    out = rows(df.select(N.safe_divide("a", "b"), N.safe_add(["a", "b", "c"]), N.safe_subtract(["a", "b", "c"])))
    assert out == [(None, 6, 6), (2.0, 10, 2)]
    for bad in ([], "a"):
        with pytest.raises(ValueError):
            N.safe_add(bad)


def test_numbers_stay_in_codegen(spark):
    from support import plan_of

    df = spark.range(10).select(N.share("id", "id").alias("s"), N.safe_divide("id", "id").alias("d"))
    assert "*(1) Project" in plan_of(df) and "Python" not in plan_of(df)
    assert F.lit(1) is not None
