from datetime import date, datetime

import pytest
from support import rows
from pyspark.sql import functions as F

from placetide.functions import dates as D
from placetide.operators import spines as P


def day(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("date").alias("d"))


def stamp(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))


def test_day_numbers(spark):
    df = day(spark, "2022-03-06")
    assert tuple(df.select(D.day_of_week("d"), D.day_of_week("d", iso=False), D.day_of_month("d")).first()) == (7, 1, 6)
    assert day(spark, "2022-02-02").select(D.day_of_year("d")).first()[0] == 33


def test_standard_weeks_run_sunday_to_saturday(spark):
    df = day(spark, "2024-01-06", "2024-01-07", "2024-01-13")
    out = rows(df.select(D.week_start("d"), D.week_end("d"), D.week_of_year("d")))
    assert out == [
        (date(2023, 12, 31), date(2024, 1, 6), 1),
        (date(2024, 1, 7), date(2024, 1, 13), 2),
        (date(2024, 1, 7), date(2024, 1, 13), 2),
    ]


def test_week_one_holds_january_first(spark):
    df = day(spark, *(f"{y}-01-01" for y in range(2015, 2030)))
    assert {r[0] for r in df.select(D.week_of_year("d")).collect()} == {1}


def test_iso_week_takes_the_year_of_its_thursday(spark):
    df = day(spark, "2024-12-30", "2021-01-03", "2026-01-01")
    out = rows(df.select(D.iso_year_week("d"), D.iso_week_start("d"), D.iso_week_end("d")))
    assert out == [
        ("2025-W01", date(2024, 12, 30), date(2025, 1, 5)),
        ("2020-W53", date(2020, 12, 28), date(2021, 1, 3)),
        ("2026-W01", date(2025, 12, 29), date(2026, 1, 4)),
    ]


def test_round_timestamp_examples(spark):
    df = stamp(spark, "2022-02-05 18:45:15", "2022-02-05 11:45:15", "2022-02-05 12:00:00", "2022-02-05 00:00:00")
    assert [r[0].day for r in df.select(D.round_timestamp("ts")).collect()] == [6, 5, 6, 5]


def test_months_since_clip_short_months(spark):
    df = stamp(spark, "2024-01-31 00:00:00", "2024-01-30 22:00:00", "2024-02-29 00:00:00", "2024-03-01 00:00:01")
    end = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    assert [r[0] for r in df.select(D.periods_since("ts", end, "month")).collect()] == [1, 1, 0, 0]
    assert [r[0] for r in df.select(D.periods_since("ts", end, "day")).collect()] == [30, 30, 1, 0]
    with pytest.raises(ValueError):
        D.periods_since("ts", end, "moon")


def test_month_offsets(spark):
    df = day(spark, "2024-03-31", "2024-01-15")
    out = rows(df.select(D.last_month("d"), D.next_month("d"), D.last_month_name("d"), D.next_month_number("d")))
    assert out == [(date(2024, 2, 1), date(2024, 4, 1), "Feb", 4), (date(2023, 12, 1), date(2024, 2, 1), "Dec", 2)]


def test_unix_time_is_zone_free(spark):
    df = stamp(spark, "1969-12-31 23:59:59", "2024-03-10 02:30:00", "2024-11-03 01:30:00")
    want = [-1, 1710037800, 1730597400]
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            seconds = D.to_unixtimestamp("ts")
            out = df.select(seconds.alias("s"), D.from_unixtimestamp(seconds).alias("back"), "ts").collect()
            assert [r.s for r in out] == want
            assert all(r.back == r.ts for r in out)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unix_time_units(spark):
    df = spark.createDataFrame([(1500, 1_500_000)], "ms bigint, us bigint")
    out = df.select(D.from_unixtimestamp("ms", "milliseconds"), D.from_unixtimestamp("us", "microseconds")).first()
    assert tuple(out) == (datetime(1970, 1, 1, 0, 0, 1, 500000),) * 2
    with pytest.raises(ValueError):
        D.from_unixtimestamp("ms", "hours")


def test_names_in_all_languages(spark):
    df = day(spark, "2024-02-05")
    for language in ("en", "nl", "de", "fr", "es", "it", "pt", "pl", "da", "sv", "tr", "cs", "fi"):
        long, short, month = df.select(
            D.day_name("d", False, language), D.day_name("d", True, language), D.month_name("d", False, language)
        ).first()
        assert long and month and 1 <= len(short) <= len(long) and not short.endswith(".")
    assert df.select(D.day_name("d", False, "fr"), D.month_name("d", False, "pl")).first() == ("lundi", "luty")


def test_zones(spark):
    df = stamp(spark, "2024-07-01 03:00:00")
    assert df.select(D.now("ts", "America/Los_Angeles")).first()[0] == datetime(2024, 6, 30, 20)
    assert df.select(D.today("ts", "America/Los_Angeles")).first()[0] == date(2024, 6, 30)


def test_date_parts_makers(spark):
    df = spark.range(1)
    assert df.select(D.make_date(F.lit(2024), F.lit(2), F.lit(29))).first()[0] == date(2024, 2, 29)
    assert df.select(D.make_datetime(2024, 2, 29, 13)).first()[0] == datetime(2024, 2, 29, 13)


def test_series_and_spines(spark):
    assert rows(P.generate_series(spark, 3)) == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        P.generate_series(spark, 0)
    assert rows(P.date_spine(spark, "day", "2024-02-28", "2024-03-02")) == [(date(2024, 2, 28),), (date(2024, 2, 29),), (date(2024, 3, 1),)]
    assert rows(P.date_spine(spark, "month", "2024-01-31", "2024-04-01")) == [(date(2024, 1, 31),), (date(2024, 2, 29),), (date(2024, 3, 31),)]
    assert P.date_spine(spark, "day", "2024-03-02", "2024-03-02").count() == 0
    assert P.date_spine(spark, "day", "2024-03-03", "2024-03-02").count() == 0
    assert P.date_spine(spark, "hour", "2024-03-02", "2024-03-03").count() == 24


def test_base_dates(spark):
    last = rows(P.base_dates(spark, n_dateparts=2, as_of="2024-03-01"))
    assert last == [(datetime(2024, 2, 28),), (datetime(2024, 2, 29),), (datetime(2024, 3, 1),)][-len(last):]
    assert last[-1] == (datetime(2024, 3, 1),) and len(last) == 3
    assert P.base_dates(spark, "2015-01-01", "2016-01-01").count() == 365
    with pytest.raises(ValueError):
        P.base_dates(spark, n_dateparts=3)


def test_date_dimension_leap_day(spark):
    dim = P.date_dimension(spark, "2024-02-28", "2024-03-02")
    assert len(dim.columns) == 37 and dim.count() == 3
    leap = dim.filter("date_day = date'2024-02-29'").first()
    assert leap.prior_year_date_day == date(2023, 2, 28)
    assert leap.prior_year_over_year_date_day == date(2023, 3, 2)
    assert leap.month_end_date == date(2024, 2, 29) and leap.quarter_end_date == date(2024, 3, 31)
    assert leap.prior_year_month_end_date == date(2023, 2, 28) and leap.year_end_date == date(2024, 12, 31)


def test_fiscal_year_covers_every_day_once(spark):
    days = P.date_spine(spark, "day", "2010-01-01", "2031-01-01")
    for end_month, start_day in ((1, 1), (12, 2), (6, 1)):
        f = days.select("date_day", D.fiscal_period("date_day", end_month, start_day).alias("f")).select("date_day", "f.*")
        assert f.filter("date_day NOT BETWEEN week_start_date AND week_end_date").count() == 0
        assert f.filter("fiscal_week_of_year NOT BETWEEN 1 AND 53").count() == 0
        assert f.filter(f"dayofweek(week_start_date) != {start_day}").count() == 0
        per_year = f.groupBy("fiscal_year_number").agg(F.count("*").alias("n"), F.max("fiscal_week_of_year").alias("w"))
        inner = per_year.filter("fiscal_year_number BETWEEN 2010 AND 2028")
        assert {(r.n, r.w) for r in inner.collect()} <= {(364, 52), (371, 53)}
        weeks = f.filter("fiscal_year_number = 2015").groupBy("fiscal_period_number").agg(
            F.count("*").alias("n"), F.max("fiscal_week_of_period").alias("w")
        )
        got = {r.fiscal_period_number: r.w for r in weeks.collect()}
        assert [got[i] for i in range(1, 12)] == [4, 5, 4, 4, 5, 4, 4, 5, 4, 4, 5] and got[12] in (4, 5)


def test_retail_year_known_closings(spark):
    # The public retail calendar's fiscal 2023 has 53 weeks and closes on 2024-02-03.
    df = day(spark, "2024-02-03", "2024-02-04", "2023-01-28")
    out = rows(df.select(D.fiscal_period("d")["fiscal_year_number"], D.fiscal_period("d")["fiscal_week_of_year"], D.fiscal_period("d")["fiscal_period_number"]))
    assert out == [(2023, 53, 12), (2024, 1, 1), (2022, 52, 12)]


def test_long_fine_spine(spark):
    from placetide.operators import spines

    year = spines.date_spine(spark, "second", "2020-01-01", "2021-01-01")
    assert year.count() == 366 * 86400
    assert "date_second" in year.columns
    for part in spines.STEPS:
        rows = [r[0] for r in spines.date_spine(spark, part, "2020-01-31", "2020-01-31").collect()]
        assert rows == []
    months = [str(r[0]) for r in spines.date_spine(spark, "month", "2020-01-31", "2020-06-01").orderBy("date_month").collect()]
    assert months == ["2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30", "2020-05-31"]
