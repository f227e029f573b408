"""Number and date spines, and the date dimension.

The length of a spine depends on the range asked for, never on a table. ``spine_array`` holds
one in an array, for short ones per row; the others are rows of ``spark.range``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placetide.functions import dates as D

# Spine steps and the interval each one adds.
STEPS = {
    "second": "interval 1 second",
    "minute": "interval 1 minute",
    "hour": "interval 1 hour",
    "day": "interval 1 day",
    "week": "interval 7 days",
    "month": "interval 1 month",
    "quarter": "interval 3 months",
    "year": "interval 1 year",
}


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1..n as ``generated_number``, produced in parallel."""
    if upper_bound <= 0:
        raise ValueError("upper_bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def spine_array(start: Column, end: Column, datepart: str = "day") -> Column:
    """Array of starts in ``[start, end)`` by ``datepart``; empty when ``start >= end``.

    Works on one row or a million: the bounds are columns.
    """
    step = F.expr(STEPS[datepart])
    start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    whole = F.sequence(start, F.greatest(start, end), step)
    return F.filter(whole, lambda t: t < end)


# Months or seconds of each step.
MONTHS = {"month": 1, "quarter": 3, "year": 12}
SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _spine_rows(spark: SparkSession, start: Column, end: Column, datepart: str, name: str) -> DataFrame:
    """Starts in ``[start, end)``, one row each, made by ``spark.range``: a spine of any length
    is spread over tasks and never held in one array."""
    bounds = spark.range(1).select(start.cast("timestamp_ntz").alias("s"), end.cast("timestamp_ntz").alias("e"))
    months = MONTHS.get(datepart)
    unit = "MONTH" if months else "SECOND"
    between = F.timestamp_diff(unit, F.col("s"), F.col("e"))
    low, e, units = bounds.select("s", "e", between.alias("n")).first()
    if low is None or e is None or units is None or e <= low:
        return spark.range(0).select(F.lit(None).cast("timestamp_ntz").alias(name))
    each = months or SECONDS[datepart]
    # One more than fits: the last may lie behind the end, which the filter settles.
    rows = spark.range(units // each + 2)
    step = F.make_interval(months=F.col("id").cast("int") * each) if months else F.make_dt_interval(secs=F.col("id") * each)
    first, last = (F.lit(str(x)).cast("timestamp_ntz") for x in (low, e))
    return rows.select((first + step).alias(name)).filter(F.col(name) < last)


def date_spine(spark: SparkSession, datepart: str, start: str, end: str) -> DataFrame:
    """Rows ``date_<datepart>`` in ``[start, end)`` by the given step."""
    name = f"date_{datepart}"
    one = _spine_rows(spark, F.lit(start), F.lit(end), datepart, name)
    return one.withColumn(name, F.col(name).cast("date")) if datepart not in ("second", "minute", "hour") else one


def intervals_between(start, end, datepart: str = "day") -> Column:
    """Boundaries of ``datepart`` crossed from start to end."""
    start = start.cast("timestamp_ntz")
    end = end.cast("timestamp_ntz")
    unit = datepart.upper()
    if datepart == "day":
        return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
    return F.timestamp_diff(unit, F.date_trunc(datepart, start), F.date_trunc(datepart, end))


def base_dates(
    spark: SparkSession,
    start: str | None = None,
    end: str | None = None,
    n_dateparts: int | None = None,
    datepart: str = "day",
    as_of: str | None = None,
) -> DataFrame:
    """Spine as timestamps over ``[start, end)``, or the last ``n_dateparts`` up to and
    including ``as_of``."""
    name = f"date_{datepart}"
    if start and end:
        low, high = F.lit(start), F.lit(end)
    elif n_dateparts and as_of:
        anchor = F.lit(as_of).cast("date").cast("timestamp_ntz")
        low = anchor - F.expr(STEPS[datepart]) * F.lit(n_dateparts)
        high = D.tomorrow(F.lit(as_of))
    else:
        raise ValueError("give start and end, or n_dateparts and as_of")
    return _spine_rows(spark, low, high, datepart, name)


def date_attributes(d: str = "date_day") -> list[Column]:
    """The date-dimension columns of a date column, as one projection."""
    day = F.col(d).cast("date")
    year_ago = F.add_months(day, -12)
    same_weekday = F.date_sub(day, 364)
    return [
        day.alias("date_day"),
        D.yesterday(day).alias("prior_date_day"),
        D.tomorrow(day).alias("next_date_day"),
        year_ago.alias("prior_year_date_day"),
        same_weekday.alias("prior_year_over_year_date_day"),
        D.day_of_week(day, iso=False).alias("day_of_week"),
        D.day_of_week(day, iso=True).alias("day_of_week_iso"),
        D.day_name(day, short=False).alias("day_of_week_name"),
        D.day_name(day, short=True).alias("day_of_week_name_short"),
        D.day_of_month(day).alias("day_of_month"),
        D.day_of_year(day).alias("day_of_year"),
        D.week_start(day).alias("week_start_date"),
        D.week_end(day).alias("week_end_date"),
        D.week_start(same_weekday).alias("prior_year_week_start_date"),
        D.week_end(same_weekday).alias("prior_year_week_end_date"),
        D.week_of_year(day).alias("week_of_year"),
        D.iso_week_start(day).alias("iso_week_start_date"),
        D.iso_week_end(day).alias("iso_week_end_date"),
        D.iso_week_start(same_weekday).alias("prior_year_iso_week_start_date"),
        D.iso_week_end(same_weekday).alias("prior_year_iso_week_end_date"),
        D.iso_week_of_year(day).alias("iso_week_of_year"),
        D.iso_year_week(day).alias("iso_year_week"),
        D.week_of_year(same_weekday).alias("prior_year_week_of_year"),
        D.iso_week_of_year(same_weekday).alias("prior_year_iso_week_of_year"),
        F.month(day).alias("month_of_year"),
        D.month_name(day, short=False).alias("month_name"),
        D.month_name(day, short=True).alias("month_name_short"),
        F.trunc(day, "month").alias("month_start_date"),
        D.last_day_of("month", day).alias("month_end_date"),
        F.trunc(year_ago, "month").alias("prior_year_month_start_date"),
        D.last_day_of("month", year_ago).alias("prior_year_month_end_date"),
        F.quarter(day).alias("quarter_of_year"),
        F.trunc(day, "quarter").alias("quarter_start_date"),
        D.last_day_of("quarter", day).alias("quarter_end_date"),
        F.year(day).alias("year_number"),
        F.trunc(day, "year").alias("year_start_date"),
        D.last_day_of("year", day).alias("year_end_date"),
    ]


def date_dimension(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day in ``[start, end)`` with all date attributes."""
    return date_spine(spark, "day", start, end).select(*date_attributes("date_day"))
