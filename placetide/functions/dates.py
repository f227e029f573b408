"""Calendar functions on date and timestamp columns.

Nothing here reads the clock: functions that mean "today" take ``as_of`` (a column or a
date literal), so a re-run gives the same rows. Week rule: standard weeks run Sunday to
Saturday, ISO weeks Monday to Sunday.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _day(c: Column | str) -> Column:
    return _col(c).cast("date")


def date_part(part: str, d) -> Column:
    return F.date_part(F.lit(part), _col(d))


def day_of_week(d, iso: bool = True) -> Column:
    """ISO: Monday 1 .. Sunday 7; otherwise Sunday 1 .. Saturday 7."""
    return F.weekday(_day(d)) + 1 if iso else F.dayofweek(_day(d))


def day_of_month(d) -> Column:
    return F.dayofmonth(_day(d))


def day_of_year(d) -> Column:
    return F.dayofyear(_day(d))


def _localized(d: Column, pattern: str, language: str) -> Column:
    # to_csv is the built-in formatter that takes a locale, so names in other languages
    # come from the JVM's own locale data and need no lookup table.
    return F.to_csv(F.struct(d), {"dateFormat": pattern, "locale": language})


def day_name(d, short: bool = True, language: str = "default") -> Column:
    """Weekday name, English by default, else in a two-letter language."""
    pattern = "EEE" if short else "EEEE"
    if language in ("default", "en"):
        return F.date_format(_day(d), pattern)
    name = _localized(_day(d), pattern, language)
    if language == "fi" and not short:
        # The locale data only holds the inflected "on Monday" form.
        name = F.regexp_replace(name, "na$", "")
    return F.regexp_replace(name, r"\.$", "") if short else name


def month_name(d, short: bool = True, language: str = "default") -> Column:
    """Month name, English by default, else in a two-letter language."""
    if language in ("default", "en"):
        return F.date_format(_day(d), "MMM" if short else "MMMM")
    name = _localized(_day(d), "LLL" if short else "LLLL", language)
    return F.regexp_replace(name, r"\.$", "") if short else name


def week_start(d) -> Column:
    """Sunday on or before the date."""
    return F.date_sub(_day(d), F.dayofweek(_day(d)) - 1)


def week_end(d) -> Column:
    """Saturday on or after the date."""
    return F.date_add(_day(d), 7 - F.dayofweek(_day(d)))


def week_of_year(d) -> Column:
    """Standard week number; week 1 is the (possibly short) week holding January 1.

    The documented behaviour only fixes the Sunday start; which week is number 1 is our
    choice.
    """
    first = F.trunc(_day(d), "year")
    return F.floor((F.dayofyear(_day(d)) + F.dayofweek(first) - 2) / 7).cast("int") + 1


def iso_week_start(d) -> Column:
    return F.date_sub(_day(d), F.weekday(_day(d)))


def iso_week_end(d) -> Column:
    return F.date_add(_day(d), 6 - F.weekday(_day(d)))


def iso_week_of_year(d) -> Column:
    return F.weekofyear(_day(d))


def iso_year_week(d) -> Column:
    """ISO year and week as ``2026-W01``; the year is the one the week belongs to."""
    year = F.date_part(F.lit("yearofweek"), _day(d))
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(_day(d)).cast("string"), 2, "0"))


def convert_timezone(ts, target: str, source: str = "UTC") -> Column:
    """Wall-clock time of ``source`` shown in ``target``."""
    return F.convert_timezone(F.lit(source), F.lit(target), _col(ts).cast("timestamp_ntz"))


def now(as_of, tz: str = "UTC", source: str = "UTC") -> Column:
    return convert_timezone(as_of, tz, source)


def today(as_of, tz: str = "UTC", source: str = "UTC") -> Column:
    return now(as_of, tz, source).cast("date")


def n_days_ago(n: int, d) -> Column:
    return F.date_sub(_day(d), int(n))


def n_days_away(n: int, d) -> Column:
    return n_days_ago(-int(n), d)


def yesterday(d) -> Column:
    return n_days_ago(1, d)


def tomorrow(d) -> Column:
    return n_days_away(1, d)


def n_weeks_ago(n: int, as_of) -> Column:
    """Monday of the week ``n`` weeks before."""
    return F.date_trunc("week", F.date_sub(_day(as_of), 7 * int(n))).cast("date")


def n_weeks_away(n: int, as_of) -> Column:
    return n_weeks_ago(-int(n), as_of)


def last_week(as_of) -> Column:
    return n_weeks_ago(1, as_of)


def next_week(as_of) -> Column:
    return n_weeks_away(1, as_of)


def n_months_ago(n: int, as_of) -> Column:
    """First day of the month ``n`` months before (truncation mirrors the week functions)."""
    return F.trunc(F.add_months(_day(as_of), -int(n)), "month")


def n_months_away(n: int, as_of) -> Column:
    return n_months_ago(-int(n), as_of)


def last_month(as_of) -> Column:
    return n_months_ago(1, as_of)


def next_month(as_of) -> Column:
    return n_months_away(1, as_of)


def last_month_name(as_of, short: bool = True) -> Column:
    return month_name(last_month(as_of), short)


def next_month_name(as_of, short: bool = True) -> Column:
    return month_name(next_month(as_of), short)


def last_month_number(as_of) -> Column:
    return F.month(last_month(as_of))


def next_month_number(as_of) -> Column:
    return F.month(next_month(as_of))


# Period names accepted by periods_since.
PERIODS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def periods_since(ts, as_of, period: str = "day") -> Column:
    """Whole periods between ``ts`` and ``as_of``: the most that can be added to ``ts``
    without passing ``as_of``. A month added to January 30 ends on the last of February."""
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}")
    unit, start, end = period.upper(), _col(ts).cast("timestamp_ntz"), _col(as_of).cast("timestamp_ntz")
    whole = F.timestamp_diff(unit, start, end)
    if period not in ("month", "quarter", "year"):
        return whole
    # The built-in count wants the day of month to be reached, even where the month is shorter.
    one_more = (end >= start) & (F.timestamp_add(unit, (whole + 1).cast("int"), start) <= end)
    return whole + F.when(one_more, 1).otherwise(0)


def round_timestamp(ts) -> Column:
    """Nearest midnight as a timestamp; noon goes to the next day."""
    shifted = _col(ts).cast("timestamp_ntz") + F.expr("interval 12 hours")
    return shifted.cast("date").cast("timestamp_ntz")


# Epoch units and how many make a second.
EPOCH_UNITS = {"seconds": 1, "milliseconds": 1_000, "microseconds": 1_000_000}


def from_unixtimestamp(epoch, unit: str = "seconds") -> Column:
    """UTC wall-clock timestamp of an epoch count, whatever the session time zone."""
    if unit not in EPOCH_UNITS:
        raise ValueError(f"unknown unit {unit!r}")
    per_second = EPOCH_UNITS[unit]
    count = _col(epoch).cast("bigint")
    seconds = F.floor(count / F.lit(per_second).cast("decimal(10,0)")).cast("bigint")
    rest = F.pmod(count, F.lit(per_second)) * (1_000_000 // per_second)
    fraction = F.make_dt_interval(secs=(rest / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)"))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")).cast("timestamp_ntz")
    return day + F.make_dt_interval(secs=F.pmod(seconds, F.lit(86400)).cast("decimal(18,6)")) + fraction


def to_unixtimestamp(ts) -> Column:
    """Seconds since 1970-01-01 of a UTC wall-clock timestamp, whatever the session zone."""
    ts = _col(ts).cast("timestamp_ntz")
    in_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(ts.cast("date")).cast("bigint") * 86400 + in_day


def make_date(year, month, day) -> Column:
    return F.make_date(_col(year), _col(month), _col(day))


def make_datetime(year, month, day, hour=0, minute=0, second=0) -> Column:
    """Wall-clock timestamp from its parts (whole numbers or columns)."""
    parts = [F.lit(p) if isinstance(p, int) else _col(p) for p in (year, month, day, hour, minute, second)]
    return F.make_timestamp_ntz(*parts)


def last_day_of(part: str, d) -> Column:
    """Last date of the month, quarter or year holding ``d``."""
    months = {"month": 1, "quarter": 3, "year": 12}[part]
    return F.date_sub(F.add_months(F.trunc(_day(d), part), months), 1)


# Week layout of a retail quarter (first two cuts of its 13 weeks).
RETAIL_CUTS = (4, 9)


def _retail_year_end(year: Column, end_month: int, week_start_day: int) -> Column:
    """Last day of the fiscal year closing around ``end_month`` of ``year``: the week end
    nearest to that month's last day."""
    month_end = F.last_day(F.make_date(year, F.lit(end_month), F.lit(1)))
    closing_day = (week_start_day + 5) % 7 + 1
    ahead = F.pmod(F.lit(closing_day + 3) - F.dayofweek(month_end), F.lit(7)) - 3
    return F.date_add(month_end, ahead)


def fiscal_period(d, year_end_month: int = 1, week_start_day: int = 1, shift_year: int = 1) -> Column:
    """Struct of 4-5-4 retail calendar fields for a date.

    ``week_start_day`` counts Sunday as 1. The fiscal year is named after the calendar year
    it closes in minus ``shift_year``. Week 53, when there is one, joins the last period.
    Everything is arithmetic on the date itself: no calendar table and no join.
    """
    d = _day(d)

    def end_of(offset: int) -> Column:
        return _retail_year_end(F.year(d) + offset, year_end_month, week_start_day)

    close_year = F.when(d <= end_of(0), F.year(d)).otherwise(F.year(d) + 1)
    opening = F.date_add(
        F.when(d <= end_of(0), F.when(d <= end_of(-1), end_of(-2)).otherwise(end_of(-1))).otherwise(end_of(0)), 1
    )
    close_year = F.when(d <= end_of(-1), F.year(d) - 1).otherwise(close_year)
    week = F.floor(F.datediff(d, opening) / 7).cast("int") + 1
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int") + 1
    quarter_week = week - (quarter - 1) * 13
    first, second = RETAIL_CUTS
    period_of_quarter = F.when(quarter_week <= first, 1).when(quarter_week <= second, 2).otherwise(3)
    before = F.when(quarter_week <= first, 0).when(quarter_week <= second, first).otherwise(second)
    start = F.date_add(opening, (week - 1) * 7)
    return F.struct(
        (close_year - shift_year).alias("fiscal_year_number"),
        start.alias("week_start_date"),
        F.date_add(start, 6).alias("week_end_date"),
        week.alias("fiscal_week_of_year"),
        (quarter_week - before).alias("fiscal_week_of_period"),
        ((quarter - 1) * 3 + period_of_quarter).alias("fiscal_period_number"),
        quarter.alias("fiscal_quarter_number"),
        period_of_quarter.alias("fiscal_period_of_quarter"),
    )
