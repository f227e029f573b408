"""Place keys, typed casts and release rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placetide.schemas import FIRST_YEAR, LAST_FLOW_YEAR, MEASURES, REAL_MEASURES


def pad_code(code, width: int) -> Column:
    """Left-pad a code with zeros; NULL stays NULL and longer text is cut to ``width``."""
    return F.lpad(F.col(code) if isinstance(code, str) else code, width, "0")


def state_code(code) -> Column:
    return pad_code(code, 2)


def county_code(code) -> Column:
    return pad_code(code, 3)


def geography_id(level: str, state="state", county="county", tract="tract") -> Column:
    """Place id of a level: padded state, then padded county, then the tract code as is."""
    parts = [state_code(state)]
    if level in ("counties", "tracts"):
        parts.append(county_code(county))
    if level == "tracts":
        parts.append(F.col(tract) if isinstance(tract, str) else tract)
    if level not in ("states", "counties", "tracts"):
        raise ValueError(f"unknown level {level!r}")
    return F.concat(*parts)


def typed_measures(lenient: bool = False, missing_codes: tuple[int, ...] = ()) -> list[Column]:
    """The survey measures cast from text.

    Malformed text raises under ANSI mode; ``lenient`` turns it into NULL instead.
    ``missing_codes`` (off by default) reads the given sentinel numbers as NULL.
    """
    convert = "try_cast" if lenient else "cast"
    out = []
    for name in MEASURES:
        dtype = "double" if name in REAL_MEASURES else "bigint"
        typed = f"{convert}({name} AS {dtype})"
        for code in missing_codes:
            typed = f"nullif({typed}, cast({int(code)} AS {dtype}))"
        out.append(F.expr(f"{typed} AS {name}"))
    return out


def latest_survey_year(as_of) -> Column:
    """Newest survey year on a date: estimates for Y come out in December of Y+1."""
    as_of = F.col(as_of) if isinstance(as_of, str) else as_of
    return F.year(as_of) - F.when(F.month(as_of) < 12, 2).otherwise(1)


def latest_flow_year(as_of) -> Column:
    """Newest flow year on a date; publication stops at the last known year."""
    as_of = F.col(as_of) if isinstance(as_of, str) else as_of
    return F.least(F.year(as_of) - 1, F.lit(LAST_FLOW_YEAR))


def available_years(latest: Column, first_year: int = FIRST_YEAR) -> Column:
    """Array of years from the first release up to ``latest`` (empty when before it)."""
    return F.when(latest >= first_year, F.sequence(F.lit(first_year), latest)).otherwise(
        F.array().cast("array<int>")
    )


def clamp_flow_year(year: int, last: int = LAST_FLOW_YEAR) -> int:
    """Flow views show the newest published year when asked for a later one."""
    return min(int(year), last)
