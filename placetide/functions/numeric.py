"""Arithmetic helpers. All stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(numerator, denominator) -> Column:
    """``numerator / denominator``, NULL when the denominator is 0 or NULL."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def _zero_filled(cols) -> list[Column]:
    if isinstance(cols, (str, Column)) or not cols:
        raise ValueError("expected a non-empty list of columns")
    return [F.coalesce(_col(c), F.lit(0)) for c in cols]


def safe_add(cols) -> Column:
    """Sum of the columns with NULL read as 0."""
    return reduce(add, _zero_filled(cols))


def safe_subtract(cols) -> Column:
    """First column minus all others, with NULL read as 0."""
    return reduce(sub, _zero_filled(cols))


def width_bucket(value, low, high, buckets: int) -> Column:
    """Equal-width bucket 1..n over [low, high); 0 below, n+1 at or above ``high``."""
    return F.width_bucket(_col(value), F.lit(low), F.lit(high), F.lit(buckets).cast("int"))


def _rounded_sql(value: str, digits: int) -> str:
    scale = f"{10**digits}.0D"
    return f"signum({value}) * floor(abs({value}) * {scale} + 0.5D) / {scale}"


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double by scaling, ties away from zero.

    ``F.round`` on a double goes through its decimal text, so 1.005 becomes 1.01. SQL
    engines that scale the binary value give 1.0; this is that rule.
    """
    scale = 10.0**digits
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale


def share_sql(numerator: str, denominator: str, digits: int = 2) -> str:
    """:func:`share` as SQL text, for wide projections."""
    ratio = f"(CAST({numerator} AS DOUBLE) / NULLIF({denominator}, 0) * 100)"
    return _rounded_sql(ratio, digits)


def share(numerator, denominator: str, digits: int = 2) -> Column:
    """Percentage ``numerator`` of ``denominator``; NULL on a 0 or NULL denominator.

    Both are column names or SQL text. A sequence of numerators is summed with plain ``+``,
    so that one NULL part makes the share NULL.
    """
    if isinstance(numerator, (tuple, list)):
        numerator = "(" + " + ".join(numerator) + ")"
    return F.expr(share_sql(numerator, denominator, digits))


def per_unit(amount: str, units: str, digits: int = 2) -> Column:
    """Amount per unit, rounded; NULL when there are no units."""
    return F.expr(_rounded_sql(f"(CAST({amount} AS DOUBLE) / NULLIF({units}, 0))", digits))


# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def degrees_to_radians(degrees) -> Column:
    return F.radians(_col(degrees))


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance in ``mi`` or ``km``."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    lat1, lon1, lat2, lon2 = (_col(c) for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    miles = F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_MILES)
    return miles * KM_PER_MILE if unit == "km" else miles
