"""Checks on neighbouring values of an ordered column, without one big sorted group.

A plain ``lead`` over a whole table, or over one hot group, sorts it all in a single task.
Here rows are first reduced to distinct rows with a count (map-side combined, so copies
collapse before the shuffle). The distinct rows are range-partitioned by group and all ordered
columns: each task gets a stretch of the same size, and a group of any size, or one value with
very many second values, lies over as many tasks as it needs. Within a stretch the follower is
the next row; for a stretch's last row it is the first row of the next stretch, found among
the two ends of every stretch. There is one plan for all sizes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placetide.sources.storage import stored


def with_next(df: DataFrame, group_by: Sequence[str], order: Sequence[str], stretches: int | None = None) -> DataFrame:
    """Distinct (group, order) rows with ``copies`` and ``next`` = struct of the following
    row's ``order`` columns in the group (NULL at the group's end). NULLs come first.

    ``stretches`` is how many parts the rows are dealt into (the session's number of shuffle
    partitions if not given); the result does not depend on it. The paired rows are written to
    the shared folder, as the ends of the stretches are read after all of them are known.
    """
    group_by, order = list(group_by), list(order)
    keys = [*group_by, *order]
    distinct = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    spread = distinct.repartitionByRange(*([stretches] if stretches else []), *keys)
    placed = spread.withColumn("_stretch", F.spark_partition_id())
    inside = Window.partitionBy("_stretch").orderBy(*keys)
    follower = F.struct(*keys)
    paired = placed.withColumns({"_next": F.lead(follower).over(inside), "_first": F.row_number().over(inside) == 1})
    paired = stored(paired, "neighbours")
    # Two rows of each stretch at most, so this window is as long as the stretches are many.
    ends = paired.filter("_first OR _next IS NULL")
    across = Window.orderBy("_stretch", F.col("_next").isNull(), *keys)
    seams = ends.withColumn("_next", F.coalesce("_next", F.lead(follower).over(across)))
    rows = paired.filter("NOT _first AND _next IS NOT NULL").unionByName(seams)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_next.{c}")) for c in group_by], F.lit(True))
    following = F.when(F.col("_next").isNotNull() & same, F.struct(*[F.col(f"_next.{c}").alias(c) for c in order]))
    return rows.select(*keys, "copies", following.alias("next"))


# How the end of a range must relate to the start of the next one.
GAP_RULES = {
    "not_allowed": lambda end, start: end == start,
    "allowed": lambda end, start: end <= start,
    "required": lambda end, start: end < start,
}


def range_conflicts(lower: str, upper: str, gaps: str = "allowed", zero_length_range_allowed: bool = False) -> Column:
    """Number of violations of a :func:`with_next` row under one gap rule.

    Several rules can be counted from the same neighbours in one aggregate.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(GAP_RULES)}")
    keeps = GAP_RULES[gaps]
    low, high = F.col(lower), F.col(upper)
    shape = (low <= high) if zero_length_range_allowed else (low < high)
    good_shape = F.coalesce(shape, F.lit(False))
    good_next = F.col("next").isNull() | F.coalesce(keeps(high, F.col(f"next.{lower}")), F.lit(False))
    # All copies but the last are followed by an equal range.
    good_copy = F.coalesce(keeps(high, low), F.lit(False))
    after = F.when(good_copy, F.lit(0)).otherwise(F.col("copies") - 1) + F.when(good_next, F.lit(0)).otherwise(1)
    return F.when(good_shape, after).otherwise(F.col("copies")).cast("bigint")


def exclusive_range_violations(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: Sequence[str] = (),
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that overlap the next one, break the gap rule, or are empty or reversed.

    ``gaps``: ``not_allowed`` wants ``upper = next lower``, ``allowed`` wants ``<=``,
    ``required`` wants ``<``. Copies of one range count as neighbours of each other, and
    a NULL bound is a violation. Result: the range, ``copies`` of it, and how many of them
    are ``violations``.
    """
    bad = range_conflicts(lower, upper, gaps, zero_length_range_allowed)
    rows = with_next(df, partition_by, [lower, upper])
    return rows.select(*partition_by, lower, upper, "copies", bad.alias("violations")).filter("violations > 0")


def sequence_violations(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Values not followed by ``value + interval`` (of ``datepart`` units) in their group.

    Repeated values break the sequence too. Result: the value, its ``copies`` and the
    number of broken steps after it.
    """
    rows = with_next(df.filter(F.col(column).isNotNull()), group_by, [column])
    step = F.lit(interval) if datepart is None else F.expr(f"interval {int(interval)} {datepart}")
    expected = F.col(column) + step
    follows = F.col("next").isNull() | F.coalesce(F.col(f"next.{column}") == expected, F.lit(False))
    repeats = F.lit(0) if interval == 0 else F.col("copies") - 1
    bad = (repeats + F.when(follows, 0).otherwise(1)).cast("bigint")
    return rows.select(*group_by, column, "copies", bad.alias("violations")).filter("violations > 0")
