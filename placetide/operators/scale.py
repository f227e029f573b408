"""Colour scales, percentile bounds and relative widths."""

from __future__ import annotations

from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placetide.schemas import METRICS, PALETTES

LOW_SHARE, HIGH_SHARE = 0.05, 0.95
# Bits of a double, and how many of them one pass of the rank selection tells apart.
KEY_BITS, DIGIT_BITS = 64, 16

# Opacity of a fill, grey of a missing value, steps of a colour ramp.
ALPHA = 180
GREY = (128, 128, 128)
RAMP_STEPS = 256


def require_metric(metric: str) -> dict:
    """Settings of a listed metric; any other name raises before a plan is built."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {', '.join(METRICS)}")
    return METRICS[metric]


def _number(column: str, null_as_zero: bool) -> Column:
    value = F.col(column).cast("double")
    return F.coalesce(value, F.lit(0.0)) if null_as_zero else value


def percentile_bounds(
    df: DataFrame,
    column: str,
    null_as_zero: bool = True,
    accuracy: int | None = None,
) -> DataFrame:
    """One row ``(p5, p95)``: linearly interpolated 5th and 95th percentiles, NULL of no values.

    Exact, see :func:`percentile_table`; ``accuracy`` switches to the ``approx_percentile`` sketch.
    """
    if accuracy is not None:
        value = _number(column, null_as_zero)
        values = df.select(value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
        shares = F.array(F.lit(LOW_SHARE), F.lit(HIGH_SHARE))
        bounds = values.agg(F.percentile_approx("v", shares, accuracy).alias("p"))
        return bounds.select(F.col("p")[0].alias("p5"), F.col("p")[1].alias("p95"))
    return percentile_table(df, [column], null_as_zero).agg(F.max("p5").alias("p5"), F.max("p95").alias("p95"))


def percentile_table(df: DataFrame, columns: list[str], null_as_zero: bool = True) -> DataFrame:
    """One row ``(metric, p5, p95)`` for each of the columns that has a value.

    Radix selection: rows of all columns are reduced to (metric, value, count) in one shuffle with
    a map-side combine. Then the values' order-preserving whole numbers are counted by their first
    16 bits, those that share them with a wanted rank by the next 16, and so on. So no task sorts
    more than 65,536 counts of a rank, however close together the values lie. NULL (unless
    ``null_as_zero``) and NaN take no part.
    """
    pairs = (F.struct(F.lit(c).alias("metric"), _number(c, null_as_zero).alias("v")) for c in columns)
    stacked = df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.metric", "pair.v")
    stacked = stacked.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    counted = stacked.groupBy("metric", "v").agg(F.count("*").alias("n")).withColumn("key", ordered_bits(F.col("v")))

    first, *others = range(KEY_BITS - DIGIT_BITS, -1, -DIGIT_BITS)
    blocks = counted.groupBy("metric", F.shiftright("key", first).alias("prefix")).agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("metric").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.withColumn("total", F.sum("n").over(whole))
    ranks = []
    for name, share in (("p5", LOW_SHARE), ("p95", HIGH_SHARE)):
        at = F.lit(share) * (F.col("total") - 1)
        for end, rank in (("low", F.floor(at)), ("high", F.ceil(at))):
            ranks.append(F.struct(F.lit(f"{name}_{end}").alias("name"), at.alias("at"), rank.alias("rank")))
    # Ranks count from 0; a block holds those from the counts before it on.
    blocks = _with_start(blocks, "metric").withColumn("wanted", F.explode(F.array(*ranks)))
    found = _holding(blocks.select("metric", "wanted.*", "prefix", "start", "n"))
    for shift in others:
        # Four rows for each column, whatever the data: small by construction.
        held = F.broadcast(found.drop("v").withColumnRenamed("prefix", "above"))
        inside = counted.withColumn("above", F.shiftright("key", shift + DIGIT_BITS)).join(held, ["metric", "above"])
        digits = inside.groupBy("metric", "name", "at", "rank", F.shiftright("key", shift).alias("prefix"))
        found = _holding(_with_start(digits.agg(F.sum("n").alias("n"), F.max("v").alias("v")), "metric", "name"))
    ends = found.groupBy("metric").pivot("name", [f"{p}_{e}" for p in ("p5", "p95") for e in ("low", "high")])
    ends = ends.agg(F.max("v").alias("v"), F.max("at").alias("at"))

    def between(name: str) -> Column:
        low, high, at = F.col(f"{name}_low_v"), F.col(f"{name}_high_v"), F.col(f"{name}_low_at")
        mixed = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
        return F.when(low == high, low).otherwise(mixed).alias(name)

    return ends.select("metric", between("p5"), between("p95"))


def _with_start(blocks: DataFrame, *group: str) -> DataFrame:
    """``start``: how many values of the group lie before the block."""
    before = Window.partitionBy(*group).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _holding(blocks: DataFrame) -> DataFrame:
    """Blocks that hold their wanted rank, which from there on counts from the block's start."""
    rank = F.col("rank") - F.col("start")
    return blocks.filter((rank >= 0) & (rank < F.col("n"))).withColumn("rank", rank).drop("start", "n")


def ordered_bits(value: Column) -> Column:
    """64-bit whole number that orders like the double: its bits, with the sign of the value.

    Made by exact arithmetic: the power of two, corrected where the logarithm rounds, and the
    fraction above it. NULL and NaN give 0 and should be left out before.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("int")
    power = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).otherwise(guess)
    power = F.when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(power)
    fraction = (size / F.pow(F.lit(2.0), power) - 1) * F.lit(2.0**52)
    normal = (power + 1023).cast("bigint") * F.lit(1 << 52) + fraction.cast("bigint")
    # Below the least normal number the bits are the multiple of the least number above 0.
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")
    bits = F.when(size == float("inf"), F.lit(2047 << 52)).when(size < F.lit(2.0**-1022), tiny).otherwise(normal)
    # Never NULL, so that no test for NULL is put below the count, which all passes share.
    return F.coalesce(F.when(value < 0, -bits).otherwise(bits), F.lit(0).cast("bigint"))


def normalised(value: Column, low: Column, high: Column) -> Column:
    """Position of the clamped value between the bounds, 0 when they coincide."""
    clamped = F.least(F.greatest(value, low), high)
    return F.when(high > low, (clamped - low) / F.nullif(high - low, F.lit(0.0))).otherwise(F.lit(0.0))


def _ramp(palette: str) -> Column:
    """The palette's colour at each step, red, green and blue packed into one whole number.

    Channels run linearly from one colour of the palette to the next. They are worked out here
    once: written as expressions they make a method too long for the JVM to compile.
    """
    colours = [bytes.fromhex(c) for c in PALETTES[palette]]
    parts = len(colours) - 1
    packed = []
    for step in range(RAMP_STEPS):
        position = step / (RAMP_STEPS - 1) * parts
        segment = min(floor(position), parts - 1)
        ends = zip(colours[segment], colours[segment + 1], strict=True)
        red, green, blue = (floor(low + (high - low) * (position - segment) + 1e-9) for low, high in ends)
        packed.append(red << 16 | green << 8 | blue)
    return F.expr(f"array({', '.join(map(str, packed))})")


def _fill(norm: Column, ramp: Column) -> Column:
    step = F.least(F.floor(norm * RAMP_STEPS), F.lit(RAMP_STEPS - 1))
    packed = F.get(ramp, step.cast("int"))
    filled = F.array(*(F.shiftright(packed, bits).bitwiseAND(255) for bits in (16, 8, 0)), F.lit(ALPHA))
    grey = F.array(*(F.lit(g) for g in GREY), F.lit(ALPHA))
    return F.when(norm.isNull() | F.isnan(norm), grey).otherwise(filled)


def ramp_colour(norm: Column, palette: str) -> Column:
    """``[r, g, b, alpha]`` of a normalised value on a 256-step ramp; grey when NULL or NaN."""
    return _fill(norm, _ramp(palette))


def colour_layer(df: DataFrame, metric: str, null_as_zero: bool = True) -> DataFrame:
    """Add ``norm``, ``fill_color``, ``scale_min`` and ``scale_max`` for a listed metric.

    The two bounds enter as a scalar subquery: no join, and an empty layer stays empty.
    """
    palette = require_metric(metric)["palette"]
    bounds = percentile_bounds(df, metric, null_as_zero).select(F.struct("p5", "p95")).scalar()
    scaled = df.withColumn("_bounds", bounds)
    return _scaled(scaled, _number(metric, null_as_zero), _ramp(palette)).drop("_bounds")


def colour_layers(
    df: DataFrame, keys: list[str], metrics: list[str] | None = None, null_as_zero: bool = True
) -> DataFrame:
    """``keys, metric, value, norm, fill_color, scale_min, scale_max``: the layers of several
    listed metrics (all by default), one row for each row and metric.

    The bounds of all metrics come from one count. ``keys`` may not bear the names of the others.
    """
    metrics = list(METRICS) if metrics is None else list(metrics)
    ramps = F.create_map(*(c for m in metrics for c in (F.lit(m), _ramp(require_metric(m)["palette"]))))
    rows = percentile_table(df, metrics, null_as_zero).select(F.struct("metric", F.struct("p5", "p95")).alias("e"))
    bounds = rows.agg(F.map_from_entries(F.collect_list("e"))).scalar()
    values = F.array(*(F.struct(F.lit(m).alias("metric"), _number(m, null_as_zero).alias("value")) for m in metrics))
    long = df.select(*keys, F.inline(values)).withColumn("_bounds", F.element_at(bounds, F.col("metric")))
    return _scaled(long, F.col("value"), F.element_at(ramps, F.col("metric"))).drop("_bounds")


def _scaled(df: DataFrame, value: Column, ramp: Column) -> DataFrame:
    low, high = F.col("_bounds.p5"), F.col("_bounds.p95")
    df = df.withColumn("norm", F.when(value.isNotNull(), normalised(value, low, high)))
    return df.withColumns({"fill_color": _fill(F.col("norm"), ramp), "scale_min": low, "scale_max": high})


# Widest arc on the national and on the one-state map.
NATIONAL_WIDTH, STATE_WIDTH = 8, 6


def arc_width(df: DataFrame, column: str = "households", widest: int = NATIONAL_WIDTH) -> DataFrame:
    """Add ``arc_width``: size relative to the largest flow, at least 1.

    The maximum is a scalar subquery, so no window gathers all flows in one task.
    """
    largest = df.agg(F.max(column).cast("double")).scalar()
    ratio = F.col(column) / F.nullif(largest, F.lit(0.0)) * widest
    return df.withColumn("arc_width", F.greatest(F.lit(1.0), ratio))
