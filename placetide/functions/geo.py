"""Boundary geometry held as WKT text.

The text is rewritten into nested JSON arrays and read with ``from_json``, so parsing,
centroids and boxes are all built-in expressions: no UDF, no geometry library. Functions
take a column name or SQL text. Stored layers keep what they give (``OUTLINE``), so that marts,
boxes and map bounds parse nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COORDINATES = "array<array<array<array<double>>>>"
_NUMBER = r"([^\s,()]+)"


def _is_multi(wkt: str) -> str:
    return f"startswith(upper(left(ltrim({wkt}), 12)), 'MULTIPOLYGON')"


def _body(wkt: str) -> str:
    return rf"regexp_replace({wkt}, r'(?i)^\s*(MULTI)?POLYGON\s*(ZM|Z|M)?\s*', '')"


def _let(value: str, name: str, body: str) -> str:
    """Bind ``value`` once under ``name`` inside ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _parsed_sql(wkt: str) -> str:
    """What the text gives as it stands; NULL where it is no such text."""
    pairs = rf"regexp_replace(b, r'{_NUMBER}\s+{_NUMBER}(\s+{_NUMBER})*', '[$1,$2]')"
    nested = f"translate({pairs}, '()', '[]')"
    text = (
        f"CASE WHEN upper(left(b, 5)) = 'EMPTY' THEN '[]' "
        f"WHEN {_is_multi(wkt)} THEN {nested} ELSE concat('[', {nested}, ']') END"
    )
    return f"from_json({_let(_body(wkt), 'b', text)}, '{COORDINATES}')"


def _sound_sql(wkt: str, p: str) -> str:
    """The text is a polygon and every point of the parsed ``p`` has both coordinates.

    The points are tested as one flat array: an absent one anywhere makes ``flatten`` NULL, and
    each that was read has two numbers, as the text holds no brackets of its own.
    """
    begins = rf"{wkt} RLIKE r'(?i)^\s*(MULTI)?POLYGON\s*(ZM|Z|M)?\s*(EMPTY\s*$|\()'"
    ends = rf"({wkt} RLIKE r'\)\s*$' OR size({p}) = 0) AND instr({wkt}, '[') = 0"
    balanced = f"length(replace({wkt}, '(', '')) = length(replace({wkt}, ')', ''))"
    rings = f"forall({p}, y -> size(y) > 0 AND forall(y, r -> size(r) > 0))"
    numbers = "c IS NOT NULL AND size(array_compact(c)) = size(c) AND size(c) = 2 * size(flatten(flatten({p})))"
    points = _let(f"flatten(flatten(flatten({p})))", "c", numbers.format(p=p))
    return f"coalesce({begins} AND {balanced} AND {p} IS NOT NULL AND {ends} AND {rings} AND {points}, false)"


def _polygons_sql(wkt: str) -> str:
    sound = _sound_sql(wkt, "g")
    error = f"raise_error(concat('cannot parse geometry: ', left({wkt}, 60)))"
    blank = f"{wkt} IS NULL OR trim({wkt}) = ''"
    return _let(_parsed_sql(wkt), "g", f"CASE WHEN {blank} THEN NULL WHEN {sound} THEN g ELSE {error} END")


def is_sound(wkt: str) -> Column:
    """True for POLYGON / MULTIPOLYGON text that can be read, EMPTY included; NULL for NULL or
    blank text; false for anything else, which the functions below raise on."""
    sound = _let(_parsed_sql(wkt), "g", _sound_sql(wkt, "g"))
    return F.expr(f"CASE WHEN {wkt} IS NOT NULL AND trim({wkt}) <> '' THEN {sound} END")


def split_unsound(df: DataFrame, wkt: str = "geometry_wkt") -> tuple[DataFrame, DataFrame]:
    """Rows whose geometry can be read or is absent, and those to reject."""
    bad = F.coalesce(~is_sound(wkt), F.lit(False))
    return df.filter(~bad), df.filter(bad)


def polygons(wkt: str) -> Column:
    """POLYGON / MULTIPOLYGON text as polygons > rings > points > (x, y).

    EMPTY gives an empty array, NULL and blank text NULL. Any other text raises: a shape is
    never lost silently. See :func:`split_unsound` for setting such rows apart.
    """
    return F.expr(_polygons_sql(wkt))


def geojson_geometry(wkt: str) -> Column:
    """GeoJSON geometry text; the word ``null`` for NULL or blank input."""
    single = "CASE WHEN size(p) > 0 THEN to_json(p[0]) ELSE '[]' END"
    text = _let(
        _polygons_sql(wkt),
        "p",
        f"""CASE WHEN {_is_multi(wkt)} THEN concat('{{"type":"MultiPolygon","coordinates":', to_json(p), '}}')
            ELSE concat('{{"type":"Polygon","coordinates":', {single}, '}}') END""",
    )
    return F.expr(f"CASE WHEN {wkt} IS NULL OR trim({wkt}) = '' THEN 'null' ELSE {text} END")


# Area and first moments of one closed ring r. The ring is shifted to its first point (array
# v): that keeps the cross products (array c) small, which is what the precision of a
# shoelace sum depends on.
_ZERO = "named_struct('a', 0D, 'x', 0D, 'y', 0D)"
_STEPS = "sequence(1, size(r) - 1)"
_SHIFT = "transform(r, q -> named_struct('x', q[0] - r[0][0], 'y', q[1] - r[0][1]))"
_CROSS = f"transform({_STEPS}, i -> v[i-1].x * v[i].y - v[i].x * v[i-1].y)"
_SUMS = f"""named_struct(
    'a', aggregate(c, 0D, (t, e) -> t + e),
    'x', aggregate({_STEPS}, 0D, (t, i) -> t + (v[i-1].x + v[i].x) * c[i-1]),
    'y', aggregate({_STEPS}, 0D, (t, i) -> t + (v[i-1].y + v[i].y) * c[i-1]))"""
# Ring direction is not reliable in source files: take the absolute area, flip the moments
# with it, and let the position in the polygon (outer ring first) give the sign.
_RING = _let(
    _let(_SHIFT, "v", _let(_CROSS, "c", _SUMS)),
    "m",
    """named_struct('a', s * abs(m.a) / 2,
       'x', s * (signum(m.a) * m.x / 6 + abs(m.a) / 2 * r[0][0]),
       'y', s * (signum(m.a) * m.y / 6 + abs(m.a) / 2 * r[0][1]))""",
)


def _centroid_sql(p: str) -> str:
    ring = _let("CASE WHEN k = 0 THEN 1D ELSE -1D END", "s", _RING)
    rings = f"flatten(transform({p}, poly -> transform(poly, (r, k) -> {ring})))"
    total = f"aggregate({rings}, {_ZERO}, (t, m) -> named_struct('a', t.a + m.a, 'x', t.x + m.x, 'y', t.y + m.y))"

    def mean(axis: int) -> str:
        return f"aggregate(flatten(flatten({p})), 0D, (t, q) -> t + q[{axis}]) / size(flatten(flatten({p})))"

    centre = _let(
        total,
        "t",
        f"""CASE WHEN t.a > 0 THEN named_struct('lon', t.x / t.a, 'lat', t.y / t.a)
            ELSE named_struct('lon', {mean(0)}, 'lat', {mean(1)}) END""",
    )
    return f"CASE WHEN size(flatten(flatten({p}))) > 0 THEN {centre} END"


def _box_sql(wkt: str, p: str) -> str:
    points = f"CASE WHEN {_is_multi(wkt)} THEN flatten(flatten({p})) WHEN size({p}) > 0 THEN {p}[0][0] END"
    box = """CASE WHEN size(q) > 0 THEN named_struct(
        'min_lon', array_min(transform(q, c -> c[0])), 'min_lat', array_min(transform(q, c -> c[1])),
        'max_lon', array_max(transform(q, c -> c[0])), 'max_lat', array_max(transform(q, c -> c[1]))) END"""
    return _let(points, "q", box)


def centroid(wkt: str) -> Column:
    """Area centroid as ``struct(lon, lat)``; holes are subtracted.

    A shape without area falls back to the mean of its points; NULL and EMPTY give NULL.
    """
    return F.expr(_let(_polygons_sql(wkt), "p", _centroid_sql("p")))


def bounding_box(wkt: str) -> Column:
    """``struct(min_lon, min_lat, max_lon, max_lat)``: outer ring of a POLYGON, all rings of a
    MULTIPOLYGON; NULL for NULL or EMPTY."""
    return F.expr(_let(_polygons_sql(wkt), "p", _box_sql(wkt, "p")))


# Columns of a stored layer that hold its outlines' box, centre and validity.
BOX = ("min_lon", "min_lat", "max_lon", "max_lat")
OUTLINE = (*BOX, "centroid_lon", "centroid_lat", "geometry_sound")


def with_outline(df: DataFrame, wkt: str = "geometry_wkt") -> DataFrame:
    """``df`` with the columns of ``OUTLINE``: what a stored layer keeps so that no later step
    parses the text again. Text that cannot be read gives false and NULLs, NULL or blank text NULLs.

    The text is parsed once for all of them; those that nobody reads are not computed.
    """
    parsed = df.withColumn("_shape", F.expr(f"CASE WHEN trim({wkt}) <> '' THEN {_parsed_sql(wkt)} END"))
    judged = parsed.withColumn("_sound", F.expr(f"CASE WHEN trim({wkt}) <> '' THEN {_sound_sql(wkt, '_shape')} END"))
    known = judged.select(
        *df.columns,
        F.expr(f"CASE WHEN _sound THEN {_box_sql(wkt, '_shape')} END").alias("_box"),
        F.expr(f"CASE WHEN _sound THEN {_centroid_sql('_shape')} END").alias("_centre"),
        "_sound",
    )
    sides = [F.col(f"_box.{c}").alias(c) for c in BOX]
    centre = [F.col(f"_centre.{c}").alias(f"centroid_{c}") for c in ("lon", "lat")]
    return known.select(*df.columns, *sides, *centre, F.col("_sound").alias("geometry_sound"))


def read_outline(df: DataFrame, column: str) -> Column:
    """A stored outline column of ``df``; raises where the text could not be read."""
    error = F.raise_error(F.concat(F.lit("cannot parse geometry of "), F.col("geography_id")))
    return F.when(~F.col("geometry_sound"), error.cast(df.schema[column].dataType)).otherwise(F.col(column))


def within(df: DataFrame, min_lon: float, min_lat: float, max_lon: float, max_lat: float) -> DataFrame:
    """Rows of a stored layer whose box meets the given one.

    Plain comparisons with stored columns: files whose statistics lie outside are not read.
    """
    across = (F.col("min_lon") <= max_lon) & (F.col("max_lon") >= min_lon)
    return df.filter(across & (F.col("min_lat") <= max_lat) & (F.col("max_lat") >= min_lat))


def selection_bounds(df: DataFrame, wkt: str = "geometry_wkt", by=()) -> DataFrame:
    """One box over all rows (or per group): min / max of the per-row boxes.

    Only four numbers per row reach the aggregate, and it combines map-side. Stored boxes are
    read where ``df`` has them, else the text is parsed.
    """
    if set(OUTLINE) <= set(df.columns):
        boxes = df.select(*by, *(read_outline(df, c).alias(c) for c in BOX))
    else:
        boxes = df.select(*by, bounding_box(wkt).alias("box")).select(*by, *(f"box.{c}" for c in BOX))
    ends = {c: F.min if c.startswith("min") else F.max for c in BOX}
    return boxes.groupBy(*by).agg(*(end(c).alias(c) for c, end in ends.items()))
