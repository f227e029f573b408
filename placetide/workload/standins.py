"""Survey, boundary and flow data derived from the test tables.

States are nations, counties are a nation's market segments, tracts are customers. A
place's survey measures summarise the orders of a year; flows run from the customer's to
the supplier's place by shipping year. Each builder has its SQL twin for the result check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetide.plans import layers, marts
from placetide.schemas import MEASURES
from placetide.workload.registry import Tables

# Years with boundaries; survey years run from 1995, so the join drops some.
BOUNDARY_YEARS = (1996, 2001)
INGEST_DATE = "2002-01-01"
SUPPRESS_BELOW = 4
# Places whose outlines one task draws, each once a boundary year.
PLACES_PER_TASK = 5000

# Additive parts of the measures, per customer and year (same text in both engines).
PARTS = {
    "n": "count(*)",
    "day_sum": "sum(day(o_orderdate))",
    "urgent": "count_if(o_orderpriority = '1-URGENT')",
    "high": "count_if(o_orderpriority = '2-HIGH')",
    "medium": "count_if(o_orderpriority = '3-MEDIUM')",
    "unspecified": "count_if(o_orderpriority = '4-NOT SPECIFIED')",
    "cents": "sum(CAST(round(o_totalprice * 100) AS BIGINT))",
    "poor": "count_if(o_totalprice < 100000)",
    "adults": "count_if(o_orderstatus IN ('F', 'O'))",
    "ba": "count_if(o_orderstatus = 'F' AND month(o_orderdate) <= 3)",
    "ma": "count_if(o_orderstatus = 'F' AND month(o_orderdate) BETWEEN 4 AND 6)",
    "prof": "count_if(o_orderstatus = 'F' AND month(o_orderdate) BETWEEN 7 AND 9)",
    "phd": "count_if(o_orderstatus = 'F' AND month(o_orderdate) >= 10)",
    "hs": "count_if(o_orderstatus = 'O')",
    "nohs": "count_if(o_orderstatus = 'P')",
    "owner": "count_if(o_totalprice >= 250000)",
    "workers": "count_if(day(o_orderdate) <= 20)",
    "drove": "count_if(day(o_orderdate) <= 10)",
    "walked": "count_if(day(o_orderdate) BETWEEN 11 AND 14)",
    "remote": "count_if(day(o_orderdate) BETWEEN 15 AND 20)",
    "top_cents": "max(CAST(round(o_totalprice * 100) AS BIGINT))",
    "low_cents": "min(CAST(round(o_totalprice * 100) AS BIGINT))",
}

_ROLL = {"top_cents": "max", "low_cents": "min"}

# Measures over the rolled-up parts. {div} is whole-number division.
FROM_PARTS = {
    "total_population": "n",
    "median_age": "CAST(day_sum AS DOUBLE) / n",
    "white_alone_not_hispanic": "urgent",
    "black_alone_not_hispanic": "high",
    "asian_alone_not_hispanic": "medium",
    "hispanic_or_latino": "unspecified",
    "median_household_income": "cents {div} (n * 100)",
    "poverty_total": "n",
    "below_poverty_level": "poor",
    "education_total_25y_plus": "adults",
    "bachelors_degree": "ba",
    "masters_degree": "NULLIF(ma, 0)",
    "professional_degree": "prof",
    "doctorate_degree": "phd",
    "high_school_diploma": "hs",
    "no_high_school_diploma": "nohs",
    "median_home_value": "top_cents {div} 100",
    "total_occupied": "n",
    "owner_occupied": "owner",
    "renter_occupied": "n - owner",
    "median_gross_rent": "low_cents {div} 100",
    "migration_total": "n",
    "commute_total_workers_16_plus": "workers",
    "drove_alone_to_work": "drove",
    "walked_to_work": "walked",
    "worked_from_home": "remote",
}

# County code of a market segment and of a supplier, without padding (same text in both).
SEGMENT_CODE = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '3' WHEN 'FURNITURE' THEN '5' "
    "WHEN 'HOUSEHOLD' THEN '7' ELSE '9' END"
)
SUPPLIER_CODE = "CAST(1 + 2 * (s_suppkey % 5) AS STRING)"

PLACE_KEYS = {
    "states": ["c_nationkey", "n_name"],
    "counties": ["c_nationkey", "n_name", "c_mktsegment"],
    "tracts": ["c_nationkey", "n_name", "c_mktsegment", "c_custkey", "c_name"],
}
PLACE_NAME = {
    "states": "n_name",
    "counties": "n_name || ' ' || c_mktsegment",
    "tracts": "c_name",
}


# --- survey ---------------------------------------------------------------------------


def survey_parts(t: Tables) -> DataFrame:
    """Parts per customer and year. Orders are summed before the join: one row per key and
    map task is shuffled, whatever the key skew."""
    parts = [F.expr(f"CAST({e} AS BIGINT) AS {n}") for n, e in PARTS.items()]
    return t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("survey_year")).agg(*parts)


def survey_bronze(t: Tables, level: str) -> DataFrame:
    """Survey rows as landed: all text, codes without padding."""
    # Merged: a few MB of file hold a million customers, too many to gather on the driver.
    people = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").hint("merge")
    rolled = survey_parts(t).join(people, F.col("o_custkey") == F.col("c_custkey"))
    if level != "tracts":
        # A tract is one customer, so only the wider levels are summed again.
        keys = ["c_nationkey", *(["c_mktsegment"] if level == "counties" else [])]
        rolled = rolled.groupBy(*keys, "survey_year").agg(
            *(F.expr(f"{_ROLL.get(p, 'sum')}({p}) AS {p}") for p in PARTS)
        )
    names = t.nation.select("n_nationkey", "n_name")
    rolled = rolled.join(names, F.col("c_nationkey") == F.col("n_nationkey"))
    measures = [F.expr(f"CAST({FROM_PARTS[m].format(div='div')} AS STRING) AS {m}") for m in MEASURES]
    codes = [F.col("c_nationkey").cast("string").alias("state")]
    if level != "states":
        codes.append(F.expr(SEGMENT_CODE).alias("county"))
    if level == "tracts":
        codes.append(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("tract"))
    return rolled.select(F.expr(PLACE_NAME[level]).alias("NAME"), *measures, *codes, F.col("survey_year").cast("bigint"))


def survey(t: Tables, level: str) -> DataFrame:
    return layers.survey_silver(survey_bronze(t, level), level)


_LEVEL_SQL = {
    "states": ("NULL", "NULL", "lpad(CAST(c_nationkey AS STRING), 2, '0')"),
    "counties": (
        f"lpad({SEGMENT_CODE}, 3, '0')",
        "NULL",
        f"lpad(CAST(c_nationkey AS STRING), 2, '0') || lpad({SEGMENT_CODE}, 3, '0')",
    ),
    "tracts": (
        f"lpad({SEGMENT_CODE}, 3, '0')",
        "lpad(CAST(c_custkey AS STRING), 6, '0')",
        f"lpad(CAST(c_nationkey AS STRING), 2, '0') || lpad({SEGMENT_CODE}, 3, '0') || lpad(CAST(c_custkey AS STRING), 6, '0')",
    ),
}


def survey_sql(level: str, name: str = "survey") -> str:
    """CTEs ``<name>_parts, <name>``: typed survey rows."""
    county, tract, place = _LEVEL_SQL[level]
    keys = ", ".join(PLACE_KEYS[level])
    parts = ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in PARTS.items())
    rolled = ", ".join(f"CAST({_ROLL.get(p, 'sum')}({p}) AS BIGINT) AS {p}" for p in PARTS)
    measures = ", ".join(
        f"CAST({FROM_PARTS[m].format(div='//')} AS {'DOUBLE' if m == 'median_age' else 'BIGINT'}) AS {m}"
        for m in MEASURES
    )
    return f"""{name}_parts AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS survey_year, {parts} FROM orders GROUP BY 1, 2),
{name}_rolled AS (
  SELECT {keys}, survey_year, {rolled} FROM {name}_parts
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY {keys}, survey_year),
{name} AS (
  SELECT {PLACE_NAME[level]} AS geography_name, lpad(CAST(c_nationkey AS STRING), 2, '0') AS state_fips,
    CAST({county} AS STRING) AS county_fips, CAST({tract} AS STRING) AS tract_fips, {place} AS geography_id,
    survey_year, {measures} FROM {name}_rolled)"""


# --- boundaries -----------------------------------------------------------------------

# Four outlines around a corner (x, y): polygons > rings > offsets from the corner.
_SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
_HOLE = [(1, 1), (2, 1), (2, 3), (1, 3), (1, 1)]
_BESIDE = [(6, 0), (8, 0), (8, 2), (6, 2), (6, 0)]
_BACKWARD = [(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)]
SHAPES = (
    (False, [[_SQUARE]]),
    (False, [[_SQUARE, _HOLE]]),
    (True, [[_SQUARE], [_BESIDE]]),
    (False, [[_BACKWARD]]),
)
# Centroids worked out by hand, for the result check.
SHAPE_CENTROIDS = (
    ("x + 2.0", "y + 2.0"),
    ("(16 * (x + 2.0) - 2 * (x + 1.5)) / 14", "y + 2.0"),
    ("(16 * (x + 2.0) + 4 * (x + 7.0)) / 20", "(16 * (y + 2.0) + 4 * (y + 1.0)) / 20"),
    ("x + 1.0", "y + 1.0"),
)


def _shape_text(shape, point, pair_sep, open_, close, wrap) -> str:
    """SQL text expression of a shape from its offsets."""
    out = []
    for polygon in shape:
        rings = []
        for ring in polygon:
            points = f" || '{pair_sep}' || ".join(point(dx, dy) for dx, dy in ring)
            rings.append(f"'{open_}' || {points} || '{close}'")
        joined = f" || '{pair_sep}' || ".join(rings)
        out.append(f"'{open_}' || {joined} || '{close}'" if wrap else joined)
    return f" || '{pair_sep}' || ".join(out)


def _by_shape(build) -> str:
    cases = " ".join(f"WHEN {i} THEN {build(i)}" for i in range(len(SHAPES)))
    return f"CASE k % {len(SHAPES)} {cases} END"


def _wkt_point(dx: int, dy: int) -> str:
    return f"CAST(x + {dx} AS STRING) || ' ' || CAST(y + {dy} AS STRING)"


def _json_point(dx: int, dy: int) -> str:
    return f"'[' || CAST(x + {dx} AS STRING) || '.0,' || CAST(y + {dy} AS STRING) || '.0]'"


def _wkt(i: int) -> str:
    multi, shape = SHAPES[i]
    body = _shape_text(shape, _wkt_point, ", ", "(", ")", True)
    return f"'MULTIPOLYGON (' || {body} || ')'" if multi else f"'POLYGON ' || {body}"


def _geojson(i: int) -> str:
    multi, shape = SHAPES[i]
    body = _shape_text(shape, _json_point, ",", "[", "]", True)
    if multi:
        return f"'{{\"type\":\"MultiPolygon\",\"coordinates\":[' || {body} || ']}}'"
    return f"'{{\"type\":\"Polygon\",\"coordinates\":' || {body} || '}}'"


X, Y = "CAST((k * 7) % 300 - 150 AS INTEGER)", "CAST((k * 3) % 120 - 60 AS INTEGER)"
# One place in fifty has no outline, one an empty one.
WKT = f"CASE WHEN k % 50 = 49 THEN NULL WHEN k % 50 = 48 THEN 'POLYGON EMPTY' ELSE {_by_shape(_wkt)} END"
GEOJSON = (
    "CASE WHEN k % 50 = 49 THEN 'null' WHEN k % 50 = 48 THEN '{\"type\":\"Polygon\",\"coordinates\":[]}' "
    f"ELSE {_by_shape(_geojson)} END"
)
CENTROID_LON = f"CASE WHEN k % 50 >= 48 THEN NULL ELSE {_by_shape(lambda i: SHAPE_CENTROIDS[i][0])} END"
CENTROID_LAT = f"CASE WHEN k % 50 >= 48 THEN NULL ELSE {_by_shape(lambda i: SHAPE_CENTROIDS[i][1])} END"

_PLACE_ROWS = {
    "states": "SELECT CAST(n_nationkey AS BIGINT) AS k, n_nationkey AS nk, NULL AS county, NULL AS tract, n_name AS nm FROM nation",
    "counties": f"SELECT DISTINCT CAST(c_nationkey * 10 AS BIGINT) + CAST({SEGMENT_CODE} AS BIGINT) AS k, c_nationkey AS nk, "
    f"{SEGMENT_CODE} AS county, NULL AS tract, c_mktsegment AS nm FROM customer",
    "tracts": f"SELECT c_custkey AS k, c_nationkey AS nk, {SEGMENT_CODE} AS county, lpad(CAST(c_custkey AS STRING), 6, '0') AS tract, "
    "c_name AS nm FROM customer",
}


def _spread(places: DataFrame) -> DataFrame:
    """Places dealt to as many tasks as their number asks for.

    A million of them lie in one or two splits of a file, and so would all their outlines.
    """
    parts = -(-places.count() // PLACES_PER_TASK)
    if parts < 2:
        return places
    # The row number keeps a filter on an outline from being put before the deal.
    dealt = places.repartition(parts, "k").withColumn("_at", F.monotonically_increasing_id())
    return dealt.filter("_at >= 0").drop("_at")


def boundary_bronze(t: Tables, level: str) -> DataFrame:
    """Boundary rows as landed, one per place and boundary year."""
    if level == "states":
        places = t.nation.select(
            F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_nationkey").alias("nk"),
            F.lit(None).cast("string").alias("county"), F.lit(None).cast("string").alias("tract"), F.col("n_name").alias("nm"),
        )
    else:
        code = F.expr(SEGMENT_CODE)
        tract = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
        county_key = F.col("c_nationkey").cast("bigint") * 10 + code.cast("bigint")
        tracts = level == "tracts"
        places = t.customer.select(
            (F.col("c_custkey") if tracts else county_key).alias("k"),
            F.col("c_nationkey").alias("nk"),
            code.alias("county"),
            (tract if tracts else F.lit(None).cast("string")).alias("tract"),
            F.col("c_name" if tracts else "c_mktsegment").alias("nm"),
        )
        places = _spread(places) if tracts else places.distinct()
    state = F.lpad(F.col("nk").cast("string"), 2, "0")
    county = F.lpad("county", 3, "0")
    # The outline is built once per place, ahead of the repetition over years.
    drawn = places.withColumns({"x": F.expr(X), "y": F.expr(Y)}).withColumn("geometry_wkt", F.expr(WKT))
    return drawn.select(
        state.alias("STATEFP"),
        county.alias("COUNTYFP"),
        F.col("tract").alias("TRACTCE"),
        F.concat_ws("", state, county, F.col("tract")).alias("GEOID"),
        F.col("nm").alias("NAME"),
        F.col("nm").alias("NAMELSAD"),
        F.lit("G4020").alias("MTFCC"),
        F.lit("A").alias("FUNCSTAT"),
        (F.col("k") * 1000 + 17).alias("ALAND"),
        F.col("k").alias("AWATER"),
        F.col("y").cast("string").alias("INTPTLAT"),
        F.col("x").cast("string").alias("INTPTLON"),
        "geometry_wkt",
        F.explode(F.sequence(*(F.lit(y).cast("bigint") for y in BOUNDARY_YEARS))).alias("survey_year"),
    ).withColumn("ingest_date", F.lit(INGEST_DATE))


def boundary(t: Tables, level: str) -> DataFrame:
    return layers.boundary_silver(boundary_bronze(t, level))


def boundary_sql(level: str, name: str = "boundary") -> str:
    """CTEs ``<name>_places, <name>`` with the outline, its corner and place key ``k``."""
    place = "lpad(CAST(nk AS STRING), 2, '0')"
    if level != "states":
        place += " || lpad(county, 3, '0')"
    if level == "tracts":
        place += " || tract"
    return f"""{name}_places AS ({_PLACE_ROWS[level]}),
{name}_corners AS (SELECT *, {X} AS x, {Y} AS y FROM {name}_places),
{name} AS (
  SELECT {place} AS geography_id, CAST(yr AS INTEGER) AS survey_year, nm AS geography_name, k, x, y,
    k * 1000 + 17 AS ALAND, k AS AWATER, {WKT} AS geometry_wkt
  FROM {name}_corners CROSS JOIN range({BOUNDARY_YEARS[0]}, {BOUNDARY_YEARS[1] + 1}) AS years(yr))"""


# --- gold and marts -------------------------------------------------------------------


def gold(t: Tables, level: str) -> DataFrame:
    return layers.place_gold(survey(t, level), boundary(t, level))


def gold_sql(level: str, name: str = "gold") -> str:
    survey_cols = ", ".join(f"s.{m}" for m in MEASURES)
    return f"""{survey_sql(level, name + "_s")},
{boundary_sql(level, name + "_b")},
{name} AS (
  SELECT s.geography_id, s.survey_year, s.geography_name, s.state_fips, s.county_fips, s.tract_fips, {survey_cols},
    b.ALAND, b.AWATER, b.geometry_wkt, b.k, b.x, b.y
  FROM {name}_s s JOIN {name}_b b ON s.geography_id = b.geography_id AND s.survey_year = b.survey_year)"""


def mart(t: Tables, level: str) -> DataFrame:
    return marts.socioeconomic_mart(gold(t, level), level)


def rate_sql(numerator: str, denominator: str) -> str:
    return f"floor(CAST({numerator} AS DOUBLE) / NULLIF({denominator}, 0) * 100 * 100.0 + 0.5) / 100.0"


_RATE_SQL = {
    "pct_white_alone": ("white_alone_not_hispanic", "total_population"),
    "pct_black_alone": ("black_alone_not_hispanic", "total_population"),
    "pct_asian_alone": ("asian_alone_not_hispanic", "total_population"),
    "pct_hispanic_or_latino": ("hispanic_or_latino", "total_population"),
    "poverty_rate": ("below_poverty_level", "poverty_total"),
    "bachelors_plus_rate": (
        "(bachelors_degree + masters_degree + professional_degree + doctorate_degree)",
        "education_total_25y_plus",
    ),
    "high_school_rate": ("high_school_diploma", "education_total_25y_plus"),
    "owner_occupancy_rate": ("owner_occupied", "total_occupied"),
    "renter_rate": ("renter_occupied", "total_occupied"),
    "drove_alone_rate": ("drove_alone_to_work", "commute_total_workers_16_plus"),
    "walked_to_work_rate": ("walked_to_work", "commute_total_workers_16_plus"),
    "remote_work_rate": ("worked_from_home", "commute_total_workers_16_plus"),
}


def mart_sql(level: str, name: str = "mart") -> str:
    codes = {"states": "state_fips", "counties": "state_fips, county_fips", "tracts": "state_fips, county_fips, tract_fips"}
    rates = ", ".join(f"{rate_sql(a, b)} AS {r}" for r, (a, b) in _RATE_SQL.items())
    centre = f", {CENTROID_LAT} AS centroid_lat, {CENTROID_LON} AS centroid_lon" if level == "states" else ""
    return f"""{gold_sql(level, name + "_g")},
{name} AS (
  SELECT geography_id, survey_year, geography_name, {codes[level]}, total_population, median_age,
    median_household_income, median_home_value, median_gross_rent, {rates}, geometry_wkt, ALAND, AWATER{centre}
  FROM {name}_g)"""


# --- flows ----------------------------------------------------------------------------


def edges(t: Tables, level: str) -> DataFrame:
    """Line items summed by origin place, destination place and shipping year.

    Only the five needed columns of line items are shuffled, once, for the order join.
    """
    county = level == "counties"
    lines = t.lineitem.select(
        "l_orderkey",
        "l_suppkey",
        F.year("l_shipdate").alias("survey_year"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.expr("CAST(round(l_extendedprice * 100) AS BIGINT)").alias("cents"),
    )
    sellers = t.supplier.select("s_suppkey", "s_nationkey", F.expr(SUPPLIER_CODE).alias("s_county"))
    buyers = t.orders.select("o_orderkey", "o_custkey").join(
        t.customer.select("c_custkey", "c_nationkey", F.expr(SEGMENT_CODE).alias("c_county")),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    joined = lines.join(sellers, F.col("l_suppkey") == F.col("s_suppkey")).join(
        buyers, F.col("l_orderkey") == F.col("o_orderkey")
    )
    keys = ["c_nationkey", "s_nationkey", *(["c_county", "s_county"] if county else []), "survey_year"]
    summed = joined.groupBy(*keys).agg(
        F.count("*").alias("households"), F.sum("qty").alias("individuals"), F.sum("cents").alias("cents")
    )
    names = t.nation.select("n_nationkey", "n_name")
    return summed.join(names, F.col("s_nationkey") == F.col("n_nationkey"))


def flow_bronze(t: Tables, level: str) -> DataFrame:
    """Flow rows as landed: text, thin flows withheld, and total rows (96 all, 97 other
    states, 58 same state) beside the real ones."""
    county = level == "counties"
    own = F.col("c_nationkey") == F.col("s_nationkey")
    code = F.col("s_nationkey").cast("string")
    lanes = F.array(code, F.lit("96"), F.when(own, "58").otherwise("97"))
    rows = edges(t, level).withColumn("dest", F.explode(lanes))
    real = F.col("dest") == code
    rows = rows.withColumn("dest_name", F.when(real, F.col("n_name")).otherwise(F.lit("Total")))
    group = ["c_nationkey", "dest", "dest_name", "survey_year"]
    if county:
        rows = rows.withColumn("dest_county", F.when(real, F.col("s_county")).otherwise(F.lit("0")))
        group += ["c_county", "dest_county"]
    summed = rows.groupBy(*group).agg(*(F.sum(c).alias(c) for c in ("households", "individuals", "cents")))
    withheld = F.col("households") < SUPPRESS_BELOW
    cols = [F.col("c_nationkey").cast("string").alias("y1_statefips")]
    if county:
        cols.append(F.col("c_county").alias("y1_countyfips"))
    cols.append(F.col("dest").alias("y2_statefips"))
    if county:
        cols.append(F.col("dest_county").alias("y2_countyfips"))
    return summed.select(
        *cols,
        F.concat(F.lit("N"), F.col("dest")).alias("y2_state"),
        F.col("dest_name").alias("y2_countyname" if county else "y2_state_name"),
        F.when(withheld, "-1").otherwise(F.col("households").cast("string")).alias("n1"),
        F.when(withheld, "-1").otherwise(F.col("individuals").cast("string")).alias("n2"),
        F.expr("cents div 100").cast("string").alias("agi" if county else "AGI"),
        F.col("survey_year").cast("bigint"),
    )


def flows(t: Tables, level: str) -> DataFrame:
    return layers.flow_silver(flow_bronze(t, level), level)


def flows_gold(t: Tables, level: str) -> DataFrame:
    return layers.flow_gold(flows(t, level))


def flows_sql(level: str, name: str = "flows") -> str:
    """CTE ``<name>``: gold flow rows (silver columns and the flag), withheld ones gone."""
    county = level == "counties"
    keys = "c_nationkey, s_nationkey, n_name, yr" + (f", {SEGMENT_CODE}, {SUPPLIER_CODE}" if county else "")
    extra = f", {SEGMENT_CODE} AS c_county, {SUPPLIER_CODE} AS s_county" if county else ""
    tail1 = " || lpad(c_county, 3, '0')" if county else ""
    tail2 = " || lpad(s_county, 3, '0')" if county else ""
    return f"""{name}_lines AS (
  SELECT *, CAST(year(l_shipdate) AS INTEGER) AS yr FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON s_nationkey = n_nationkey),
{name}_edges AS (
  SELECT c_nationkey, s_nationkey, n_name, yr AS survey_year{extra}, count(*) AS households,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS individuals,
    CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM {name}_lines GROUP BY {keys}),
{name} AS (
  SELECT lpad(CAST(c_nationkey AS STRING), 2, '0'){tail1} AS origin_geography_id,
    lpad(CAST(s_nationkey AS STRING), 2, '0'){tail2} AS dest_geography_id,
    'N' || CAST(s_nationkey AS STRING) AS dest_state, n_name AS dest_name, households, individuals,
    cents // 100 AS agi, survey_year,
    (c_nationkey = s_nationkey{" AND c_county = s_county" if county else ""}) AS is_non_migrant
  FROM {name}_edges WHERE households >= {SUPPRESS_BELOW})"""


def flow_mart(t: Tables, level: str) -> DataFrame:
    return marts.flow_mart(flows_gold(t, level), mart(t, level), level)


def flow_mart_sql(level: str, name: str = "fm") -> str:
    if level == "states":
        context = [
            ("geography_name", "state_name"), ("total_population", "total_population"),
            ("median_household_income", "median_income"), ("poverty_rate", "poverty_rate"),
            ("remote_work_rate", "remote_work_rate"), ("centroid_lat", "lat"), ("centroid_lon", "lon"),
        ]
    else:
        context = [
            ("geography_name", "county_name"), ("state_fips", "state_fips"), ("total_population", "total_population"),
            ("median_household_income", "median_income"), ("poverty_rate", "poverty_rate"),
        ]
    cols = ", ".join(f"{a}.{c} AS {role}_{n}" for a, role in (("o", "origin"), ("d", "dest")) for c, n in context)
    return f"""{flows_sql(level, name + "_f")},
{mart_sql(level, name + "_m")},
{name} AS (
  SELECT f.origin_geography_id, f.dest_geography_id, f.survey_year, f.households, f.individuals, f.agi, f.is_non_migrant,
    {cols}, d.median_household_income - o.median_household_income AS income_differential,
    floor(CAST(f.agi AS DOUBLE) / NULLIF(f.households, 0) * 100.0 + 0.5) / 100.0 AS agi_per_household
  FROM {name}_f f
  LEFT JOIN {name}_m o ON f.origin_geography_id = o.geography_id AND f.survey_year = o.survey_year
  LEFT JOIN {name}_m d ON f.dest_geography_id = d.geography_id AND f.survey_year = d.survey_year
  WHERE NOT f.is_non_migrant)"""
