"""Landing, typing, gold, marts and flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from placetide.functions import geo
from placetide.functions import keys as K
from placetide.functions.geo import bounding_box, centroid, polygons, selection_bounds
from placetide.functions.numeric import haversine_distance, round_half_away, share
from placetide.functions.text import display_value, legend_labels
from placetide.operators.scale import arc_width, percentile_bounds
from placetide.plans import layers, marts, serving
from placetide.schemas import MEASURES, METRICS, SUPPRESSED_TEXT
from placetide.sources import geojson, storage
from placetide.sources.landing import explode_header_json
from placetide.sources.storage import create_view
from placetide.workload import standins as S
from placetide.workload.registry import query

YEAR = 1998
MIN_FLOW = 6


# --- landing and typing -----------------------------------------------------------------


@query(
    "json_header_rows",
    """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name AS name, CAST(c_custkey AS STRING) AS total_population,
       CAST(c_nationkey AS STRING) AS state, CAST(NULL AS STRING) AS county FROM customer""",
)
def json_header_rows(t):
    """One header document per customer; half of them list their columns in another order."""
    name, pop, state = F.col("c_name"), F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    plain = F.array(F.array(F.lit("NAME"), F.lit("B01001_001E"), F.lit("state")), F.array(name, pop, state))
    turned = F.array(F.array(F.lit("state"), F.lit("NAME"), F.lit("B01001_001E")), F.array(state, name, pop))
    docs = t.customer.select(
        "c_custkey", F.to_json(F.when(F.col("c_custkey") % 2 == 0, plain).otherwise(turned)).alias("doc")
    )
    rows = explode_header_json(docs, "doc", ["NAME", "B01001_001E", "state", "county"], keep=["c_custkey"])
    return layers.rename_variables(rows).withColumnRenamed("NAME", "name")


@query(
    "rename_map",
    f"""SELECT o_orderstatus, {S.PARTS['n']} AS total_population,
       CAST(floor(max(o_totalprice)) AS BIGINT) AS median_home_value FROM orders GROUP BY o_orderstatus""",
)
def rename_map(t):
    coded = t.orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("B01001_001E"), F.floor(F.max("o_totalprice")).alias("B25077_001E")
    )
    return layers.rename_variables(coded)


@query("typed_cast", f"WITH {S.survey_sql('tracts')} SELECT geography_id, survey_year, {', '.join(MEASURES)} FROM survey")
def typed_cast(t):
    return S.survey(t, "tracts").select("geography_id", "survey_year", *MEASURES)


@query(
    "typed_cast_lenient",
    """SELECT user_id, CAST(count(*) AS BIGINT) AS events, CAST(count(try_cast(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS typed,
       CAST(sum(try_cast(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY user_id""",
)
def typed_cast_lenient(t):
    whole = F.get_json_object("props", "$.k").try_cast("bigint")
    return t.events.groupBy("user_id").agg(F.count("*").alias("events"), F.count(whole).alias("typed"), F.sum(whole).alias("total"))


@query(
    "fips_ids",
    f"""SELECT c_custkey, lpad(CAST(c_nationkey AS STRING), 2, '0') AS state_id,
       lpad(CAST(c_nationkey AS STRING), 2, '0') || lpad({S.SEGMENT_CODE}, 3, '0') AS county_id,
       lpad(CAST(c_nationkey AS STRING), 2, '0') || lpad({S.SEGMENT_CODE}, 3, '0') || CAST(c_custkey AS STRING) AS tract_id
       FROM customer""",
)
def fips_ids(t):
    coded = t.customer.select(
        "c_custkey",
        F.col("c_nationkey").cast("string").alias("state"),
        F.expr(S.SEGMENT_CODE).alias("county"),
        F.col("c_custkey").cast("string").alias("tract"),
    )
    return coded.select(
        "c_custkey",
        K.geography_id("states").alias("state_id"),
        K.geography_id("counties").alias("county_id"),
        K.geography_id("tracts").alias("tract_id"),
    )


for _level in ("states", "counties"):
    query(f"silver_flows_{_level}", f"""WITH {S.flows_sql(_level)} SELECT origin_geography_id, dest_geography_id, dest_state, dest_name,
        households, individuals, agi, survey_year FROM flows""")(lambda t, level=_level: S.flows(t, level))


@query(
    "code_filter",
    f"""WITH {S.flows_sql('states')},
    totals AS (SELECT c_nationkey, survey_year, s_nationkey = c_nationkey AS own, sum(households) AS h FROM flows_edges GROUP BY ALL),
    coded AS (
      SELECT survey_year, 96 AS code, sum(h) AS households FROM totals GROUP BY survey_year, c_nationkey
      UNION ALL SELECT survey_year, CASE WHEN own THEN 58 ELSE 97 END, h FROM totals)
    SELECT CAST(code AS INTEGER) AS code, survey_year, CAST(count(*) AS BIGINT) AS dropped FROM (
      SELECT code, survey_year FROM coded
      UNION ALL SELECT more.code, survey_year FROM coded, (VALUES (57), (59), (98), (NULL)) more(code) WHERE coded.code = 96)
    GROUP BY code, survey_year""",
)
def code_filter(t):
    """Rows the total-code filter drops, by code and year; every total code and NULL occur, and
    99, which is none."""
    bronze = S.flow_bronze(t, "states").withColumns({"n1": F.lit("5"), "n2": F.lit("9")})
    more = bronze.filter("y2_statefips = '96'").withColumn(
        "y2_statefips", F.explode(F.array(*[F.lit(c) for c in ("57", "59", "98", "99", None)]))
    )
    landed = bronze.unionByName(more)
    # What was landed counts up, what the filter leaves counts down.
    both = [
        df.select(F.col("y2_statefips").cast("int").alias("code"), F.col("survey_year").cast("int").alias("survey_year"), F.lit(n).alias("n"))
        for df, n in ((landed, 1), (layers.real_flows(landed), -1))
    ]
    return both[0].unionByName(both[1]).groupBy("code", "survey_year").agg(F.sum("n").alias("dropped")).filter("dropped > 0")


@query(
    "suppressed_filter",
    f"""WITH {S.flows_sql('states')}, marked AS (SELECT *, households < {S.SUPPRESS_BELOW} OR households % 7 = 0 AS gone FROM flows_edges)
       SELECT survey_year, CAST(count_if(gone) AS BIGINT) AS withheld, CAST(count_if(NOT gone) AS BIGINT) AS kept FROM marked GROUP BY survey_year""",
)
def suppressed_filter(t):
    """Withheld flows by year; in some only the second count is withheld, in some it is NULL."""
    bronze = S.flow_bronze(t, "states")
    seventh = F.col("n1").cast("bigint") % 7 == 0
    n2 = F.when(seventh & (F.col("n1").cast("bigint") % 2 == 0), F.lit(None)).when(seventh, SUPPRESSED_TEXT).otherwise(F.col("n2"))
    real = bronze.withColumn("n2", n2).filter(~F.col("y2_statefips").cast("int").isin(96, 97, 58))
    year = F.col("survey_year").cast("int").alias("survey_year")
    landed, left = (df.select(year, F.lit(k).alias("left")) for df, k in ((real, 0), (layers.real_flows(real), 1)))
    n, kept = F.count_if(F.col("left") == 0), F.count_if(F.col("left") == 1)
    return landed.unionByName(left).groupBy("survey_year").agg((n - kept).alias("withheld"), kept.alias("kept"))


@query(
    "geometry_rejects",
    f"""WITH {S.boundary_sql('tracts')}, kinds AS (
         SELECT survey_year, k % 8 = 3 OR coalesce(k % 8 IN (2, 5) AND geometry_wkt IS NOT NULL OR k % 8 = 4 AND geometry_wkt NOT LIKE '%EMPTY', false) AS bad FROM boundary)
       SELECT survey_year, CAST(count_if(NOT bad) AS BIGINT) AS drawn_or_absent, CAST(count_if(bad) AS BIGINT) AS rejected
       FROM kinds GROUP BY survey_year""",
)
def geometry_rejects(t):
    """Outlines that can be read, EMPTY, NULL and damaged in several ways: none is lost silently."""
    wkt, kind = F.col("geometry_wkt"), F.col("AWATER") % 8
    damaged = (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.lit("MULTIPOLYGON EMPTY"))
        .when(kind == 2, F.substring(wkt, F.lit(1), F.length(wkt) - 1))
        .when(kind == 3, F.lit("POINT (1 2)"))
        .when(kind == 4, F.regexp_replace(wkt, "[0-9]+", "x"))
        .when(kind == 5, F.concat(wkt, F.lit(" tail")))
        .otherwise(wkt)
    )
    rows = S.boundary(t, "tracts").withColumn("geometry_wkt", damaged)
    sound, rejected = geo.split_unsound(rows)
    # The sound ones are drawn, which raises on any text that cannot be read.
    drawn = sound.select("survey_year", geo.geojson_geometry("geometry_wkt").alias("g")).filter("g IS NOT NULL")
    both = drawn.select("survey_year", F.lit(1).alias("ok")).unionByName(rejected.select("survey_year", F.lit(0).alias("ok")))
    return both.groupBy("survey_year").agg(F.count_if(F.col("ok") == 1).alias("drawn_or_absent"), F.count_if(F.col("ok") == 0).alias("rejected"))


# --- gold and marts -----------------------------------------------------------------------


@query(
    "boundary_rename",
    f"""WITH {S.boundary_sql('tracts')} SELECT geography_id, survey_year, geography_name, substr(geography_id, 1, 2) AS state_fips,
       ALAND, AWATER, CAST(y AS STRING) AS intptlat, CAST(x AS STRING) AS intptlon, geometry_wkt FROM boundary""",
)
def boundary_rename(t):
    return S.boundary(t, "tracts").select(
        "geography_id", "survey_year", "geography_name", "state_fips", "ALAND", "AWATER", "intptlat", "intptlon", "geometry_wkt"
    )


for _level in ("states", "counties", "tracts"):
    query(f"node_join_{_level}", f"""WITH {S.gold_sql(_level)} SELECT geography_id, survey_year, geography_name, state_fips, county_fips,
        tract_fips, {', '.join(MEASURES)}, ALAND, AWATER, geometry_wkt FROM gold""")(lambda t, level=_level: S.gold(t, level).drop(*geo.OUTLINE))

query("mart_states", f"""WITH {S.mart_sql('states')} SELECT * REPLACE (floor(centroid_lat * 1e6 + 0.5) / 1e6 AS centroid_lat,
    floor(centroid_lon * 1e6 + 0.5) / 1e6 AS centroid_lon) FROM mart""")(
    lambda t: S.mart(t, "states").withColumns(
        {c: F.floor(F.col(c) * 1e6 + 0.5) / 1e6 for c in ("centroid_lat", "centroid_lon")}
    )
)
for _level in ("counties", "tracts"):
    query(f"mart_{_level}", f"WITH {S.mart_sql(_level)} SELECT * FROM mart")(lambda t, level=_level: S.mart(t, level))


@query(
    "staging_views",
    f"""WITH {S.gold_sql('counties')} SELECT survey_year, state_fips, CAST(count(*) AS BIGINT) AS places,
       CAST(sum(total_population) AS BIGINT) AS population FROM gold GROUP BY survey_year, state_fips""",
)
def staging_views(t):
    create_view(marts.staging_places(S.gold(t, "counties"), "counties"), "stg_acs_counties")
    return t.spark.sql(
        "SELECT survey_year, state_fips, count(*) AS places, sum(total_population) AS population "
        "FROM stg_acs_counties GROUP BY survey_year, state_fips"
    )


@query("non_migrant_flag", f"WITH {S.flows_sql('states')} SELECT * FROM flows")
def non_migrant_flag(t):
    return S.flows_gold(t, "states")


@query("non_migrant_flag_counties", f"WITH {S.flows_sql('counties')} SELECT * FROM flows")
def non_migrant_flag_counties(t):
    return S.flows_gold(t, "counties")


_SIX = "REPLACE (" + ", ".join(
    f"floor({c} * 1e6 + 0.5) / 1e6 AS {c}" for c in ("origin_lat", "origin_lon", "dest_lat", "dest_lon")
) + ")"


def _six_digits(df):
    return df.withColumns({c: F.floor(F.col(c) * 1e6 + 0.5) / 1e6 for c in ("origin_lat", "origin_lon", "dest_lat", "dest_lon")})


@query("flows_states", f"WITH {S.flow_mart_sql('states')} SELECT * {_SIX} FROM fm")
def flows_states(t):
    return _six_digits(S.flow_mart(t, "states"))


@query("flows_counties", f"WITH {S.flow_mart_sql('counties')} SELECT * FROM fm")
def flows_counties(t):
    return S.flow_mart(t, "counties")


# --- served queries -----------------------------------------------------------------------

_FLOW_COLS = ", ".join(serving.FLOW_COLUMNS)


@query(
    "flows_top",
    f"""WITH {S.flow_mart_sql('states')} SELECT {_FLOW_COLS} FROM (SELECT * {_SIX} FROM fm)
       WHERE survey_year = {YEAR} AND households >= {MIN_FLOW}
       ORDER BY households DESC, origin_geography_id, dest_geography_id LIMIT {serving.TOP_FLOWS}""",
)
def flows_top(t):
    return _six_digits(serving.flows(S.flow_mart(t, "states"), YEAR, min_households=MIN_FLOW))


@query(
    "flows_top_clamped",
    f"""WITH {S.flow_mart_sql('states')} SELECT {_FLOW_COLS} FROM (SELECT * {_SIX} FROM fm)
       WHERE survey_year = {YEAR} AND households >= {MIN_FLOW}
       ORDER BY households DESC, origin_geography_id, dest_geography_id LIMIT 200""",
)
def flows_top_clamped(t):
    """A year after the last one published shows the last one."""
    return _six_digits(serving.flows(S.flow_mart(t, "states"), YEAR + 5, min_households=MIN_FLOW, last_year=YEAR))


@query(
    "flows_either_end",
    f"""WITH {S.flow_mart_sql('states')} SELECT {_FLOW_COLS} FROM (SELECT * {_SIX} FROM fm)
       WHERE survey_year = {YEAR} AND households >= {MIN_FLOW} AND '06' IN (origin_geography_id, dest_geography_id)""",
)
def flows_either_end(t):
    return _six_digits(serving.flows(S.flow_mart(t, "states"), YEAR, state_fips="6", min_households=MIN_FLOW))


@query(
    "flow_records",
    f"""WITH {S.flows_sql('states')} SELECT '{{"origin_geography_id":"' || origin_geography_id || '","dest_geography_id":"' || dest_geography_id
       || '","survey_year":' || survey_year || ',"households":' || households || ',"is_non_migrant":' || is_non_migrant || ',"note":null}}' AS record FROM flows""",
)
def flow_records(t):
    rows = S.flows_gold(t, "states").select("origin_geography_id", "dest_geography_id", "survey_year", "households", "is_non_migrant")
    return geojson.records(rows.withColumn("note", F.lit(None).cast("string")))


def _scale_sql(metric: str, palette: str, source: str, keys: str) -> str:
    """Colour scale worked out with list arithmetic."""
    from placetide.schemas import PALETTES

    colours = [bytes.fromhex(c) for c in PALETTES[palette]]
    channels = [[float(c[i]) for c in colours] for i in range(3)]
    picks = ", ".join(
        f"CAST(floor({a}[seg + 1] + ({a}[seg + 2] - {a}[seg + 1]) * off + 1e-9) AS INTEGER) AS {n}"
        for a, n in zip((str(c) for c in channels), ("red", "green", "blue"))
    )
    return f"""vals AS (SELECT *, CAST(coalesce({metric}, 0) AS DOUBLE) AS v FROM {source}),
bounds AS (SELECT quantile_cont(v, 0.05) AS p5, quantile_cont(v, 0.95) AS p95 FROM vals),
normed AS (SELECT vals.*, p5, p95, CASE WHEN p95 > p5 THEN (least(greatest(v, p5), p95) - p5) / (p95 - p5) ELSE 0 END AS norm FROM vals, bounds),
placed AS (SELECT *, least(floor(norm * 256), 255) / 255 * 8 AS pos FROM normed),
segs AS (SELECT *, CAST(least(floor(pos), 7) AS INTEGER) AS seg, pos - least(floor(pos), 7) AS off FROM placed)
SELECT {keys}, floor(norm * 1e6 + 0.5) / 1e6 AS norm, floor(p5 * 1e4 + 0.5) / 1e4 AS scale_min, floor(p95 * 1e4 + 0.5) / 1e4 AS scale_max,
  {picks}, CAST(180 AS INTEGER) AS alpha FROM segs"""


def _scaled(df, *keys):
    colour = F.col("fill_color")
    return df.select(
        *keys,
        (F.floor(F.col("norm") * 1e6 + 0.5) / 1e6).alias("norm"),
        (F.floor(F.col("scale_min") * 1e4 + 0.5) / 1e4).alias("scale_min"),
        (F.floor(F.col("scale_max") * 1e4 + 0.5) / 1e4).alias("scale_max"),
        *(colour[i].alias(n) for i, n in enumerate(("red", "green", "blue", "alpha"))),
    )


def _slice(level: str, where: str) -> str:
    return f"WITH {S.mart_sql(level)}, picked AS (SELECT * FROM mart WHERE {where})"


@query(
    "choropleth_scale",
    f"{_slice('states', f'survey_year = {YEAR}')}, " + _scale_sql("median_household_income", "YlOrRd", "picked", "geography_id"),
)
def choropleth_scale(t):
    return _scaled(serving.layer(S.mart(t, "states"), "states", "median_household_income", YEAR), "geography_id")


@query(
    "choropleth_all_tracts",
    f"WITH {S.mart_sql('tracts')}, " + _scale_sql("renter_rate", "PuRd", "mart", "geography_id, survey_year"),
)
def choropleth_all_tracts(t):
    from placetide.operators.scale import colour_layer

    return _scaled(colour_layer(S.mart(t, "tracts"), "renter_rate"), "geography_id", "survey_year")


_BOUNDED = ("median_household_income", "poverty_rate", "bachelors_plus_rate", "renter_rate", "remote_work_rate")


@query(
    "choropleth_all_metrics",
    f"WITH {S.mart_sql('tracts')} "
    + " UNION ALL ".join(
        f"SELECT geography_id, survey_year, metric, norm, scale_min, scale_max, red, green, blue, alpha FROM "
        f"(SELECT *, '{m}' AS metric FROM (WITH "
        + _scale_sql(m, p, "mart", "geography_id, survey_year")
        + "))"
        for m, p in zip(_BOUNDED, ("YlOrRd", "YlOrRd", "YlGnBu", "PuRd", "BuPu"), strict=True)
    ),
)
def choropleth_all_metrics(t):
    """Every listed metric of all tracts; the bounds of all five come from one count."""
    from placetide.operators.scale import colour_layers

    return _scaled(colour_layers(S.mart(t, "tracts"), ["geography_id", "survey_year"]), "geography_id", "survey_year", "metric")


_where = f"survey_year = {YEAR} AND state_fips = '06'"
query(
    "counties_layer",
    f"{_slice('counties', _where)}, " + _scale_sql("bachelors_plus_rate", "YlGnBu", "picked", "geography_id"),
)(lambda t: _scaled(serving.layer(S.mart(t, "counties"), "counties", "bachelors_plus_rate", YEAR, "6"), "geography_id"))
query(
    "optional_filter",
    f"{_slice('tracts', _where + chr(32) + 'AND county_fips = ' + repr('003'))}, "
    + _scale_sql("remote_work_rate", "BuPu", "picked", "geography_id"),
)(lambda t: _scaled(serving.layer(S.mart(t, "tracts"), "tracts", "remote_work_rate", YEAR, "06", "3"), "geography_id"))


@query(
    "year_slice",
    f"{_slice('states', f'survey_year = {YEAR}')} SELECT geography_id, geography_name, state_fips, survey_year, total_population, "
    "median_age, poverty_rate, geometry_wkt FROM picked",
)
def year_slice(t):
    rows = serving.layer(S.mart(t, "states"), "states", "poverty_rate", YEAR)
    return rows.select(
        "geography_id", "geography_name", "state_fips", "survey_year", "total_population", "median_age", "poverty_rate", "geometry_wkt"
    )


@query(
    "percentile_bounds",
    f"""WITH {S.mart_sql('tracts')} SELECT floor(quantile_cont(CAST(coalesce(poverty_rate, 0) AS DOUBLE), 0.05) * 1e4 + 0.5) / 1e4 AS p5,
       floor(quantile_cont(CAST(coalesce(poverty_rate, 0) AS DOUBLE), 0.95) * 1e4 + 0.5) / 1e4 AS p95 FROM mart""",
)
def percentile_bounds_query(t):
    b = percentile_bounds(S.mart(t, "tracts"), "poverty_rate")
    return b.select(*((F.floor(F.col(c) * 1e4 + 0.5) / 1e4).alias(c) for c in ("p5", "p95")))


@query("years_available", f"WITH {S.gold_sql('states')} SELECT DISTINCT survey_year FROM gold ORDER BY survey_year")
def years_available(t):
    return serving.years_available(S.gold(t, "states"))


@query(
    "metrics_list",
    f"""WITH {S.mart_sql('tracts')},
    named(metric, label, format) AS (VALUES ('median_household_income', 'Median Household Income', 'currency'),
      ('poverty_rate', 'Poverty Rate', 'percent'), ('bachelors_plus_rate', 'Bachelor''s+ Rate', 'percent'),
      ('renter_rate', 'Renter Rate', 'percent'), ('remote_work_rate', 'Remote Work Rate', 'percent')),
    long AS ({' UNION ALL '.join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS v FROM mart" for m in METRICS)})
    SELECT metric, label, format, CAST(count(*) AS BIGINT) AS rows, CAST(count(v) AS BIGINT) AS known
    FROM named JOIN long USING (metric) GROUP BY ALL""",
)
def metrics_list(t):
    """The metric list with how much of each the tract mart holds."""
    from placetide.operators.relational import unpivot

    long = unpivot(S.mart(t, "tracts").select(*METRICS), "double", field_name="metric", value_name="v")
    held = long.groupBy("metric").agg(F.count("*").alias("rows"), F.count("v").alias("known"))
    return serving.metric_list(t.spark).join(held, "metric").select("metric", "label", "format", "rows", "known")


# --- geometry and display -------------------------------------------------------------------


@query(
    "centroid",
    f"""WITH {S.boundary_sql('tracts')} SELECT geography_id, survey_year, floor({S.CENTROID_LON} * 1e6 + 0.5) / 1e6 AS lon,
       floor({S.CENTROID_LAT} * 1e6 + 0.5) / 1e6 AS lat FROM boundary""",
)
def centroid_query(t):
    rows = S.boundary(t, "tracts").select("geography_id", "survey_year", centroid("geometry_wkt").alias("c"))
    return rows.select(
        "geography_id",
        "survey_year",
        (F.floor(F.col("c.lon") * 1e6 + 0.5) / 1e6).alias("lon"),
        (F.floor(F.col("c.lat") * 1e6 + 0.5) / 1e6).alias("lat"),
    )


_SHAPE_COUNTS = "CASE WHEN k % 50 = 48 THEN {empty} ELSE CASE k % 4 WHEN 0 THEN {a} WHEN 1 THEN {b} WHEN 2 THEN {c} WHEN 3 THEN {d} END END"


@query(
    "wkt_coordinates",
    f"""WITH {S.boundary_sql('tracts')} SELECT geography_id, survey_year,
       CAST({_SHAPE_COUNTS.format(empty=0, a=1, b=1, c=2, d=1)} AS INTEGER) AS parts,
       CAST({_SHAPE_COUNTS.format(empty=0, a=1, b=2, c=2, d=1)} AS INTEGER) AS rings,
       CAST({_SHAPE_COUNTS.format(empty=0, a=5, b=10, c=10, d=5)} AS INTEGER) AS points,
       CAST(CASE WHEN k % 50 = 48 THEN NULL ELSE x END AS DOUBLE) AS first_x FROM boundary WHERE geometry_wkt IS NOT NULL""",
)
def wkt_coordinates(t):
    rows = S.boundary(t, "tracts").filter("geometry_wkt IS NOT NULL")
    rows = rows.select("geography_id", "survey_year", polygons("geometry_wkt").alias("p"))
    first = F.try_element_at(F.flatten(F.flatten("p")), F.lit(1))[0]
    return rows.select(
        "geography_id", "survey_year", F.size("p").alias("parts"), F.size(F.flatten("p")).alias("rings"),
        F.size(F.flatten(F.flatten("p"))).alias("points"), first.alias("first_x"),
    )


@query(
    "bbox_rows",
    f"""WITH {S.boundary_sql('tracts')} SELECT geography_id, survey_year, CAST(x AS DOUBLE) AS min_lon, CAST(y AS DOUBLE) AS min_lat,
       CAST(x + CASE k % 4 WHEN 2 THEN 8 WHEN 3 THEN 2 ELSE 4 END AS DOUBLE) AS max_lon,
       CAST(y + CASE k % 4 WHEN 3 THEN 2 ELSE 4 END AS DOUBLE) AS max_lat FROM boundary WHERE k % 50 < 48""",
)
def bbox_rows(t):
    rows = S.boundary(t, "tracts").select("geography_id", "survey_year", bounding_box("geometry_wkt").alias("b"))
    return rows.filter("b IS NOT NULL").select("geography_id", "survey_year", "b.*")


@query(
    "bbox",
    f"""WITH {S.boundary_sql('tracts')}, ok AS (SELECT *, substr(geography_id, 1, 2) AS state_fips FROM boundary WHERE k % 50 < 48)
       SELECT state_fips, CAST(min(x) AS DOUBLE) AS min_lon, CAST(min(y) AS DOUBLE) AS min_lat,
       CAST(max(x + CASE k % 4 WHEN 2 THEN 8 WHEN 3 THEN 2 ELSE 4 END) AS DOUBLE) AS max_lon,
       CAST(max(y + CASE k % 4 WHEN 3 THEN 2 ELSE 4 END) AS DOUBLE) AS max_lat FROM ok GROUP BY state_fips""",
)
def bbox(t):
    return selection_bounds(S.boundary(t, "tracts"), by=["state_fips"])


_BOX_SIDES = """CAST(x AS DOUBLE) AS min_lon, CAST(y AS DOUBLE) AS min_lat,
       CAST(x + CASE k % 4 WHEN 2 THEN 8 WHEN 3 THEN 2 ELSE 4 END AS DOUBLE) AS max_lon,
       CAST(y + CASE k % 4 WHEN 3 THEN 2 ELSE 4 END AS DOUBLE) AS max_lat"""


@query(
    "stored_outlines",
    f"""WITH {S.boundary_sql('tracts')}, boxes AS (SELECT *, {_BOX_SIDES} FROM boundary WHERE k % 50 < 48)
       SELECT geography_id, survey_year, min_lon, min_lat, max_lon, max_lat, floor({S.CENTROID_LON} * 1e6 + 0.5) / 1e6 AS lon,
       floor({S.CENTROID_LAT} * 1e6 + 0.5) / 1e6 AS lat FROM boxes
       WHERE min_lon <= -90 AND max_lon >= -110 AND min_lat <= 40 AND max_lat >= 30""",
)
def stored_outlines(t):
    """Places of a map window, from a stored boundary table: no outline is parsed to find them."""
    path = storage.scratch_dir(t.spark, "outlines")
    rows = S.boundary(t, "tracts").sortWithinPartitions("min_lon", "min_lat")
    rows.write.partitionBy("survey_year").parquet(path)
    found = geo.within(t.spark.read.parquet(path), -110, 30, -90, 40)
    return found.select(
        "geography_id", "survey_year", *geo.BOX,
        *((F.floor(F.col(f"centroid_{c}") * 1e6 + 0.5) / 1e6).alias(c) for c in ("lon", "lat")),
    )


@query(
    "geojson_features",
    f"""WITH {S.gold_sql('tracts')}, rated AS (SELECT *, {S.rate_sql('renter_occupied', 'total_occupied')} AS renter_rate FROM gold)
       SELECT '{{"type":"Feature","geometry":' || {S.GEOJSON} || ',"properties":{{"geography_id":"' || geography_id || '","survey_year":'
       || CAST(survey_year AS STRING) || ',"masters":' || coalesce(CAST(masters_degree AS STRING), 'null') || ',"renter_rate":'
       || coalesce(CAST(renter_rate AS STRING), 'null') || '}}}}' AS feature FROM rated""",
)
def geojson_features(t):
    rows = S.gold(t, "tracts").select(
        "geography_id", "survey_year", F.col("masters_degree").alias("masters"),
        share("renter_occupied", "total_occupied").alias("renter_rate"), "geometry_wkt",
    )
    return geojson.features(rows)


@query(
    "geojson_meta",
    f"""{_slice('states', f'survey_year = {YEAR}')} SELECT 'renter_rate' AS metric, 'Renter Rate' AS label,
       floor(quantile_cont(coalesce(renter_rate, 0), 0.05) * 1e4 + 0.5) / 1e4 AS low,
       floor(quantile_cont(coalesce(renter_rate, 0), 0.95) * 1e4 + 0.5) / 1e4 AS high FROM picked""",
)
def geojson_meta(t):
    layer = serving.layer(S.mart(t, "states"), "states", "renter_rate", YEAR)
    meta = geojson.layer_meta(layer, "renter_rate").select(F.from_json("meta", "metric string, label string, min double, max double").alias("m"))
    return meta.select(
        "m.metric", "m.label", (F.floor(F.col("m.min") * 1e4 + 0.5) / 1e4).alias("low"), (F.floor(F.col("m.max") * 1e4 + 0.5) / 1e4).alias("high")
    )


@query(
    "arc_width",
    f"""WITH {S.flows_sql('states')}, mig AS (SELECT * FROM flows WHERE NOT is_non_migrant), top AS (SELECT CAST(max(households) AS DOUBLE) AS m FROM mig)
       SELECT origin_geography_id, dest_geography_id, survey_year, floor(greatest(1, households / m * 8) * 1e6 + 0.5) / 1e6 AS arc_width FROM mig, top""",
)
def arc_width_query(t):
    wide = arc_width(marts.migrants(S.flows_gold(t, "states")))
    return wide.select("origin_geography_id", "dest_geography_id", "survey_year", (F.floor(F.col("arc_width") * 1e6 + 0.5) / 1e6).alias("arc_width"))


def _haversine_sql(rate: str) -> str:
    return f"""floor(2 * 3961 * asin(sqrt(pow(sin(radians((dest_lat - origin_lat) / 2)), 2) + cos(radians(origin_lat)) * cos(radians(dest_lat))
      * pow(sin(radians((dest_lon - origin_lon) / 2)), 2))) * {rate} * 1000 + 0.5) / 1000"""


@query(
    "haversine",
    f"""WITH {S.flow_mart_sql('states')} SELECT origin_geography_id, dest_geography_id, survey_year,
       {_haversine_sql('1')} AS miles, {_haversine_sql('1.60934')} AS km FROM fm""",
)
def haversine(t):
    ends = ("origin_lat", "origin_lon", "dest_lat", "dest_lon")
    return S.flow_mart(t, "states").select(
        "origin_geography_id", "dest_geography_id", "survey_year",
        round_half_away(haversine_distance(*ends), 3).alias("miles"),
        round_half_away(haversine_distance(*ends, unit="km"), 3).alias("km"),
    )


@query(
    "display_format",
    f"""WITH {S.mart_sql('tracts')} SELECT geography_id, survey_year,
       coalesce('$' || format('{{:,}}', CAST(median_household_income AS BIGINT)), 'N/A') AS income,
       coalesce(format('{{:.1f}}', floor(remote_work_rate * 10 + 0.5) / 10) || '%', 'N/A') AS remote,
       coalesce('$' || format('{{:,}}', CAST(median_home_value AS BIGINT)), 'N/A') || '+' AS legend_high FROM mart""",
)
def display_format(t):
    return S.mart(t, "tracts").select(
        "geography_id",
        "survey_year",
        display_value("median_household_income", "currency").alias("income"),
        display_value("remote_work_rate", "percent").alias("remote"),
        legend_labels("median_household_income", "median_home_value", "currency")["high"].alias("legend_high"),
    )
