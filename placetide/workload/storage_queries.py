"""Writes, replays and read-backs. Each run uses a new folder under the shared one."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetide.plans import layers, marts, refresh, serving
from placetide.schemas import (
    FLOW_GOLD,
    FLOW_SILVER,
    STATE_FLOW_BRONZE,
    SURVEY_BRONZE,
)
from placetide.sources import geojson, landing, storage
from placetide.streaming import arrivals
from placetide.workload import standins as S
from placetide.workload.registry import query

_FLOW_COLS = "origin_geography_id, dest_geography_id, dest_state, dest_name, households, individuals, agi, survey_year"


def _name(stem: str) -> str:
    return f"{stem}_{uuid4().hex[:8]}"


def _dated(df):
    return df.withColumn("ingest_date", F.lit(S.INGEST_DATE))


@query("csv_flows", f"WITH {S.flows_sql('states')} SELECT {_FLOW_COLS} FROM flows")
def csv_flows(t):
    """Flow rows written as CSV, read back as text and typed."""
    path = storage.scratch_dir(t.spark, "csv")
    _dated(S.flow_bronze(t, "states")).write.option("header", True).csv(path)
    rows = landing.read_text_csv(t.spark, path, STATE_FLOW_BRONZE_TEXT)
    return layers.flow_silver(rows, "states")


# Same columns as the bronze schema, all text.
STATE_FLOW_BRONZE_TEXT = ", ".join(f"{f.name} string" for f in STATE_FLOW_BRONZE)


@query(
    "period_year",
    "SELECT o_orderkey, CAST(2000 + year(o_orderdate) % 100 AS INTEGER) AS survey_year FROM orders",
)
def period_year(t):
    """Year read from a file name made of the two period years."""
    two = F.lpad((F.year("o_orderdate") % 100).cast("string"), 2, "0")
    before = F.lpad(((F.year("o_orderdate") - 1) % 100).cast("string"), 2, "0")
    name = F.concat(F.lit("stateoutflow"), before, two, F.lit(".csv"))
    return t.orders.select("o_orderkey", landing.period_year(name).alias("survey_year"))


@query(
    "ingest_columns",
    """SELECT vec_id, CASE WHEN label % 3 = 0 THEN NULL ELSE CAST(label AS STRING) END AS label_text, CAST(true AS STRING) AS flag, 2024::BIGINT AS survey_year,
       '2024-12-31' AS ingest_date FROM embeddings""",
)
def ingest_columns(t):
    """NaN labels become NULL, other objects text, and the ingest columns are added."""
    # A third of the labels is NaN, as a column of objects holds it.
    number = F.when(F.col("label") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("label").cast("double"))
    rows = t.embeddings.select("vec_id", number.alias("label_text"), F.lit(True).alias("flag"))
    texts = landing.normalise_objects(landing.normalise_objects(rows, ["label_text"]))
    whole = texts.withColumn("label_text", F.regexp_replace("label_text", r"\.0$", ""))
    return landing.add_ingest_columns(whole, 2024, "2024-12-31")


@query(
    "object_normaliser",
    "SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_tax = 0.0 THEN NULL ELSE CAST(l_tax AS STRING) END AS tax FROM lineitem",
)
def object_normaliser(t):
    nan = F.when(F.col("l_tax") == 0.0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("tax")
    return landing.normalise_objects(t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", nan), ["tax"])


@query(
    "bronze_partitions",
    f"""WITH {S.survey_sql('tracts')} SELECT geography_id, geography_name, state_fips, survey_year, total_population, masters_degree
       FROM survey WHERE survey_year = 1998""",
)
def bronze_partitions(t):
    """Survey text landed at year=/state=, one year read back under the declared schema."""
    path = storage.scratch_dir(t.spark, "bronze_survey")
    bronze = _dated(S.survey_bronze(t, "tracts")).withColumn("state", F.lpad("state", 2, "0"))
    storage.write_bronze(bronze, path, "year", "state")
    rows = layers.survey_silver(storage.read_bronze(t.spark, path, SURVEY_BRONZE, 1998), "tracts")
    return rows.select("geography_id", "geography_name", "state_fips", "survey_year", "total_population", "masters_degree")


@query(
    "boundary_landing",
    f"""WITH {S.boundary_sql('counties')} SELECT geography_id, survey_year, geography_name, ALAND,
       regexp_replace(geometry_wkt, '(-?[0-9]+)', '\\1.0', 'g') AS geometry_wkt FROM boundary""",
)
def boundary_landing(t):
    """Boundaries landed as GeoJSON, read back as WKT."""
    from placetide.functions.geo import geojson_geometry

    path, back = (storage.scratch_dir(t.spark, n) for n in ("boundary", "boundary_wkt"))
    landed = S.boundary_bronze(t, "counties").drop("ingest_date")
    landed.withColumn("geometry", geojson_geometry("geometry_wkt")).drop("geometry_wkt").write.parquet(path)
    as_wkt = landing.wkt_from_geojson(F.col("geometry")).alias("geometry_wkt")
    names = [c for c in t.spark.read.parquet(path).columns if c != "geometry"]
    t.spark.read.parquet(path).select(*names, as_wkt).write.partitionBy("survey_year").parquet(back)
    years = range(S.BOUNDARY_YEARS[0], S.BOUNDARY_YEARS[1] + 1)
    read = [landing.read_boundaries(t.spark, f"{back}/survey_year={y}", y, S.INGEST_DATE) for y in years]
    rows = layers.boundary_silver(reduce(DataFrame.unionByName, read))
    return rows.select("geography_id", "survey_year", "geography_name", "ALAND", "geometry_wkt")


@query(
    "year_backfill",
    f"""WITH {S.flows_sql('states')} SELECT * REPLACE (CASE WHEN survey_year = 1997 THEN households * 2 ELSE households END AS households)
       FROM (SELECT {_FLOW_COLS} FROM flows)""",
)
def year_backfill(t):
    """All years written, one re-delivered twice: replaced, never doubled; a year without rows is absent."""
    table = _name("silver_flows")
    storage.create_table(t.spark, table, FLOW_SILVER, location=storage.scratch_dir(t.spark, "silver"))
    rows = S.flows(t, "states")
    storage.backfill_years(rows, table, range(1988, 2004))
    again = rows.withColumn("households", F.col("households") * 2)
    for _ in range(2):
        storage.backfill_years(again, table, [1997])
    return t.spark.table(table)


def _stored_flows(t):
    table = _name("held_flows")
    storage.create_table(
        t.spark, table, FLOW_SILVER, ("survey_year", "dest_geography_id"), location=storage.scratch_dir(t.spark, "held")
    )
    storage.backfill_years(S.flows(t, "states"), table, range(1988, 2004))
    return table


@query("years_held", f"WITH {S.flows_sql('states')} SELECT DISTINCT survey_year FROM flows")
def years_held(t):
    """Years of a stored table, listed without reading its rows."""
    return serving.years_held(t.spark, _stored_flows(t))


@query(
    "due_in_table",
    f"""WITH {S.flows_sql('states')}, wanted AS (SELECT CAST(y AS INTEGER) AS survey_year, lpad(CAST(s AS STRING), 2, '0') AS dest_geography_id FROM range(1988, 2012) AS a(y), range(0, 60) AS b(s))
       SELECT * FROM wanted WHERE NOT EXISTS (SELECT 1 FROM flows f WHERE f.survey_year = wanted.survey_year AND f.dest_geography_id = wanted.dest_geography_id)""",
)
def due_in_table(t):
    """Year and state partitions that a stored table lacks, from its partition list."""
    years = t.spark.range(1988, 2012).select(F.col("id").cast("int").alias("survey_year"))
    wanted = arrivals.expected_partitions(years, [f"{s:02d}" for s in range(60)]).withColumnRenamed("state", "dest_geography_id")
    return arrivals.due_in_table(t.spark, wanted, _stored_flows(t), ["survey_year", "dest_geography_id"])


@query(
    "backfill_bucketed",
    f"WITH {S.flows_sql('states')} SELECT * FROM flows",
)
def backfill_bucketed(t):
    """Replay into a table that is partitioned by year and bucketed by origin."""
    table = _name("gold_flows")
    storage.create_table(
        t.spark, table, FLOW_GOLD, bucket_by="origin_geography_id", location=storage.scratch_dir(t.spark, "gold")
    )
    years = list(range(1995, 2002))
    rows = S.flows_gold(t, "states")
    storage.backfill_years(rows, table, years, bucket_by="origin_geography_id")
    storage.backfill_years(rows, table, years[2:5], bucket_by="origin_geography_id")
    return t.spark.table(table)


@query(
    "bucketed_mart",
    f"WITH {S.mart_sql('tracts')} SELECT * FROM mart WHERE survey_year = 1998 AND state_fips = '06'",
)
def bucketed_mart(t):
    """Mart partitioned by year, 32 buckets by state; the slice prunes both."""
    table = _name("mart_tracts")
    storage.full_refresh(S.mart(t, "tracts"), table, bucket_by="state_fips", location=storage.scratch_dir(t.spark, "mart"))
    return t.spark.table(table).filter("survey_year = 1998 AND state_fips = '06'")


@query(
    "flows_with_origin",
    f"""WITH {S.flow_mart_sql('counties')} SELECT origin_geography_id, dest_geography_id, survey_year, households, individuals, agi, is_non_migrant,
       origin_county_name, origin_state_fips, origin_total_population, origin_median_income, origin_poverty_rate FROM fm""",
)
def flows_with_origin(t):
    """Stored flows and places, bucketed alike by place, joined without a shuffle."""
    held, places = _name("flows_by_origin"), _name("places_by_id")
    storage.full_refresh(S.flows_gold(t, "counties"), held, bucket_by="origin_geography_id", location=storage.scratch_dir(t.spark, "held"))
    storage.full_refresh(S.mart(t, "counties"), places, bucket_by="geography_id", location=storage.scratch_dir(t.spark, "places"))
    return marts.flows_with_origin(t.spark, held, places, "counties")


@query(
    "write_metrics",
    f"WITH {S.flows_sql('states')} SELECT CAST(count(*) AS BIGINT) AS row_count, 'states' AS level FROM flows",
)
def write_metrics(t):
    """Row count reported by the write itself."""
    report = storage.write_with_metrics(S.flows(t, "states"), storage.scratch_dir(t.spark, "metrics"), "year", level="states")
    return t.spark.createDataFrame([(report["row_count"], report["level"])], "row_count bigint, level string")


@query(
    "geojson_sink",
    f"WITH {S.boundary_sql('tracts')} SELECT geography_id, survey_year, geometry_wkt IS NOT NULL AS drawn FROM boundary",
)
def geojson_sink(t):
    """Features written as lines by all tasks and read back."""
    path = storage.scratch_dir(t.spark, "geojson")
    geojson.write_features(S.boundary(t, "tracts").select("geography_id", "survey_year", "geometry_wkt"), path)
    lines = t.spark.read.text(path)
    return lines.select(
        F.get_json_object("value", "$.properties.geography_id").alias("geography_id"),
        F.get_json_object("value", "$.properties.survey_year").cast("int").alias("survey_year"),
        F.get_json_object("value", "$.geometry").isNotNull().alias("drawn"),
    )


@query(
    "flow_document",
    f"""WITH {S.flows_sql('states')} SELECT origin_geography_id, dest_geography_id, survey_year, households,
       row_number() OVER (ORDER BY origin_geography_id, dest_geography_id, survey_year) > 1 AS follows FROM flows
       UNION ALL SELECT NULL, NULL, NULL, 2, false""",
)
def flow_document(t):
    """All flows as one JSON document in parts, read back by lines: each flow but the first follows
    a comma, and a head and an end without flows stand around them."""
    path = storage.scratch_dir(t.spark, "flow_document")
    order = ["origin_geography_id", "dest_geography_id", "survey_year"]
    geojson.write_flow_document(S.flows_gold(t, "states").select(*order, "households"), path, order)
    comma = F.startswith("value", F.lit(","))
    text = F.when(comma, F.substr("value", F.lit(2))).otherwise(F.col("value"))
    read = F.from_json(text, "origin_geography_id string, dest_geography_id string, survey_year int, households bigint")
    lines = t.spark.read.text(path).select("value", comma.alias("follows"), read.alias("flow"))
    around = lines.filter(F.col("value").isin('{"flows":[', "]}")).groupBy().agg(F.count("*").alias("households"))
    flows = lines.filter("flow.origin_geography_id IS NOT NULL").select("flow.*", "follows")
    ends = around.select(*(F.lit(None).cast(flows.schema[c].dataType).alias(c) for c in order), "households", F.lit(False).alias("follows"))
    return flows.unionByName(ends)


@query(
    "stream_arrivals",
    f"""WITH {S.flows_sql('states')} SELECT {_FLOW_COLS} FROM flows WHERE survey_year <= 1998
       UNION ALL SELECT {_FLOW_COLS.replace('households', 'households * 2 AS households')} FROM flows WHERE survey_year > 1998""",
)
def stream_arrivals(t):
    """Landed years picked up by a file stream; a later delivery of new and repeated years
    is picked up by the next run from the same checkpoint."""
    path, table = storage.scratch_dir(t.spark, "arrivals"), _name("silver_arrivals")
    storage.create_table(t.spark, table, FLOW_SILVER, location=storage.scratch_dir(t.spark, "silver"))
    checkpoint = storage.scratch_dir(t.spark, "checkpoint")
    bronze = _dated(S.flow_bronze(t, "states"))

    def run():
        return arrivals.refresh_on_arrival(
            t.spark, path, STATE_FLOW_BRONZE, lambda df: layers.flow_silver(df, "states"), table, checkpoint
        )

    storage.write_bronze(bronze.filter("survey_year <= 1998"), path, "year")
    run()
    doubled = F.when(F.col("n1") != "-1", (F.col("n1").cast("bigint") * 2).cast("string")).otherwise(F.col("n1"))
    storage.write_bronze(bronze.filter("survey_year = 1998"), path, "year")
    storage.write_bronze(bronze.filter("survey_year > 1998").withColumn("n1", doubled), path, "year")
    run()
    return t.spark.table(table)


@query(
    "sync_missing_years",
    f"WITH {S.flows_sql('states')} SELECT {_FLOW_COLS} FROM flows",
)
def sync_missing_years(t):
    """Only the years a table lacks are written."""
    table = _name("silver_sync")
    storage.create_table(t.spark, table, FLOW_SILVER, location=storage.scratch_dir(t.spark, "silver"))
    path = storage.scratch_dir(t.spark, "bronze_sync")
    storage.write_bronze(_dated(S.flow_bronze(t, "states")), path, "year")
    landed = lambda y: layers.flow_silver(storage.read_bronze(t.spark, path, STATE_FLOW_BRONZE, y), "states")
    storage.backfill_years(landed(1995).unionByName(landed(1999)), table, [1995, 1999])
    bounds = t.lineitem.agg(F.year(F.min("l_shipdate")).alias("lo"), F.year(F.max("l_shipdate")).alias("hi"))
    expected = bounds.select(F.explode(F.sequence("lo", "hi")).alias("survey_year"))
    arrivals.sync_years(t.spark, landed, table, expected, batch=3)
    return t.spark.table(table)


_LAYERED = f"""WITH {S.flow_mart_sql('states')} SELECT * REPLACE (
    floor(origin_lat * 1e6 + 0.5) / 1e6 AS origin_lat, floor(origin_lon * 1e6 + 0.5) / 1e6 AS origin_lon,
    floor(dest_lat * 1e6 + 0.5) / 1e6 AS dest_lat, floor(dest_lon * 1e6 + 0.5) / 1e6 AS dest_lon) FROM fm"""


def _six_digits(df):
    return df.withColumns({c: F.floor(F.col(c) * 1e6 + 0.5) / 1e6 for c in ("origin_lat", "origin_lon", "dest_lat", "dest_lon")})


@query("refresh_layers", _LAYERED)
def refresh_layers(t):
    """Landed bronze through silver, gold and marts, all stored. Some years arrive late, and some
    are asked for that one source or all have not landed: boundaries start a year later."""
    layout = refresh.Layout(storage.scratch_dir(t.spark, "layers"), prefix=f"r{uuid4().hex[:8]}_")
    storage.write_bronze(_dated(S.survey_bronze(t, "states")), layout.bronze("census_acs5", "states"), "year")
    storage.write_bronze(S.boundary_bronze(t, "states"), layout.bronze("tiger", "states"), "year")
    storage.write_bronze(_dated(S.flow_bronze(t, "states")), layout.bronze("irs", "states"), "year")
    places = flow = ("states",)
    refresh.refresh_silver(t.spark, layout, refresh.silver_sources(places, flow), range(1990, 1999))
    refresh.refresh_all(t.spark, layout, range(1999, 2006), places, flow)
    return _six_digits(t.spark.table(layout.table(refresh.FLOW_MART["states"])))


@query("arrivals_cascade", _LAYERED)
def arrivals_cascade(t):
    """The same layers carried up by the file streams, while the sources land one by one."""
    layout = refresh.Layout(storage.scratch_dir(t.spark, "cascade"), prefix=f"c{uuid4().hex[:8]}_")
    checkpoint = storage.scratch_dir(t.spark, "cascade_checkpoint")

    def run():
        arrivals.cascade_on_arrival(t.spark, layout, checkpoint, ("states",), ("states",))

    flows = _dated(S.flow_bronze(t, "states"))
    storage.write_bronze(flows.filter("survey_year <= 1997"), layout.bronze("irs", "states"), "year")
    run()
    storage.write_bronze(_dated(S.survey_bronze(t, "states")), layout.bronze("census_acs5", "states"), "year")
    run()
    storage.write_bronze(S.boundary_bronze(t, "states"), layout.bronze("tiger", "states"), "year")
    storage.write_bronze(flows.filter("survey_year >= 1997"), layout.bronze("irs", "states"), "year")
    run()
    return _six_digits(t.spark.table(layout.table(refresh.FLOW_MART["states"])))


def _documents_of(t, line, joined, name, head=None):
    """One text file for every 500 customers, as a source delivers one document per answer."""
    path = storage.scratch_dir(t.spark, name)
    lines = t.customer.select(F.expr("c_custkey div 500").alias("part"), line.alias("line"))
    texts = lines.groupBy("part").agg(joined(F.sort_array(F.collect_list("line"))).alias("value"))
    if head is not None:
        texts = texts.withColumn("value", F.concat(head, "value"))
    texts.write.partitionBy("part").text(path)
    return f"{path}/*"


@query(
    "header_json_files",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer",
)
def header_json_files(t):
    """Answers of a header row and value rows, one document per file, read back."""
    names = ["c_custkey", "c_name", "c_mktsegment"]
    line = F.array(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    head = F.array(F.array(*[F.lit(n) for n in names]))
    path = _documents_of(t, line, lambda rows: F.to_json(F.concat(head, rows)), "header_json")
    return landing.read_header_json(t.spark, path, names).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(
    "header_json_lines",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer",
)
def header_json_lines(t):
    """The same answers with a row a line, every second document in another order of columns, shared
    among tasks by lines."""
    names = ["c_custkey", "c_name", "c_mktsegment"]
    cells = [F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")]
    turned = F.expr("c_custkey div 500 % 2 = 1")
    line = F.when(turned, F.array(*cells[::-1])).otherwise(F.array(*cells))
    head = F.when(F.col("part") % 2 == 1, F.array(*map(F.lit, names[::-1]))).otherwise(F.array(*map(F.lit, names)))
    document = lambda rows: F.concat(F.lit(",\n"), F.array_join(F.transform(rows, lambda r: F.to_json(r)), ",\n"), F.lit("]"))
    path = _documents_of(t, line, document, "header_lines", F.concat(F.lit("["), F.to_json(head)))
    return landing.read_header_lines(t.spark, path, names).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(
    "csv_bad_bytes",
    "SELECT CAST(c_custkey AS STRING) AS c_custkey, c_name || chr(65533) || 'x' AS c_name FROM customer",
)
def csv_bad_bytes(t):
    """A byte that is no text becomes the replacement character, and its row stays."""
    broken = F.concat(F.col("c_custkey").cast("string"), F.lit(","), "c_name", F.expr("cast(unhex('FF') AS string)"), F.lit("x"))
    path = _documents_of(t, broken, lambda rows: F.concat(F.lit("c_custkey,c_name\n"), F.array_join(rows, "\n")), "bad_bytes")
    return landing.read_text_csv(t.spark, path, "c_custkey string, c_name string")
