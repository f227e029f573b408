"""Relational, text, number and calendar helpers over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from placetide.functions import dates as D
from placetide.functions import numeric as N
from placetide.functions import text as X
from placetide.operators import relational as R
from placetide.operators import spines as P
from placetide.workload.registry import query

# --- relational ------------------------------------------------------------------------------


@query(
    "dedup",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM (
       SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup(t):
    order = [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    return R.deduplicate(t.lineitem.select(*cols), ["l_orderkey", "l_linenumber"], order)


@query(
    "dedup_hot_key",
    """SELECT event_type, event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS rn
       FROM events) WHERE rn = 1""",
)
def dedup_hot_key(t):
    """Five keys over all events: one row per key leaves each input task."""
    rows = t.events.select("event_type", "event_id", "user_id", "ts")
    return R.deduplicate(rows, ["event_type"], [F.desc("ts"), "event_id"]).drop("ts")


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_SLUGS = ("_1_urgent", "_2_high", "_3_medium", "_4_not_specified", "_5_low")


@query(
    "pivot",
    "SELECT o_orderstatus, "
    + ", ".join(f"CAST(count_if(o_orderpriority = '{p}') AS BIGINT) AS n{s}" for p, s in zip(_PRIORITIES, _SLUGS))
    + " FROM orders GROUP BY o_orderstatus",
)
def pivot(t):
    return R.pivot(t.orders, ["o_orderstatus"], "o_orderpriority", _PRIORITIES, prefix="n-", quote_identifiers=False)


@query(
    "pivot_sum",
    """SELECT l_returnflag, CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS qty_F,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS qty_O,
       CAST(sum(CASE WHEN l_linestatus = 'X' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS qty_X FROM lineitem GROUP BY l_returnflag""",
)
def pivot_sum(t):
    lines = t.lineitem.select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("bigint").alias("q"))
    return R.pivot(lines, ["l_returnflag"], "l_linestatus", ["F", "O", "X"], prefix="qty_", then_value="q")


@query(
    "pivot_distinct",
    """SELECT event_type, CAST(count(DISTINCT CASE WHEN user_id >= 75 THEN user_id ELSE NULL END) AS BIGINT) AS "75"
       FROM events GROUP BY event_type""",
)
def pivot_distinct(t):
    return R.pivot(
        t.events, ["event_type"], "user_id", [75], agg="count", cmp=">=", then_value="user_id", else_value=None, distinct=True
    )


@query(
    "unpivot",
    """SELECT c_custkey, 'c_nationkey' AS field, CAST(c_nationkey AS STRING) AS val FROM customer
       UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer
       UNION ALL SELECT c_custkey, 'poor', CASE WHEN c_acctbal < 0 THEN 'true' ELSE 'false' END FROM customer
       UNION ALL SELECT c_custkey, 'gap', CASE WHEN c_nationkey = 3 THEN NULL ELSE c_name END FROM customer""",
)
def unpivot(t):
    people = t.customer.select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment", (F.col("c_acctbal") < 0).alias("poor"),
        F.when(F.col("c_nationkey") != 3, F.col("c_name")).alias("gap"),
    )
    return R.unpivot(people, "string", exclude=["C_CUSTKEY"], remove=["c_name"], field_name="field", value_name="val")


@query(
    "union_relations",
    """SELECT 'customer' AS src, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS part_size FROM customer WHERE c_name IS NOT NULL
       UNION ALL SELECT 'supplier', s_name, s_nationkey, NULL, NULL FROM supplier
       UNION ALL SELECT 'part', p_name, NULL, NULL, p_size FROM part""",
)
def union_relations(t):
    relations = {
        "customer": t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), "c_acctbal"),
        "supplier": t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")),
        "part": t.part.select(F.col("p_name").alias("name"), F.col("p_size").alias("part_size")),
    }
    return R.union_relations(
        relations, {"nation": "bigint", "part_size": "bigint"}, exclude=["C_ACCTBAL"], source_column_name="src", where="name IS NOT NULL"
    )


@query(
    "relations_by_prefix",
    """SELECT 'flow_demo_a' AS src, event_type AS label, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type
       UNION ALL SELECT 'flow_demo_b', o_orderpriority, CAST(count(*) AS BIGINT) FROM orders GROUP BY o_orderpriority""",
)
def relations_by_prefix(t):
    t.events.groupBy(F.col("event_type").alias("label")).agg(F.count("*").alias("n")).createOrReplaceTempView("flow_demo_a")
    t.orders.groupBy(F.col("o_orderpriority").alias("label")).agg(F.count("*").alias("n")).createOrReplaceTempView("flow_demo_b")
    t.orders.select("o_orderkey").createOrReplaceTempView("flow_demo_skip")
    found = R.relations_by_prefix(t.spark, "flow_demo_", exclude="%skip")
    return R.union_relations(found, source_column_name="src")


@query(
    "equality_diff",
    """WITH a AS (SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer), b AS (
         SELECT s_nationkey AS nation, CASE WHEN s_acctbal < 0 THEN 'BUILDING' ELSE 'MACHINERY' END AS segment FROM supplier)
       SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
       UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def equality_diff(t):
    a = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(
        F.col("s_nationkey").alias("nation"), F.when(F.col("s_acctbal") < 0, "BUILDING").otherwise("MACHINERY").alias("segment")
    )
    return R.two_way_except(a, b)


@query(
    "equality_precision",
    """WITH a AS (SELECT l_linenumber AS n, CAST(round(CAST(l_extendedprice / 100000 AS DECIMAL(38, 12)), 1) AS DOUBLE) AS d FROM lineitem WHERE l_returnflag = 'A'),
       b AS (SELECT l_linenumber AS n, CAST(round(CAST(l_tax AS DECIMAL(38, 12)), 1) AS DOUBLE) AS d FROM lineitem WHERE l_returnflag <> 'A')
       SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
       UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def equality_precision(t):
    a = t.lineitem.filter("l_returnflag = 'A'").select(F.col("l_linenumber").alias("n"), (F.col("l_extendedprice") / 100000).alias("d"), "l_shipdate")
    b = t.lineitem.filter("l_returnflag <> 'A'").select(F.col("l_linenumber").alias("n"), F.col("l_tax").alias("d"))
    diff = R.two_way_except(a, b, exclude_columns=["L_SHIPDATE"], precision=1)
    return diff.withColumn("d", F.col("d").cast("double"))


@query(
    "nullcheck",
    """SELECT page_id, nullif(tail, '') AS tail, nullif(query, '') AS query, n FROM (
       SELECT page_id, split_part(url, '#', 2) AS tail, split_part(url, '?', 2) AS query, CAST(length(url) AS INTEGER) AS n FROM pages)""",
)
def nullcheck(t):
    pages = t.pages.select(
        "page_id", F.split_part("url", F.lit("#"), F.lit(2)).alias("tail"), F.split_part("url", F.lit("?"), F.lit(2)).alias("query"),
        F.length("url").alias("n"),
    )
    return R.nullcheck(pages)


@query("star_select", "SELECT p_partkey AS src_p_partkey_x, p_name AS src_p_name_x, p_type AS src_p_type_x, p_retailprice AS src_p_retailprice_x FROM part")
def star_select(t):
    return t.part.select(*R.star(t.part, except_=["P_SIZE", "p_brand"], prefix="src_", suffix="_x"))


@query(
    "column_values",
    "SELECT p_brand AS value, CAST(count(*) AS BIGINT) AS n FROM part WHERE p_size > 10 GROUP BY p_brand ORDER BY n DESC, value LIMIT 10",
)
def column_values(t):
    return R.column_values(t.part, "p_brand", max_records=10, where="p_size > 10")


@query("group_by_n", "SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, max(l_quantity) AS top FROM lineitem GROUP BY 1, 2")
def group_by_n(t):
    lines = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    return R.group_by_first(lines, 2).agg(F.count("*").alias("n"), F.max("l_quantity").alias("top"))


@query(
    "value_pivot",
    """SELECT c_nationkey, CAST(count_if(c_mktsegment = 'AUTOMOBILE') AS BIGINT) AS automobile, CAST(count_if(c_mktsegment = 'BUILDING') AS BIGINT) AS building,
       CAST(count_if(c_mktsegment = 'FURNITURE') AS BIGINT) AS furniture, CAST(count_if(c_mktsegment = 'HOUSEHOLD') AS BIGINT) AS household,
       CAST(count_if(c_mktsegment = 'MACHINERY') AS BIGINT) AS machinery FROM customer GROUP BY c_nationkey""",
)
def value_pivot(t):
    """Pivot over the values found in the data, read as a bounded list."""
    ranked = R.column_values(t.customer, "c_mktsegment", order_by="c_mktsegment")
    values = R.results_as_lists(ranked, max_rows=50)["value"]
    return R.pivot(t.customer, ["c_nationkey"], "c_mktsegment", values, quote_identifiers=False)


@query("single_value", "SELECT CAST(count(*) AS BIGINT) AS newer FROM orders WHERE o_orderdate >= (SELECT max(l_shipdate) - INTERVAL 365 DAY FROM lineitem)")
def single_value(t):
    newest = R.single_value(t.lineitem.agg(F.max("l_shipdate")))
    limit = F.lit(newest).cast("timestamp_ntz") - F.expr("interval 365 days")
    return t.orders.filter(F.col("o_orderdate") >= limit).agg(F.count("*").alias("newer"))


# --- numbers and text ------------------------------------------------------------------------


@query(
    "safe_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / nullif(l_discount, 0) AS per_discount,
       coalesce(nullif(l_linenumber, 3), 0) + coalesce(l_partkey, 0) + coalesce(l_suppkey, 0) AS added,
       coalesce(l_partkey, 0) - coalesce(nullif(l_linenumber, 3), 0) - coalesce(l_suppkey, 0) AS taken FROM lineitem""",
)
def safe_math(t):
    gap = F.nullif("l_linenumber", F.lit(3))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        N.safe_divide("l_quantity", "l_discount").alias("per_discount"),
        N.safe_add([gap, "l_partkey", "l_suppkey"]).alias("added"),
        N.safe_subtract(["l_partkey", gap, "l_suppkey"]).alias("taken"),
    )


@query(
    "width_bucket",
    """SELECT CAST(CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity >= 40 THEN 7 ELSE floor((l_quantity - 10) / 5) + 1 END AS BIGINT) AS bucket,
       CAST(count(*) AS BIGINT) AS n, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem GROUP BY 1""",
)
def width_bucket(t):
    bucket = N.width_bucket("l_quantity", 10.0, 40.0, 6).cast("bigint").alias("bucket")
    return t.lineitem.groupBy(bucket).agg(F.count("*").alias("n"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))


@query(
    "surrogate_key",
    """SELECT conv_id, turn, md5(CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) || '-' || coalesce(nullif(role, 'user'), '_null_')) AS key
       FROM conversations""",
)
def surrogate_key(t):
    role = F.nullif("role", F.lit("user"))
    return t.conversations.select("conv_id", "turn", X.surrogate_key(["conv_id", "turn", role]).alias("key"))


@query(
    "slugify",
    r"""WITH texts AS (SELECT DISTINCT p_name AS s FROM part UNION SELECT DISTINCT p_brand || ' - ' || p_size FROM part
         UNION SELECT DISTINCT o_orderpriority FROM orders UNION SELECT url FROM pages), cleaned AS (
       SELECT s, regexp_replace(regexp_replace(lower(s), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g') AS c FROM texts)
       SELECT s, CASE WHEN substr(c, 1, 1) BETWEEN '0' AND '9' THEN '_' || c ELSE c END AS slug FROM cleaned""",
)
def slugify(t):
    brand = F.concat(F.col("p_brand"), F.lit(" - "), F.col("p_size").cast("string"))
    texts = (
        t.part.select(F.col("p_name").alias("s"))
        .union(t.part.select(brand))
        .union(t.orders.select("o_orderpriority"))
        .union(t.pages.select("url"))
        .distinct()
    )
    return texts.select("s", X.slugify("s").alias("slug"))


_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"


@query(
    "url_parts",
    f"""SELECT page_id, split_part(split_part(replace({_BARE}, 'android-app://', ''), '/', 1), '?', 1) AS host,
       split_part(CASE WHEN strpos({_BARE}, '/') > 0 THEN substr({_BARE}, strpos({_BARE}, '/') + 1)
         WHEN strpos({_BARE}, '?') > 0 THEN substr({_BARE}, strpos({_BARE}, '?')) ELSE {_BARE} END, '?', 1) AS path,
       nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
       nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS source FROM pages""",
)
def url_parts(t):
    return t.pages.select(
        "page_id", X.url_host("url").alias("host"), X.url_path("url").alias("path"),
        X.url_parameter("url", "page").alias("page"), X.url_parameter("url", "utm_source").alias("source"),
    )


@query(
    "lenient_typing",
    r"""WITH raw AS (SELECT page_id, trim(split_part(split_part(split_part(url, '/', 5), '?', 1), '#', 1)) AS s FROM pages),
       typed AS (SELECT page_id, s, (lower(s) IN ('', 'none', 'null')) AS gone, regexp_full_match(s, '[+-]?[0-9]+') AS is_int,
         regexp_full_match(s, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') AS is_real FROM raw)
       SELECT page_id, CASE WHEN gone THEN 'null' WHEN is_int THEN 'int' WHEN is_real THEN 'real' ELSE 'text' END AS kind,
       CASE WHEN NOT gone AND is_int THEN CAST(s AS BIGINT) END AS whole,
       CASE WHEN NOT gone AND NOT is_int AND is_real THEN CAST(s AS DOUBLE) END AS real_value,
       CASE WHEN NOT gone AND NOT is_int AND NOT is_real THEN s END AS plain FROM typed""",
)
def lenient_typing(t):
    last = F.split_part(F.split_part(F.split_part("url", F.lit("/"), F.lit(5)), F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))
    rows = t.pages.select("page_id", X.lenient_value(last).alias("v"))
    return rows.select("page_id", "v.kind", "v.whole", F.col("v.real").alias("real_value"), F.col("v.text").alias("plain"))


# --- series and calendar ---------------------------------------------------------------------


@query(
    "series",
    """WITH s AS (SELECT unnest(range(1, (SELECT max(l_quantity)::BIGINT FROM lineitem) + 1)) AS generated_number)
       SELECT generated_number, CAST(count(l_orderkey) AS BIGINT) AS n FROM s LEFT JOIN lineitem ON l_quantity = generated_number GROUP BY 1""",
)
def series(t):
    """Every whole quantity up to the largest, with its line count (0 where none)."""
    top = int(R.single_value(t.lineitem.agg(F.max("l_quantity")), 1))
    held = t.lineitem.groupBy(F.col("l_quantity").cast("bigint").alias("generated_number")).agg(F.count("*").alias("held"))
    filled = P.generate_series(t.spark, top).join(held, "generated_number", "left")
    return filled.select("generated_number", F.coalesce("held", F.lit(0)).alias("n"))


def _spine_sql(part: str, step: str) -> str:
    return f"""WITH bounds AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, max(o_orderdate) AS hi FROM orders),
       spine AS (SELECT unnest(generate_series(lo, hi - INTERVAL 1 MICROSECOND, INTERVAL {step})) AS starts, lo, hi FROM bounds)
       SELECT CAST(starts AS TIMESTAMP) AS starts, '{part}' AS part FROM spine"""


@query("date_spine", " UNION ALL ".join(f"({_spine_sql(p, s)})" for p, s in (("day", "1 DAY"), ("week", "7 DAY"), ("month", "1 MONTH"))))
def date_spine(t):
    """Day, week and month starts across the order dates."""
    bounds = t.orders.agg(F.trunc(F.min("o_orderdate").cast("date"), "month").alias("lo"), F.max("o_orderdate").alias("hi"))
    out = [
        bounds.select(F.explode(P.spine_array(F.col("lo"), F.col("hi"), part)).alias("starts"), F.lit(part).alias("part"))
        for part in ("day", "week", "month")
    ]
    return out[0].union(out[1]).union(out[2])


@query(
    "intervals_between",
    """SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS days, date_diff('month', o_orderdate, TIMESTAMP '2002-01-01') AS months,
       date_diff('year', o_orderdate, TIMESTAMP '2002-01-01') AS years FROM orders""",
)
def intervals_between(t):
    end = F.lit("2002-01-01").cast("timestamp_ntz")
    start = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", *(P.intervals_between(start, end, p).alias(f"{p}s") for p in ("day", "month", "year"))
    )


def _dd(e: str, part: str) -> str:
    last = {"month": "1 MONTH", "quarter": "3 MONTH", "year": "1 YEAR"}[part]
    return f"CAST(date_trunc('{part}', {e}) + INTERVAL {last} - INTERVAL 1 DAY AS DATE)"


_SUNDAY = "CAST({d} - CAST(dayofweek({d}) AS INTEGER) AS DATE)"
_MONDAY = "CAST({d} - CAST(isodow({d}) - 1 AS INTEGER) AS DATE)"


def _us_week(d: str) -> str:
    return f"CAST((dayofyear({d}) + dayofweek(CAST(date_trunc('year', {d}) AS DATE)) - 1) // 7 + 1 AS INTEGER)"


_DIMENSION_SQL = f"""WITH bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM bounds),
base AS (SELECT d, CAST(d - INTERVAL 1 YEAR AS DATE) AS py, CAST(d - 364 AS DATE) AS pw FROM days)
SELECT d AS date_day, CAST(d - 1 AS DATE) AS prior_date_day, CAST(d + 1 AS DATE) AS next_date_day, py AS prior_year_date_day, pw AS prior_year_over_year_date_day,
  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(isodow(d) AS INTEGER) AS day_of_week_iso, dayname(d) AS day_of_week_name, left(dayname(d), 3) AS day_of_week_name_short,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  {_SUNDAY.format(d='d')} AS week_start_date, {_SUNDAY.format(d='d')} + 6 AS week_end_date,
  {_SUNDAY.format(d='pw')} AS prior_year_week_start_date, {_SUNDAY.format(d='pw')} + 6 AS prior_year_week_end_date, {_us_week('d')} AS week_of_year,
  {_MONDAY.format(d='d')} AS iso_week_start_date, {_MONDAY.format(d='d')} + 6 AS iso_week_end_date,
  {_MONDAY.format(d='pw')} AS prior_year_iso_week_start_date, {_MONDAY.format(d='pw')} + 6 AS prior_year_iso_week_end_date,
  CAST(weekofyear(d) AS INTEGER) AS iso_week_of_year, strftime(d, '%G-W%V') AS iso_year_week,
  {_us_week('pw')} AS prior_year_week_of_year, CAST(weekofyear(pw) AS INTEGER) AS prior_year_iso_week_of_year,
  CAST(month(d) AS INTEGER) AS month_of_year, monthname(d) AS month_name, left(monthname(d), 3) AS month_name_short,
  CAST(date_trunc('month', d) AS DATE) AS month_start_date, {_dd('d', 'month')} AS month_end_date,
  CAST(date_trunc('month', py) AS DATE) AS prior_year_month_start_date, {_dd('py', 'month')} AS prior_year_month_end_date,
  CAST(quarter(d) AS INTEGER) AS quarter_of_year, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date, {_dd('d', 'quarter')} AS quarter_end_date,
  CAST(year(d) AS INTEGER) AS year_number, CAST(date_trunc('year', d) AS DATE) AS year_start_date, {_dd('d', 'year')} AS year_end_date FROM base"""


@query("date_dimension", _DIMENSION_SQL)
def date_dimension(t):
    """All attributes for every day between the first and last order."""
    bounds = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    days = bounds.select(F.explode(P.spine_array(F.col("lo").cast("date"), D.tomorrow("hi"))).alias("date_day"))
    return days.select(*P.date_attributes("date_day"))


@query(
    "base_dates",
    """WITH spine AS (SELECT unnest(generate_series(TIMESTAMP '1998-06-01', TIMESTAMP '1998-07-01', INTERVAL 1 DAY)) AS d)
       SELECT d AS date_day, CAST(count(o_orderkey) AS BIGINT) AS orders FROM spine LEFT JOIN orders ON o_orderdate = d GROUP BY d""",
)
def base_dates(t):
    """Orders on each of the last 30 days up to a reference day."""
    days = P.base_dates(t.spark, n_dateparts=30, datepart="day", as_of="1998-07-01")
    held = t.orders.groupBy(F.col("o_orderdate").alias("date_day")).agg(F.count("*").alias("held"))
    return days.join(held, "date_day", "left").select("date_day", F.coalesce("held", F.lit(0)).alias("orders"))


_D = "CAST(l_shipdate AS DATE)"


@query(
    "weeks_us",
    f"""WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, {_D} AS d FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey,
       {_SUNDAY.format(d='d')} AS start_day, {_SUNDAY.format(d='d')} + 6 AS end_day, {_us_week('d')} AS week, CAST(dayofweek(d) + 1 AS INTEGER) AS dow FROM s""",
)
def weeks_us(t):
    d = "l_shipdate"
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", D.week_start(d).alias("start_day"), D.week_end(d).alias("end_day"),
        D.week_of_year(d).alias("week"), D.day_of_week(d, iso=False).alias("dow"),
    )


@query(
    "weeks_iso",
    f"""WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, {_D} AS d FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey,
       {_MONDAY.format(d='d')} AS start_day, {_MONDAY.format(d='d')} + 6 AS end_day, CAST(weekofyear(d) AS INTEGER) AS week, strftime(d, '%G-W%V') AS year_week,
       CAST(isodow(d) AS INTEGER) AS dow FROM s""",
)
def weeks_iso(t):
    d = "l_shipdate"
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", D.iso_week_start(d).alias("start_day"), D.iso_week_end(d).alias("end_day"),
        D.iso_week_of_year(d).alias("week"), D.iso_year_week(d).alias("year_week"), D.day_of_week(d).alias("dow"),
    )


@query(
    "date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(quarter(ts) AS INTEGER) AS q, CAST(hour(ts) AS INTEGER) AS h, CAST(day(ts) AS INTEGER) AS dom,
       CAST(dayofyear(ts) AS INTEGER) AS doy, make_date(CAST(year(ts) AS INTEGER), CAST(month(ts) AS INTEGER), 1) AS first_day,
       make_timestamp(year(ts), month(ts), day(ts), hour(ts), 0, 0) AS whole_hour FROM events""",
)
def date_parts(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id", D.date_part("year", ts).alias("y"), D.date_part("quarter", ts).alias("q"), D.date_part("hour", ts).alias("h"),
        D.day_of_month(ts).alias("dom"), D.day_of_year(ts).alias("doy"),
        D.make_date(F.year(ts), F.month(ts), F.lit(1)).alias("first_day"),
        D.make_datetime(F.year(ts), F.month(ts), F.day(ts), F.hour(ts)).alias("whole_hour"),
    )


@query(
    "names",
    """SELECT o_orderkey, dayname(o_orderdate) AS long_day, left(dayname(o_orderdate), 3) AS short_day,
       monthname(o_orderdate) AS long_month, left(monthname(o_orderdate), 3) AS short_month FROM orders""",
)
def names(t):
    d = "o_orderdate"
    return t.orders.select(
        "o_orderkey", D.day_name(d, short=False).alias("long_day"), D.day_name(d).alias("short_day"),
        D.month_name(d, short=False).alias("long_month"), D.month_name(d).alias("short_month"),
    )


_DAYS = {
    "es": "lunes martes miércoles jueves viernes sábado domingo",
    "fr": "lundi mardi mercredi jeudi vendredi samedi dimanche",
    "de": "Montag Dienstag Mittwoch Donnerstag Freitag Samstag Sonntag",
    "fi": "maanantai tiistai keskiviikko torstai perjantai lauantai sunnuntai",
}
_MONTHS = {
    "nl": "januari februari maart april mei juni juli augustus september oktober november december",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
}


def _pick(words: str, index: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words.split()) + f"][{index}]"


@query(
    "names_localized",
    "SELECT o_orderkey, "
    + ", ".join(f"{_pick(w, 'isodow(o_orderdate)')} AS day_{k}" for k, w in _DAYS.items())
    + ", "
    + ", ".join(f"{_pick(w, 'month(o_orderdate)')} AS month_{k}" for k, w in _MONTHS.items())
    + " FROM orders",
)
def names_localized(t):
    d = "o_orderdate"
    return t.orders.select(
        "o_orderkey", *(D.day_name(d, False, k).alias(f"day_{k}") for k in _DAYS), *(D.month_name(d, False, k).alias(f"month_{k}") for k in _MONTHS)
    )


@query(
    "days_offset",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) - 1 AS yesterday, CAST(o_orderdate AS DATE) + 1 AS tomorrow, CAST(o_orderdate AS DATE) - 7 AS back7,
       CAST(o_orderdate AS DATE) + 10 AS ahead10 FROM orders""",
)
def days_offset(t):
    d = "o_orderdate"
    return t.orders.select(
        "o_orderkey", D.yesterday(d).alias("yesterday"), D.tomorrow(d).alias("tomorrow"), D.n_days_ago(7, d).alias("back7"), D.n_days_away(10, d).alias("ahead10")
    )


@query(
    "weeks_offset",
    """SELECT o_orderkey, CAST(date_trunc('week', o_orderdate - INTERVAL 7 DAY) AS DATE) AS last_week, CAST(date_trunc('week', o_orderdate + INTERVAL 7 DAY) AS DATE) AS next_week,
       CAST(date_trunc('week', o_orderdate - INTERVAL 84 DAY) AS DATE) AS back12, CAST(date_trunc('week', o_orderdate + INTERVAL 21 DAY) AS DATE) AS ahead3 FROM orders""",
)
def weeks_offset(t):
    d = "o_orderdate"
    return t.orders.select(
        "o_orderkey", D.last_week(d).alias("last_week"), D.next_week(d).alias("next_week"), D.n_weeks_ago(12, d).alias("back12"), D.n_weeks_away(3, d).alias("ahead3")
    )


_M = "date_trunc('month', o_orderdate)"


@query(
    "months_offset",
    f"""SELECT o_orderkey, CAST({_M} - INTERVAL 1 MONTH AS DATE) AS last_month, CAST({_M} + INTERVAL 1 MONTH AS DATE) AS next_month,
       CAST({_M} - INTERVAL 14 MONTH AS DATE) AS back14, CAST({_M} + INTERVAL 3 MONTH AS DATE) AS ahead3,
       monthname({_M} - INTERVAL 1 MONTH) AS last_name, left(monthname({_M} + INTERVAL 1 MONTH), 3) AS next_name,
       CAST(month({_M} - INTERVAL 1 MONTH) AS INTEGER) AS last_number, CAST(month({_M} + INTERVAL 1 MONTH) AS INTEGER) AS next_number FROM orders""",
)
def months_offset(t):
    d = "o_orderdate"
    return t.orders.select(
        "o_orderkey", D.last_month(d).alias("last_month"), D.next_month(d).alias("next_month"), D.n_months_ago(14, d).alias("back14"),
        D.n_months_away(3, d).alias("ahead3"), D.last_month_name(d, short=False).alias("last_name"), D.next_month_name(d).alias("next_name"),
        D.last_month_number(d).alias("last_number"), D.next_month_number(d).alias("next_number"),
    )


@query(
    "periods_since",
    """SELECT event_id, date_sub('day', ts, TIMESTAMP '2024-03-01') AS days, date_sub('hour', ts, TIMESTAMP '2024-03-01') AS hours,
       date_sub('minute', ts, TIMESTAMP '2024-03-01') AS minutes, date_sub('month', ts, TIMESTAMP '2024-03-01') AS months,
       date_sub('week', ts, TIMESTAMP '2024-03-01') AS weeks FROM events""",
)
def periods_since(t):
    end = F.lit("2024-03-01").cast("timestamp_ntz")
    return t.events.select("event_id", *(D.periods_since("ts", end, p).alias(f"{p}s") for p in ("day", "hour", "minute", "month", "week")))


@query("round_timestamp", "SELECT event_id, CAST(date_trunc('day', ts + INTERVAL 12 HOUR) AS TIMESTAMP) AS nearest FROM events")
def round_timestamp(t):
    return t.events.select("event_id", D.round_timestamp("ts").alias("nearest"))


@query(
    "unix_time",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS back,
       make_timestamp(epoch_us(ts) // 1000 * 1000) AS back_ms, make_timestamp(event_id * 1000003) AS from_us FROM events""",
)
def unix_time(t):
    seconds = D.to_unixtimestamp("ts")
    millis = F.floor(F.extract(F.lit("second"), F.col("ts")) * 1000) % 1000
    return t.events.select(
        "event_id", seconds.alias("seconds"), D.from_unixtimestamp(seconds).alias("back"),
        D.from_unixtimestamp((seconds * 1000 + millis).cast("bigint"), "milliseconds").alias("back_ms"),
        D.from_unixtimestamp((F.col("event_id") * 1000003), "microseconds").alias("from_us"),
    )


@query(
    "tz_convert",
    """SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS new_york, (ts AT TIME ZONE 'Asia/Tokyo') AT TIME ZONE 'UTC' AS from_tokyo,
       CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS la_day FROM events""",
)
def tz_convert(t):
    return t.events.select(
        "event_id", D.convert_timezone("ts", "America/New_York").alias("new_york"), D.now("ts", "UTC", "Asia/Tokyo").alias("from_tokyo"),
        D.today("ts", "America/Los_Angeles").alias("la_day"),
    )


@query(
    "fiscal_454",
    """WITH ends AS (SELECT y, m + CAST(x AS INTEGER) AS e FROM (
         SELECT y, last_day(make_date(CAST(y AS INTEGER), 1, 31)) AS m, unnest(range(-3, 4)) AS x FROM range(1993, 2004) AS r(y)) WHERE dayofweek(m + CAST(x AS INTEGER)) = 6),
       years AS (SELECT y - 1 AS fy, lag(e) OVER (ORDER BY y) + 1 AS s, e FROM ends),
       o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, fy, s, CAST((CAST(o_orderdate AS DATE) - s) // 7 + 1 AS INTEGER) AS w FROM orders JOIN years ON CAST(o_orderdate AS DATE) BETWEEN s AND e),
       q AS (SELECT *, least((w - 1) // 13, 3) + 1 AS qn FROM o), p AS (SELECT *, w - (qn - 1) * 13 AS qw FROM q),
       r AS (SELECT *, CASE WHEN qw <= 4 THEN 1 WHEN qw <= 9 THEN 2 ELSE 3 END AS pq FROM p)
       SELECT o_orderkey, CAST(fy AS INTEGER) AS fiscal_year_number, s + (w - 1) * 7 AS week_start_date, s + (w - 1) * 7 + 6 AS week_end_date, w AS fiscal_week_of_year,
         CAST(qw - CASE pq WHEN 1 THEN 0 WHEN 2 THEN 4 ELSE 9 END AS INTEGER) AS fiscal_week_of_period, CAST((qn - 1) * 3 + pq AS INTEGER) AS fiscal_period_number,
         CAST(qn AS INTEGER) AS fiscal_quarter_number, CAST(pq AS INTEGER) AS fiscal_period_of_quarter FROM r""",
)
def fiscal_454(t):
    """Retail calendar closing on the Saturday nearest to January 31."""
    rows = t.orders.select("o_orderkey", D.fiscal_period("o_orderdate", year_end_month=1, week_start_day=1).alias("f"))
    return rows.select("o_orderkey", "f.*")
