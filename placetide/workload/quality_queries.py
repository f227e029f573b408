"""Check rules over every layer and over the raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from placetide.operators import adjacency as A
from placetide.operators import checks as C
from placetide.operators.relational import missing_keys
from placetide.plans import quality as Q
from placetide.schemas import LEVELS
from placetide.workload import standins as S
from placetide.workload.registry import query

# Row and year counts the derived tables are held to; the boundary years fall short on purpose.
EXPECT = Q.Expectations(
    survey_rows={"states": 25, "counties": 125, "tracts": 900},
    boundary_rows={"states": 25, "counties": 125, "tracts": 1000},
    gold_rows={"states": 25, "counties": 125, "tracts": 1200},
    place_years=7,
    flow_years=tuple(range(1995, 2002)),
    spot_state="06",
    spot_from_year=1999,
    spot_low=50,
    spot_high=100,
)
AGGREGATE_LIST = ", ".join(str(c) for c in Q.AGGREGATE_CODES)


def _verdict(df):
    return df.select("table", "check", "severity", "passed", "observed")


def _line(table, check, source, observed, passed="o = 0", severity="ERROR", guard=True) -> str:
    """One result row; ``observed`` is an aggregate over ``source`` (a table or subquery)."""
    verdict = f"({passed})"
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{severity}' AS severity, {verdict} AS passed, CAST(o AS STRING) AS observed "
        f"FROM (SELECT CAST({observed} AS BIGINT) AS o FROM {source})"
    )


def _per_year(source: str) -> str:
    return f"(SELECT survey_year, count(*) AS n FROM {source} GROUP BY survey_year)"


def _dupes(source: str, keys: str) -> str:
    return f"(SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"


def _place_silver_lines(table, cte, rows, level) -> list[str]:
    compare = "<>" if level == "states" else "<"
    return [
        _line(table, "row_count_per_year", _per_year(cte), f"count_if(n {compare} {rows[level]})"),
        _line(table, "no_null_geography_id", cte, "count_if(geography_id IS NULL)"),
        _line(table, "no_duplicate_keys", _dupes(cte, "geography_id, survey_year"), "count(*)"),
        _line(table, "all_years_present", cte, "count(DISTINCT survey_year)", f"o = {EXPECT.place_years}"),
    ]


def _union(ctes, lines) -> str:
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(lines)


@query(
    "checks_survey",
    _union(
        [S.survey_sql(level, f"s_{level}") for level in LEVELS],
        [x for level in LEVELS for x in _place_silver_lines(f"silver_acs5_{level}", f"s_{level}", EXPECT.survey_rows, level)],
    ),
)
def checks_survey(t):
    rules = {k: v for k, v in Q.silver_rules(EXPECT).items() if k.startswith("silver_acs5")}
    return _verdict(C.run_checks(t.spark, {f"silver_acs5_{level}": S.survey(t, level) for level in LEVELS}, rules))


@query(
    "checks_boundary",
    _union(
        [S.boundary_sql(level, f"b_{level}") for level in LEVELS],
        [x for level in LEVELS for x in _place_silver_lines(f"silver_tiger_{level}", f"b_{level}", EXPECT.boundary_rows, level)],
    ),
)
def checks_boundary(t):
    rules = {k: v for k, v in Q.silver_rules(EXPECT).items() if k.startswith("silver_tiger")}
    return _verdict(C.run_checks(t.spark, {f"silver_tiger_{level}": S.boundary(t, level) for level in LEVELS}, rules))


@query(
    "checks_bronze_geometry",
    _union(
        [S.boundary_sql(level, f"b_{level}") for level in LEVELS],
        [_line(f"bronze_tiger_{level}", "geometry_present", f"b_{level}", "count(*) - count(geometry_wkt)") for level in LEVELS],
    ),
)
def checks_bronze_geometry(t):
    tables = {f"bronze_tiger_{level}": S.boundary_bronze(t, level) for level in LEVELS}
    return _verdict(C.run_checks(t.spark, tables, Q.bronze_rules()))


_FLOW_TABLES = {"states": "irs_state_outflows", "counties": "irs_county_outflows"}


def _silver_flow_lines(level) -> list[str]:
    table, cte = f"silver_{_FLOW_TABLES[level]}", f"f_{level}"
    lines = [
        _line(table, "no_aggregates", cte, f"count_if(CAST(substr(dest_geography_id, 1, 2) AS INTEGER) IN ({AGGREGATE_LIST}))"),
        _line(table, "no_suppressed", cte, "count_if(households = -1 OR individuals = -1)"),
        _line(table, "no_null_keys", cte, "count_if(origin_geography_id IS NULL OR dest_geography_id IS NULL)"),
    ]
    if level == "states":
        lines.append(_line(table, "all_years", cte, "count(DISTINCT survey_year)", "o = 7"))
    return lines


@query("checks_flows", _union([S.flows_sql(x, f"f_{x}") for x in _FLOW_TABLES], [y for x in _FLOW_TABLES for y in _silver_flow_lines(x)]))
def checks_flows(t):
    rules = {k: v for k, v in Q.silver_rules(EXPECT).items() if k.startswith("silver_irs")}
    return _verdict(C.run_checks(t.spark, {f"silver_{n}": S.flows(t, x) for x, n in _FLOW_TABLES.items()}, rules))


def _gold_lines(level) -> list[str]:
    table, cte = f"gold_{level}", f"g_{level}"
    missing = " + ".join(f"count(*) - count({c})" for c in Q.COMPLETE[level])
    lines = [
        _line(table, "row_count_per_year", _per_year(cte), f"count_if(n < {EXPECT.gold_rows[level]})"),
        _line(table, "no_duplicate_keys", _dupes(cte, "geography_id, survey_year"), "count(*)"),
        _line(table, "geometry_present", cte, "count(*) - count(geometry_wkt)"),
        _line(table, "metric_completeness", cte, missing),
    ]
    if level == "states":
        outside = "count_if(state_fips = '06' AND survey_year >= 1999 AND total_population <> 0 AND (total_population < 50 OR total_population > 100))"
        lines.append(_line(table, "population_sanity", cte, outside, severity="WARN"))
    return lines


@query("checks_gold_places", _union([S.gold_sql(x, f"g_{x}") for x in LEVELS], [y for x in LEVELS for y in _gold_lines(x)]))
def checks_gold_places(t):
    rules = {k: v for k, v in Q.gold_rules(EXPECT).items() if "irs" not in k}
    return _verdict(C.run_checks(t.spark, {f"gold_{level}": S.gold(t, level) for level in LEVELS}, rules))


def _gold_flow_lines(level) -> list[str]:
    table, cte = f"gold_{_FLOW_TABLES[level]}", f"f_{level}"
    return [
        _line(table, "row_count_per_year", cte, "7 - count(DISTINCT survey_year)"),
        _line(table, "no_null_keys", cte, "count_if(origin_geography_id IS NULL OR dest_geography_id IS NULL)"),
        _line(table, "is_non_migrant_coverage", cte, "least(count_if(is_non_migrant), count_if(NOT is_non_migrant))", "o > 0"),
    ]


@query("checks_gold_flows", _union([S.flows_sql(x, f"f_{x}") for x in _FLOW_TABLES], [y for x in _FLOW_TABLES for y in _gold_flow_lines(x)]))
def checks_gold_flows(t):
    rules = {k: v for k, v in Q.gold_rules(EXPECT).items() if "irs" in k}
    return _verdict(C.run_checks(t.spark, {f"gold_{n}": S.flows_gold(t, x) for x, n in _FLOW_TABLES.items()}, rules))


def _source_lines() -> list[str]:
    lines = []
    for level in LEVELS:
        for k in ("geography_id", "survey_year"):
            lines.append(_line(f"gold_{level}", f"not_null_{k}", f"g_{level}", f"count_if({k} IS NULL)"))
        lines.append(_line(f"gold_{level}", "unique_combination", _dupes(f"g_{level}", "geography_id, survey_year"), "count(*)"))
    for level, name in _FLOW_TABLES.items():
        for k in ("origin_geography_id", "dest_geography_id", "survey_year"):
            lines.append(_line(f"gold_{name}", f"not_null_{k}", f"f_{level}", f"count_if({k} IS NULL)"))
    keys = "origin_geography_id, dest_geography_id, survey_year"
    lines.append(_line("gold_irs_state_outflows", "unique_combination", _dupes("f_states", keys), "count(*)"))
    return lines


@query(
    "checks_sources",
    _union([S.gold_sql(x, f"g_{x}") for x in LEVELS] + [S.flows_sql(x, f"f_{x}") for x in _FLOW_TABLES], _source_lines()),
)
def checks_sources(t):
    tables = {f"gold_{level}": S.gold(t, level) for level in LEVELS}
    tables |= {f"gold_{n}": S.flows_gold(t, x) for x, n in _FLOW_TABLES.items()}
    return _verdict(C.run_checks(t.spark, tables, Q.source_rules()))


# --- plain aggregates -------------------------------------------------------------------------


@query("row_counts_by_year", "SELECT CAST(year(o_orderdate) AS INTEGER) AS survey_year, CAST(count(*) AS BIGINT) AS row_count FROM orders GROUP BY 1 ORDER BY 1")
def row_counts_by_year(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("survey_year")).agg(F.count("*").alias("row_count")).orderBy("survey_year")


@query(
    "year_coverage",
    "SELECT CAST(count(DISTINCT year(l_shipdate)) AS BIGINT) AS year_count, CAST(count(*) AS BIGINT) AS row_count FROM lineitem",
)
def year_coverage(t):
    return t.lineitem.agg(F.countDistinct(F.year("l_shipdate")).alias("year_count"), F.count("*").alias("row_count"))


@query("dup_keys", "SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies")).filter("copies > 1")


@query(
    "coverage",
    f"WITH {S.mart_sql('tracts')} SELECT survey_year, CAST(count(*) AS BIGINT) AS places, CAST(count(bachelors_plus_rate) AS BIGINT) AS bachelors, "
    "CAST(count(remote_work_rate) AS BIGINT) AS remote, CAST(count(geometry_wkt) AS BIGINT) AS outlines FROM mart GROUP BY survey_year",
)
def coverage(t):
    held = {"bachelors_plus_rate": "bachelors", "remote_work_rate": "remote", "geometry_wkt": "outlines"}
    return S.mart(t, "tracts").groupBy("survey_year").agg(F.count("*").alias("places"), *(F.count(c).alias(n) for c, n in held.items()))


# --- rules over the raw tables ----------------------------------------------------------------


@query(
    "checks_values",
    _union(
        ["one AS (SELECT 1)"],
        [
            _line("orders", "expression_is_true", "orders", "count_if(NOT (o_totalprice > 1100 AND o_orderkey >= 0))"),
            _line("orders", "urgent_only", "orders", "count_if(o_orderpriority = '1-URGENT' AND NOT (o_totalprice > 2000))"),
            _line("orders", "not_accepted_values", "orders", "count_if(o_orderstatus IN ('P', 'X'))"),
            _line("orders", "accepted_range", "orders", "count_if(o_totalprice < 1000 OR o_totalprice > 400000)"),
            _line("orders", "positive", "orders", "count_if(o_orderkey <= 0)"),
            _line("orders", "key_at_least_customer", "orders", "count_if(o_orderkey < o_custkey)"),
            _line("pages", "not_empty_string", "(SELECT trim(split_part(url, '?', 2)) AS q FROM pages)", "count_if(q = '')"),
            _line("pages", "not_empty_raw", "(SELECT split_part(url, '?', 2) AS q FROM pages)", "count_if(q = '')"),
        ],
    ),
)
def checks_values(t):
    rules = {
        "orders": [
            C.expression_is_true("o_totalprice > 1100 AND o_orderkey >= 0"),
            C.expression_is_true("o_totalprice > 2000", where="o_orderpriority = '1-URGENT'", name="urgent_only"),
            C.not_accepted_values("o_orderstatus", ["P", "X"]),
            C.accepted_range("o_totalprice", 1000, 400000),
            C.accepted_range("o_orderkey", 0, inclusive=False, name="positive"),
            C.accepted_range("o_orderkey", F.col("o_custkey"), name="key_at_least_customer"),
        ],
        "pages": [C.not_empty_string("q"), C.not_empty_string("q", trim_whitespace=False, name="not_empty_raw")],
    }
    pages = t.pages.select(F.split_part("url", F.lit("?"), F.lit(2)).alias("q"))
    return _verdict(C.run_checks(t.spark, {"orders": t.orders, "pages": pages}, rules))


_GROUPS = "(SELECT user_id, count(*) AS n, count(nullif(event_type, 'error')) AS have, min(event_type) AS lo, max(event_type) AS hi, max(ts) AS newest FROM events GROUP BY user_id)"


@query(
    "checks_groups",
    _union(
        ["one AS (SELECT 1)"],
        [
            _line("events", "at_least_one", "events", "CASE WHEN count(nullif(event_type, 'error')) = 0 THEN 1 ELSE 0 END"),
            _line("events", "at_least_one_user", _GROUPS, "count_if(have = 0)"),
            _line("events", "not_constant", "events", "CASE WHEN min(event_type) = max(event_type) THEN 1 ELSE 0 END"),
            _line("events", "not_constant_user", _GROUPS, "count_if(lo = hi)"),
            _line("events", "not_null_proportion", "events", "CASE WHEN count(nullif(event_type, 'error')) / count(*) BETWEEN 0.75 AND 1 THEN 0 ELSE 1 END"),
            _line("events", "not_null_proportion_user", _GROUPS, "count_if(have / n < 0.75 OR have / n > 0.9)"),
            _line("events", "recency", "events", "CASE WHEN max(ts) < TIMESTAMP '2024-01-29 12:00:00' THEN 1 ELSE 0 END"),
            _line("events", "recency_user", _GROUPS, "count_if(newest < TIMESTAMP '2024-01-29 12:00:00')"),
            _line("events", "recency_user_day", _GROUPS, "count_if(CAST(newest AS DATE) < DATE '2024-01-30')"),
        ],
    ),
)
def checks_groups(t):
    events = t.events.withColumn("kind", F.nullif("event_type", F.lit("error")))
    user = ["user_id"]
    as_of = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    rules = [
        C.at_least_one("kind"),
        C.at_least_one("kind", user, name="at_least_one_user"),
        C.not_constant("event_type"),
        C.not_constant("event_type", user, name="not_constant_user"),
        C.not_null_proportion("kind", 0.75),
        C.not_null_proportion("kind", 0.75, 0.9, user, name="not_null_proportion_user"),
        C.recency("ts", as_of, "2 days"),
        C.recency("ts", as_of, "2 days", user, name="recency_user"),
        C.recency("ts", as_of, "1 day", user, ignore_time_component=True, name="recency_user_day"),
    ]
    return _verdict(C.run_checks(t.spark, {"events": events}, {"events": rules}))


_COUNTS = "(SELECT nation, count(*) FILTER (src = 'c') AS a, count(*) FILTER (src = 's') AS b FROM (SELECT c_nationkey AS nation, 'c' AS src FROM customer UNION ALL SELECT s_nationkey, 's' FROM supplier) GROUP BY nation)"


@query(
    "checks_relations",
    _union(
        ["one AS (SELECT 1)"],
        [
            _line("customer", "equal_rowcount", "customer", "CASE WHEN count(*) = (SELECT count(*) FROM supplier) THEN 0 ELSE 1 END"),
            _line("customer", "equal_rowcount_nation", _COUNTS, "count_if(a <> b)"),
            _line("customer", "fewer_rows_than", "customer", "CASE WHEN count(*) < (SELECT count(*) FROM orders) THEN 0 ELSE 1 END"),
            _line("customer", "fewer_rows_nation", _COUNTS, "count_if(a >= b)"),
            _line("customer", "cardinality_equality", _COUNTS, "count_if(a <> b)"),
            _line("customer", "same_nations", "(SELECT DISTINCT c_nationkey AS k FROM customer EXCEPT SELECT n_nationkey FROM nation)", "2 * count(*)"),
            _line("customer", "relationships", "customer", "count_if(c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000))"),
            _line("customer", "relationships_where", "customer", "count_if(c_acctbal < 0 AND c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000))"),
        ],
    ),
)
def checks_relations(t):
    customer, supplier = t.customer, t.supplier
    c_nations = customer.select(F.col("c_nationkey").alias("nation"))
    s_nations = supplier.select(F.col("s_nationkey").alias("nation"))
    plain = C.run_checks(
        t.spark,
        {"customer": customer},
        {
            "customer": [
                C.equal_rowcount(supplier),
                C.fewer_rows_than(t.orders),
                C.cardinality_equality("c_nationkey", supplier, "s_nationkey"),
                C.relationships("c_nationkey", supplier, "s_nationkey", to_condition="s_acctbal > 9000"),
                C.relationships(
                    "c_nationkey", supplier, "s_nationkey", "c_acctbal < 0", "s_acctbal > 9000", name="relationships_where"
                ),
            ]
        },
    )
    nations = t.nation.select(F.col("n_nationkey").alias("nation"))
    grouped = C.run_checks(
        t.spark,
        {"customer": c_nations},
        {
            "customer": [
                C.equal_rowcount(s_nations, ["nation"], name="equal_rowcount_nation"),
                C.fewer_rows_than(s_nations, ["nation"], name="fewer_rows_nation"),
                C.equality(nations, name="same_nations"),
            ]
        },
    )
    return _verdict(plain.unionByName(grouped))


@query(
    "relationships",
    """SELECT event_id, user_id FROM events WHERE event_type = 'error' AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""",
)
def relationships(t):
    from placetide.operators.relational import orphans

    return orphans(t.events, "user_id", t.customer, "c_custkey", "event_type = 'error'", "c_acctbal > 5000").select("event_id", "user_id")


# --- neighbours -------------------------------------------------------------------------------


def _range_line(name: str, keep: str, over: str) -> str:
    bad_next = f"nxt IS NOT NULL AND NOT (hi {keep} nxt)"
    return f"""SELECT '{name}' AS rule, CAST(count_if(NOT (lo < hi) OR ({bad_next})) AS BIGINT) AS violations FROM (
      SELECT lo, hi, lead(lo) OVER ({over} ORDER BY lo, hi) AS nxt FROM spans)"""


@query(
    "exclusive_ranges",
    "WITH spans AS (SELECT o_custkey AS who, min(o_orderdate) AS lo, max(o_orderdate) AS hi, date_trunc('year', o_orderdate) AS y FROM orders GROUP BY o_custkey, y) "
    + " UNION ALL ".join(
        [
            _range_line("per_customer_allowed", "<=", "PARTITION BY who"),
            _range_line("per_customer_required", "<", "PARTITION BY who"),
            _range_line("per_customer_not_allowed", "=", "PARTITION BY who"),
            _range_line("all_customers", "<=", ""),
        ]
    ),
)
def exclusive_ranges(t):
    """Each customer's first-to-last order span per year, held against the gap rules."""
    spans = t.orders.groupBy(F.col("o_custkey").alias("who"), F.year("o_orderdate").alias("y")).agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")
    )

    # The three rules per customer share one pass over the neighbours.
    rules = {f"per_customer_{g}": A.range_conflicts("lo", "hi", g) for g in ("allowed", "required", "not_allowed")}
    per_customer = A.with_next(spans, ["who"], ["lo", "hi"]).agg(*(F.sum(c).alias(n) for n, c in rules.items()))
    overall = A.exclusive_range_violations(spans, "lo", "hi").agg(F.sum("violations").alias("all_customers"))
    counts = [df.unpivot([], df.columns, "rule", "violations") for df in (per_customer, overall)]
    return counts[0].union(counts[1]).withColumn("violations", F.coalesce("violations", F.lit(0)))


@query(
    "sequential_values",
    """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS violations FROM (
         SELECT *, lead(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS nxt FROM lineitem)
       WHERE nxt IS NOT NULL AND nxt <> l_linenumber + 1 GROUP BY 1, 2""",
)
def sequential_values(t):
    return A.sequence_violations(t.lineitem, "l_linenumber", group_by=["l_orderkey"]).drop("copies")


@query(
    "sequential_dates",
    """SELECT o_orderdate, CAST(count(*) AS BIGINT) AS violations FROM (SELECT o_orderdate, lead(o_orderdate) OVER (ORDER BY o_orderdate) AS nxt FROM orders)
       WHERE nxt IS NOT NULL AND nxt <> o_orderdate + INTERVAL 1 DAY GROUP BY 1""",
)
def sequential_dates(t):
    """Whole-table order, no group: blocks keep the sort spread out."""
    return A.sequence_violations(t.orders, "o_orderdate", 1, "day").drop("copies")


# --- keys due ---------------------------------------------------------------------------------


@query(
    "missing_partitions",
    f"""WITH {S.gold_sql('counties')}, wanted AS (SELECT y AS survey_year, lpad(CAST(s AS STRING), 2, '0') AS state FROM range(1995, 2002) AS a(y), range(0, 30) AS b(s))
       SELECT CAST(survey_year AS INTEGER) AS survey_year, state FROM wanted WHERE NOT EXISTS (
         SELECT 1 FROM gold g WHERE g.survey_year = wanted.survey_year AND g.state_fips = wanted.state)""",
)
def missing_partitions(t):
    from placetide.streaming.arrivals import expected_partitions

    bounds = t.orders.agg(F.year(F.min("o_orderdate")).alias("lo"), F.year(F.max("o_orderdate")).alias("hi"))
    years = bounds.select(F.explode(F.sequence("lo", "hi")).alias("survey_year"))
    wanted = expected_partitions(years, [f"{s:02d}" for s in range(30)])
    return missing_keys(wanted, S.gold(t, "counties").withColumnRenamed("state_fips", "state"), ["survey_year", "state"])


@query(
    "available_years",
    """SELECT o_orderkey, CAST(year(d) - CASE WHEN month(d) < 12 THEN 2 ELSE 1 END AS INTEGER) AS survey_year, CAST(least(year(d) - 1, 2023) AS INTEGER) AS flow_year,
       CAST(greatest(year(d) - CASE WHEN month(d) < 12 THEN 2 ELSE 1 END - 2011, 0) AS INTEGER) AS survey_years
       FROM (SELECT o_orderkey, CAST(o_orderdate + INTERVAL 25 YEAR AS DATE) AS d FROM orders)""",
)
def available_years(t):
    """Newest year out on each order date moved 25 years on."""
    from placetide.functions import keys as K

    day = F.add_months("o_orderdate", 300)
    latest = K.latest_survey_year(day)
    return t.orders.select(
        "o_orderkey", latest.alias("survey_year"), K.latest_flow_year(day).alias("flow_year"), F.size(K.available_years(latest)).alias("survey_years")
    )


def _duplicates_line(table: str, key: str) -> str:
    dupes = f"SELECT {key} AS k FROM {table} GROUP BY {key} HAVING count(*) > 1"
    return f"""SELECT '{table}' AS "table", 'no_duplicate_keys' AS "check", 'ERROR' AS severity, count(*) = 0 AS passed, CAST(count(*) AS STRING) AS observed,
      'unique {key}' AS expected, (SELECT string_agg(t, ', ' ORDER BY t) FROM (SELECT CAST(k AS STRING) AS t FROM ({dupes}) ORDER BY k LIMIT 3)) AS sample FROM ({dupes})"""


@query("checks_samples", " UNION ALL ".join(_duplicates_line(*x) for x in (("customer", "c_nationkey"), ("orders", "o_custkey"), ("events", "event_id"))))
def checks_samples(t):
    """Whole result rows, with what was expected and the first offenders."""
    keys = {"customer": "c_nationkey", "orders": "o_custkey", "events": "event_id"}
    return C.run_checks(t.spark, {n: getattr(t, n) for n in keys}, {n: [C.unique_key(k)] for n, k in keys.items()})
