"""Data-quality rules whose results are DataFrames.

Every check yields one row ``(table, check, severity, passed, observed, expected, sample)``.
A table that is missing, unreadable or empty fails all of its checks.

Rules that are plain aggregates are folded: all of them on one table (and one grouping) run
in a single scan and a single two-step aggregate, first per group (a year, say), then over
the groups. A key rule joins them where its key determines the groups: rows are counted by key
first and those counts rolled up. All steps combine map-side, so no rule gathers a group in one
task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placetide.operators.adjacency import exclusive_range_violations, sequence_violations
from placetide.operators.relational import orphans, two_way_except

ERROR, WARN = "ERROR", "WARN"
RESULT_SCHEMA = (
    "`table` string, `check` string, severity string, passed boolean, "
    "observed string, expected string, sample string"
)
SAMPLE_SIZE = 3


@dataclass(frozen=True)
class AggregateRule:
    """``parts`` are aggregates per group; ``observed`` and ``passed`` aggregate the groups.

    In ``observed`` / ``passed`` a part ``p`` of this rule is the column ``part("p")``, the
    group's row count is ``rows``. Rules with equal ``by`` share one pass.
    """

    name: str
    parts: Mapping[str, Column]
    observed: Callable[[Callable[[str], Column]], Column]
    passed: Callable[[Column], Column]
    expected: str
    by: tuple[str, ...] = ()
    sample: Callable[[Callable[[str], Column]], Column] | None = None
    severity: str = ERROR
    # How a part's values of smaller groups give that of a larger one.
    merge: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)


@dataclass(frozen=True)
class FrameRule:
    """``build(df)`` returns one row ``(observed, passed, sample)``; with a fourth column
    ``some`` it also says whether the table has rows, else that is looked up."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    expected: str
    severity: str = ERROR


@dataclass(frozen=True)
class KeyRule(FrameRule):
    """A :class:`FrameRule` that counts rows by key; the aggregate rules of groups that the key
    determines are answered from the same counts."""

    columns: tuple[str, ...] = ()


Rule = AggregateRule | FrameRule


# --- row counts -----------------------------------------------------------------------


def rows_per_year(expected: int, exact: bool, year: str = "survey_year", name: str = "row_count_per_year") -> AggregateRule:
    """Exactly, or at least, ``expected`` rows in every year; observed = years that differ."""

    def wrong(part):
        return (F.col("rows") != expected) if exact else (F.col("rows") < expected)

    return AggregateRule(
        name,
        {},
        lambda part: F.count_if(wrong(part)),
        lambda o: o == 0,
        f"{'=' if exact else '>='} {expected} rows per year",
        by=(year,),
        sample=lambda part: F.min(F.when(wrong(part), F.col(year).cast("string"))),
    )


def rows_in_years(years: Sequence[int], year: str = "survey_year", name: str = "row_count_per_year") -> AggregateRule:
    """At least one row in each expected year; observed = expected years without rows."""
    wanted = [int(y) for y in years]
    return AggregateRule(
        name,
        {},
        lambda part: F.lit(len(wanted)) - F.count_if(F.col(year).isin(*wanted) & (F.col("rows") > 0)),
        lambda o: o == 0,
        f"rows in {len(wanted)} years",
        by=(year,),
    )


def year_count(expected: int, year: str = "survey_year", name: str = "all_years_present") -> AggregateRule:
    """Number of distinct years."""
    return AggregateRule(
        name, {}, lambda part: F.count(F.col(year)), lambda o: o == expected, f"{expected} years", by=(year,)
    )


# --- values ---------------------------------------------------------------------------


def count_where(
    name: str, condition: Column, expected: str = "0 rows", by: tuple[str, ...] = (), severity: str = ERROR
) -> AggregateRule:
    """No row may meet ``condition``; observed = rows that do."""
    return AggregateRule(
        name,
        {"bad": F.count_if(condition)},
        lambda part: F.sum(part("bad")),
        lambda o: o == 0,
        expected,
        by=by,
        severity=severity,
    )


def not_null(*columns: str, name: str = "no_null_keys", by=()) -> AggregateRule:
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return count_where(name, missing, by=by)


def codes_absent(code: Column, codes: Sequence[int], name: str = "no_aggregates", by=()) -> AggregateRule:
    return count_where(name, code.isin(*codes), by=by)


def sentinel_absent(columns: Sequence[str], sentinel: int, name: str = "no_suppressed", by=()) -> AggregateRule:
    hit = reduce(lambda a, b: a | b, [F.col(c) == sentinel for c in columns])
    return count_where(name, hit, by=by)


def fully_covered(*columns: str, name: str = "metric_completeness", by=()) -> AggregateRule:
    """``count(column) = count(*)`` for each column; observed = missing cells."""
    parts = {f"have_{i}": F.count(F.col(c)) for i, c in enumerate(columns)}

    def missing(part):
        return F.sum(reduce(lambda a, b: a + b, [F.col("rows") - part(p) for p in parts]))

    return AggregateRule(name, parts, missing, lambda o: o == 0, "no missing cell in " + ", ".join(columns), by=by)


def range_spot(
    name: str, value: Column, where: Column, low, high, severity: str = WARN, by=()
) -> AggregateRule:
    """Selected rows must lie in [low, high]; NULL and 0 are skipped."""
    outside = where & (value != 0) & ((value < low) | (value > high))
    return count_where(name, outside, f"{low} .. {high}", by=by, severity=severity)


def both_flags(column: str, name: str | None = None, by=()) -> AggregateRule:
    """A boolean column must hold both values; observed = the rarer one's count."""
    return AggregateRule(
        name or f"{column}_coverage",
        {"yes": F.count_if(F.col(column)), "no": F.count_if(~F.col(column))},
        lambda part: F.least(F.sum(part("yes")), F.sum(part("no"))),
        lambda o: o > 0,
        "both values occur",
        by=by,
    )


def expression_is_true(expression: str | Column, where: str | Column | None = None, name: str = "expression_is_true", by=()) -> AggregateRule:
    """The expression holds on every (selected) row; NULL counts as a failure."""
    test = F.expr(expression) if isinstance(expression, str) else expression
    bad = ~F.coalesce(test, F.lit(False))
    if where is not None:
        bad = bad & F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))
    return count_where(name, bad, by=by)


def not_empty_string(column: str, trim_whitespace: bool = True, name: str = "not_empty_string", by=()) -> AggregateRule:
    text = F.trim(column) if trim_whitespace else F.col(column)
    return count_where(name, text == "", by=by)


def not_accepted_values(column: str, values: Sequence, name: str = "not_accepted_values", by=()) -> AggregateRule:
    return count_where(name, F.col(column).isin(*values), by=by)


def accepted_range(
    column: str, min_value=None, max_value=None, inclusive: bool = True, where: str | Column | None = None, name: str = "accepted_range", by=()
) -> AggregateRule:
    """Bounds are numbers or columns; a NULL value is not judged."""
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    value = F.col(column)
    out = []
    if min_value is not None:
        out.append(value < min_value if inclusive else value <= min_value)
    if max_value is not None:
        out.append(value > max_value if inclusive else value >= max_value)
    bad = reduce(lambda a, b: a | b, out)
    if where is not None:
        bad = bad & (F.expr(where) if isinstance(where, str) else where)
    return count_where(name, bad, by=by)


# --- rules that may run per group: observed = failing groups ----------------------------


def _per_group(name, parts, failing, expected, by, severity=ERROR, merge=None) -> AggregateRule:
    return AggregateRule(
        name,
        parts,
        lambda part: F.count_if(F.coalesce(failing(part), F.lit(True))),
        lambda o: o == 0,
        expected,
        by=tuple(by),
        severity=severity,
        merge=merge or {},
    )


def at_least_one(column: str, group_by: Sequence[str] = (), name: str = "at_least_one") -> AggregateRule:
    return _per_group(name, {"have": F.count(F.col(column))}, lambda p: p("have") == 0, "a value in every group", group_by)


def not_constant(column: str, group_by: Sequence[str] = (), name: str = "not_constant") -> AggregateRule:
    """At least two different values; min and max decide, so no distinct count is needed."""
    parts = {"low": F.min(column), "high": F.max(column)}
    merge = {"low": F.min, "high": F.max}
    return _per_group(name, parts, lambda p: p("low") == p("high"), "two values in every group", group_by, merge=merge)


def not_null_proportion(
    column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = (), name: str = "not_null_proportion"
) -> AggregateRule:
    def outside(p):
        ratio = p("have") / F.nullif(F.col("rows"), F.lit(0))
        return (ratio < at_least) | (ratio > at_most)

    return _per_group(
        name, {"have": F.count(F.col(column))}, outside, f"{at_least} .. {at_most}", group_by
    )


def recency(
    column: str,
    as_of: Column,
    interval: str,
    group_by: Sequence[str] = (),
    ignore_time_component: bool = False,
    name: str = "recency",
) -> AggregateRule:
    """Newest value no older than ``as_of - interval``; a group without values fails.

    The reference point is an argument, so a re-run gives the same answer.
    """
    newest = F.max(F.col(column))
    threshold = as_of - F.expr(f"interval {interval}")
    if ignore_time_component:
        newest, threshold = newest.cast("date"), threshold.cast("date")
    return _per_group(
        name, {"newest": newest}, lambda p: p("newest") < threshold, f"within {interval}", group_by, merge={"newest": F.max}
    )


# --- keys and relations ------------------------------------------------------------------


def unique_key(*columns: str, name: str = "no_duplicate_keys") -> FrameRule:
    """No key combination occurs twice; the sample lists the first offenders.

    Counting by key combines map-side, so a hot key costs one row per input task.
    """

    def build(df: DataFrame) -> DataFrame:
        counted = df.groupBy(*columns).agg(F.count("*").alias("n"))
        # The sample reads the same counts; Spark reuses their shuffle.
        return counted.agg(
            F.count_if(F.col("n") > 1).alias("observed"),
            (F.count_if(F.col("n") > 1) == 0).alias("passed"),
            (F.count("*") > 0).alias("some"),
        ).withColumn("sample", _repeated_keys(counted, columns, "n").scalar())

    return KeyRule(name, build, "unique " + ", ".join(columns), columns=columns)


def _repeated_keys(counted: DataFrame, columns: Sequence[str], n: str) -> DataFrame:
    """The first keys counted more than once, in one text; NULL if there are none."""
    text = F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns))
    first = counted.filter(F.col(n) > 1).orderBy(*columns).limit(SAMPLE_SIZE).select(text.alias("k"))
    return first.agg(F.nullif(F.array_join(F.array_sort(F.collect_list("k")), ", "), F.lit("")).alias("s"))


def _counted(rows: DataFrame, expected_zero: Column | None = None) -> DataFrame:
    n = F.count("*") if expected_zero is None else expected_zero
    return rows.agg(n.alias("observed"), (n == 0).alias("passed"), F.lit(None).cast("string").alias("sample"))


def equality(
    other: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    precision: int | None = None,
    name: str = "equality",
) -> FrameRule:
    """Both relations hold the same distinct rows; observed = differing rows + the imbalance."""

    def build(df: DataFrame) -> DataFrame:
        diff = two_way_except(df, other, compare_columns, exclude_columns, precision)
        sides = F.count_if(F.col("which_diff") == "a_minus_b") - F.count_if(F.col("which_diff") == "b_minus_a")
        return _counted(diff, F.count("*") + F.abs(F.coalesce(sides, F.lit(0))))

    return FrameRule(name, build, "equal relations")


def _group_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Row counts of both relations per group in one stacked aggregate (no full outer join)."""
    def side(df, flag):
        return df.select(*group_by, F.lit(flag).alias("_a"))

    both = side(a, True).unionByName(side(b, False))
    counts = (F.count_if(F.col("_a")).alias("n_a"), F.count_if(~F.col("_a")).alias("n_b"))
    return both.groupBy(*group_by).agg(*counts)


def equal_rowcount(other: DataFrame, group_by: Sequence[str] = (), name: str = "equal_rowcount") -> FrameRule:
    """Same number of rows (in every group); observed = groups that differ."""
    return FrameRule(
        name,
        lambda df: _counted(_group_counts(df, other, group_by).filter("n_a != n_b")),
        "equal row counts",
    )


def fewer_rows_than(other: DataFrame, group_by: Sequence[str] = (), name: str = "fewer_rows_than") -> FrameRule:
    """Strictly fewer rows than the other relation (in every group)."""
    return FrameRule(
        name,
        lambda df: _counted(_group_counts(df, other, group_by).filter("n_a >= n_b")),
        "fewer rows",
    )


def cardinality_equality(column: str, other: DataFrame, field_: str, name: str = "cardinality_equality") -> FrameRule:
    """Each value occurs equally often on both sides; observed = values that do not."""

    def build(df: DataFrame) -> DataFrame:
        a = df.select(F.col(column).alias("v"))
        b = other.select(F.col(field_).alias("v"))
        return _counted(_group_counts(a, b, ["v"]).filter("n_a != n_b"))

    return FrameRule(name, build, "equal value counts")


def relationships(
    column: str,
    to: DataFrame,
    field_: str,
    from_condition: str | Column | None = None,
    to_condition: str | Column | None = None,
    name: str = "relationships",
) -> FrameRule:
    def build(df: DataFrame) -> DataFrame:
        # Rows are counted per key first, so a hot key crosses the join as one row.
        wanted = df if from_condition is None else df.filter(from_condition)
        keys = wanted.groupBy(column).agg(F.count("*").alias("n"))
        lost = orphans(keys, column, to, field_, to_condition=to_condition)
        return _counted(lost, F.coalesce(F.sum("n"), F.lit(0)))

    return FrameRule(name, build, "every key found")


def exclusive_ranges(lower: str, upper: str, name: str = "mutually_exclusive_ranges", **options) -> FrameRule:
    return FrameRule(
        name,
        lambda df: _counted(
            exclusive_range_violations(df, lower, upper, **options), F.coalesce(F.sum("violations"), F.lit(0))
        ),
        "no range conflicts",
    )


def sequential_values(column: str, name: str = "sequential_values", **options) -> FrameRule:
    return FrameRule(
        name,
        lambda df: _counted(sequence_violations(df, column, **options), F.coalesce(F.sum("violations"), F.lit(0))),
        "no broken step",
    )


# --- running -----------------------------------------------------------------------------


def _failed(spark: SparkSession, table: str, rules: Sequence[Rule], why: str) -> DataFrame:
    rows = [(table, r.name, r.severity, False, None, r.expected, why) for r in rules]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def _parts(rules: Sequence[AggregateRule]) -> list[Column]:
    return [p.alias(f"r{i}_{k}") for i, r in enumerate(rules) for k, p in r.parts.items()]


def _aggregate_rows(
    table: str, df: DataFrame, by: tuple[str, ...], rules: Sequence[AggregateRule], key: KeyRule | None = None, sample_key: bool = True
) -> DataFrame:
    """The rules' rows; with ``key`` its row too, from one count by key that is rolled up to the
    groups, so the table is read once for all. ``sample_key`` lists repeated keys, which counts
    the keys again."""
    if key is None:
        grouped = df.groupBy(*by).agg(F.count("*").alias("rows"), *_parts(rules))
    else:
        keyed = df.groupBy(*key.columns).agg(F.count("*").alias("rows"), *_parts(rules))
        merged = [
            r.merge.get(k, F.sum)(F.col(f"r{i}_{k}")).alias(f"r{i}_{k}") for i, r in enumerate(rules) for k in r.parts
        ]
        repeated = F.count_if(F.col("rows") > 1).alias("repeated_keys")
        grouped = keyed.groupBy(*by).agg(F.sum("rows").alias("rows"), repeated, *merged)

    finals, wanted = [], list(rules)
    for i, rule in enumerate(rules):
        def part(key, i=i):
            return F.col(f"r{i}_{key}")

        finals.append(rule.observed(part).alias(f"o{i}"))
        sample = rule.sample(part) if rule.sample else F.lit(None)
        finals.append(sample.cast("string").alias(f"s{i}"))
    if key is not None:
        finals.append(F.sum("repeated_keys").alias(f"o{len(wanted)}"))
        wanted.append(key)
    summary = grouped.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total"), *finals)
    if key is not None:
        listed = _repeated_keys(keyed, key.columns, "rows").scalar() if sample_key else F.lit(None).cast("string")
        summary = summary.withColumn(f"s{len(rules)}", listed)

    lines = []
    for i, rule in enumerate(wanted):
        observed = F.col(f"o{i}")
        passed = observed == 0 if isinstance(rule, KeyRule) else rule.passed(observed)
        verdict = (F.col("total") > 0) & F.coalesce(passed, F.lit(False))
        empty = F.when(F.col("total") == 0, F.lit("empty table"))
        if isinstance(rule, KeyRule):
            # No group means no key that repeats.
            observed = F.coalesce(observed, F.lit(0))
        lines.append(
            F.struct(
                F.lit(table).alias("table"),
                F.lit(rule.name).alias("check"),
                F.lit(rule.severity).alias("severity"),
                verdict.alias("passed"),
                observed.cast("string").alias("observed"),
                F.lit(rule.expected).alias("expected"),
                F.coalesce(empty, F.col(f"s{i}")).alias("sample"),
            )
        )
    return summary.select(F.inline(F.array(*lines)))


def _frame_row(table: str, df: DataFrame, rule: FrameRule) -> DataFrame:
    result = rule.build(df)
    if "some" not in result.columns:
        result = result.withColumn("some", df.limit(1).agg((F.count("*") > 0).alias("x")).scalar())
    return result.select(
        F.lit(table).alias("table"),
        F.lit(rule.name).alias("check"),
        F.lit(rule.severity).alias("severity"),
        (F.col("some") & F.coalesce(F.col("passed"), F.lit(False))).alias("passed"),
        F.col("observed").cast("string").alias("observed"),
        F.lit(rule.expected).alias("expected"),
        F.when(~F.col("some"), F.lit("empty table")).otherwise(F.col("sample").cast("string")).alias("sample"),
    )


# Rules that are answered together, and what builds their rows.
Job = tuple[list[Rule], Callable[[], DataFrame]]


def _jobs(table: str, df: DataFrame, rules: Sequence[Rule], together: bool = True, sample_keys: bool = True) -> list[Job]:
    """Rules by what answers them. ``together`` folds a key rule and the aggregate rules whose
    groups its key determines into one pass over the table, a second one if ``sample_keys``."""
    groupings: dict[tuple[str, ...], list[AggregateRule]] = {}
    for rule in rules:
        if isinstance(rule, AggregateRule):
            groupings.setdefault(rule.by, []).append(rule)
    frames = [r for r in rules if isinstance(r, FrameRule)]
    keys: dict[tuple[str, ...], KeyRule] = {}
    for rule in frames if together else []:
        fitting = [by for by in groupings if isinstance(rule, KeyRule) and set(by) <= set(rule.columns) and by not in keys]
        if fitting:
            keys[max(fitting, key=lambda by: len(groupings[by]))] = rule
    folded = set(map(id, keys.values()))
    jobs: list[Job] = [
        ([*same, *([keys[by]] if by in keys else [])], lambda by=by, same=same: _aggregate_rows(table, df, by, same, keys.get(by), sample_keys))
        for by, same in groupings.items()
    ]
    return jobs + [([r], lambda r=r: _frame_row(table, df, r)) for r in frames if id(r) not in folded]


def _built(jobs: Sequence[Job]) -> DataFrame:
    return reduce(DataFrame.unionByName, [build() for _, build in jobs])


def planned(table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rules' results as one plan that has not run yet."""
    return _built(_jobs(table, df, rules))


# What a plan or a read that fails raises.
UNREADABLE = (PySparkException, Py4JJavaError)


def _reason(error: Exception) -> str:
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return f"unreadable: {condition or 'read error'}"


def _run(spark: SparkSession, jobs: Sequence[Job]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in _built(jobs).collect()], RESULT_SCHEMA)


def _run_once(spark: SparkSession, frames: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """All rules of all tables in one job that reads each table once for its folded rules.

    Keys are counted again only where some repeat, to list them.
    """
    jobs = [job for table, df in frames.items() for job in _jobs(table, df, rules[table], sample_keys=False)]
    keys = {(t, r.name): r for t in frames for r in rules[t] if isinstance(r, KeyRule)}
    found = []
    for row in _built(jobs).collect():
        key = keys.get((row["table"], row["check"]))
        listed = row["sample"]
        if key is not None and listed is None and row["observed"] != "0":
            counted = frames[row["table"]].groupBy(*key.columns).agg(F.count("*").alias("n"))
            listed = _repeated_keys(counted, key.columns, "n").first()[0]
        found.append((*tuple(row)[:-1], listed))
    return spark.createDataFrame(found, RESULT_SCHEMA)


def check_table(spark: SparkSession, table: str, source, rules: Sequence[Rule]) -> DataFrame:
    """Results of all rules on one table; ``source`` is a DataFrame or a function giving one.

    The rules are run here, in one job: their results are one row each. A table that cannot be
    read, be it a missing column or a damaged file met while reading, fails the rules that meet
    it and no others.
    """
    return run_checks(spark, {table: source}, {table: rules})


def _apart(spark: SparkSession, table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Each job of a table on its own, so that only the rules that fail do."""
    try:
        return _run_once(spark, {table: df}, {table: rules})
    except UNREADABLE:
        pass
    out = []
    for job in _jobs(table, df, rules, together=False):
        try:
            out.append(_run(spark, [job]))
        except UNREADABLE as error:
            out.append(_failed(spark, table, job[0], _reason(error)))
    return reduce(DataFrame.unionByName, out)


def run_checks(spark: SparkSession, tables: Mapping[str, object], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """All rules of all tables; a table with rules but no source fails them.

    One job answers all tables; only if it fails does each table run on its own.
    """
    frames: dict[str, DataFrame] = {}
    results = []
    for table, wanted in rules.items():
        try:
            if table not in tables:
                results.append(_failed(spark, table, wanted, "unreadable: no such table"))
                continue
            source = tables[table]
            frames[table] = source() if callable(source) else source
        except UNREADABLE as error:
            results.append(_failed(spark, table, wanted, _reason(error)))
    if frames:
        try:
            results.append(_run_once(spark, frames, rules))
        except UNREADABLE:
            results += [_apart(spark, table, df, rules[table]) for table, df in frames.items()]
    return reduce(DataFrame.unionByName, results)
