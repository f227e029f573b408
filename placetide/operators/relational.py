"""Relational helpers: DataFrame in, DataFrame out, no actions unless the name says so."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetide.functions.text import slug


def _lower_set(names: Iterable[str] | None) -> set[str]:
    return {n.lower() for n in (names or ())}


def star(
    df: DataFrame, except_: Iterable[str] = (), relation_alias: str | None = None, prefix: str = "", suffix: str = ""
) -> list[Column]:
    """All columns but ``except_`` (case-insensitive), renamed with prefix and suffix."""
    dropped = _lower_set(except_)
    source = f"{relation_alias}." if relation_alias else ""
    return [
        F.col(f"{source}`{c}`").alias(f"{prefix}{c}{suffix}") for c in df.columns if c.lower() not in dropped
    ]


def nullcheck(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Empty text becomes NULL in the string columns; other columns are untouched."""
    wanted = _lower_set(columns) if columns is not None else None
    fixes = {
        f.name: F.nullif(F.col(f"`{f.name}`"), F.lit(""))
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and (wanted is None or f.name.lower() in wanted)
    }
    return df.withColumns(fixes) if fixes else df


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key under ``order_by``.

    ``row_number() = 1`` lets Spark keep one row per key and input task *before* the
    shuffle (``WindowGroupLimit``), so a key holding much of the data never lands in one
    task. Give a total order to make the choice unique.
    """
    rank = F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


# Comparisons the pivot accepts.
COMPARISONS = ("=", "<=>", "<>", "!=", "<", "<=", ">", ">=", "like", "rlike")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int, float)):
        return str(value)
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def pivot_columns(
    column: str,
    values: Iterable,
    alias: bool = True,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: int | str = 1,
    else_value: int | str | None = 0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One aggregate column per value, to be used in ``groupBy(...).agg(*...)``.

    Conditional aggregation: one pass and one shuffle whatever the number of values, and a
    missing cell shows ``else_value``, not NULL. ``agg`` is any aggregate function;
    ``then_value`` / ``else_value`` are numbers or SQL text such as a column name.
    """
    if cmp.lower() not in COMPARISONS:
        raise ValueError(f"cmp must be one of {COMPARISONS}")
    if not agg.isidentifier():
        raise ValueError(f"agg must be a function name, got {agg!r}")
    missing = "NULL" if else_value is None else else_value
    out = []
    for value in values:
        cell = f"CASE WHEN {column} {cmp} {_literal(value)} THEN {then_value} ELSE {missing} END"
        total = F.expr(f"{agg}({'DISTINCT ' if distinct else ''}{cell})")
        name = f"{prefix}{value}{suffix}"
        out.append(total.alias(name if quote_identifiers else slug(name)) if alias else total)
    return out


def pivot(df: DataFrame, group_by: Sequence[str], column: str, values: Iterable[str], **options) -> DataFrame:
    return df.groupBy(*group_by).agg(*pivot_columns(column, values, **options))


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows. ``exclude`` columns are kept on every row, ``remove`` ones dropped;
    NULL cells stay as rows."""
    kept, gone = _lower_set(exclude), _lower_set(remove)
    ids = [c for c in df.columns if c.lower() in kept]
    turned = [c for c in df.columns if c.lower() not in kept | gone]
    if not turned:
        raise ValueError("no columns left to unpivot")
    typed = df.select(*ids, *(F.col(f"`{c}`").cast(cast_to).alias(c) for c in turned))
    return typed.unpivot(ids, turned, field_name, value_name)


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = "source_relation",
    where: str | Column | None = None,
) -> DataFrame:
    """UNION ALL over the superset of columns; a column a relation lacks is a typed NULL.

    The first relation holding a column fixes its type unless ``column_override`` does.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    if not relations:
        raise ValueError("no relations to union")
    override = {k.lower(): v for k, v in (column_override or {}).items()}
    keep, drop = _lower_set(include), _lower_set(exclude)
    # Names differ without regard to case, as Spark resolves them; the first spelling stays.
    types: dict[str, tuple[str, object]] = {}
    for df in relations.values():
        for field in df.schema:
            name = field.name.lower()
            if (keep and name not in keep) or name in drop:
                continue
            types.setdefault(name, (field.name, override.get(name, field.dataType)))
    if not types:
        raise ValueError("no columns left to union")

    def shaped(name: str, df: DataFrame) -> DataFrame:
        if where is not None:
            df = df.filter(where)
        held = {c.lower() for c in df.columns}
        cols = [
            (F.col(f"`{c}`") if key in held else F.lit(None)).cast(t).alias(c) for key, (c, t) in types.items()
        ]
        label = [F.lit(name).alias(source_column_name)] if source_column_name else []
        return df.select(*label, *cols)

    return reduce(DataFrame.unionByName, [shaped(n, df) for n, df in relations.items()])


def _like(name: str, pattern: str) -> bool:
    parts = [".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in pattern.lower()]
    return re.fullmatch("".join(parts), name.lower()) is not None


def relations_by_pattern(
    spark: SparkSession, table_pattern: str, exclude: str = "", schema_pattern: str = "%"
) -> dict[str, DataFrame]:
    """Catalog tables and views whose name matches a LIKE pattern, by name."""
    found: dict[str, DataFrame] = {}
    databases = [d.name for d in spark.catalog.listDatabases() if _like(d.name, schema_pattern)]
    for database in databases:
        for table in spark.catalog.listTables(database):
            if _like(table.name, table_pattern) and not (exclude and _like(table.name, exclude)):
                # Session views carry no database and show up under each one.
                full = table.name if table.isTemporary else f"{database}.{table.name}"
                found[full] = spark.table(full)
    return dict(sorted(found.items()))


def relations_by_prefix(spark: SparkSession, prefix: str, exclude: str = "") -> dict[str, DataFrame]:
    return relations_by_pattern(spark, prefix + "%", exclude)


def comparable_columns(
    a: DataFrame,
    b: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
) -> list[str]:
    """Columns two relations are compared on; without a list both must have the same ones."""
    if compare_columns and exclude_columns:
        raise ValueError("give either compare_columns or exclude_columns, not both")
    if compare_columns:
        return list(compare_columns)
    out = _lower_set(exclude_columns)
    left = [c for c in a.columns if c.lower() not in out]
    right = [c for c in b.columns if c.lower() not in out]
    if _lower_set(left) != _lower_set(right):
        raise ValueError(f"columns differ: {sorted(_lower_set(left) ^ _lower_set(right))}")
    return left


def _rounded(value: Column, digits: int) -> Column:
    """A double rounded to digits behind the point, ties away from zero.

    A value too large to have such digits, an infinity and NaN stay as they are.
    """
    scaled = F.abs(value) * F.lit(10.0**digits)
    whole = F.signum(value) * F.floor(scaled + 0.5).cast("double") / F.lit(10.0**digits)
    # -0.0 is 0.0.
    return F.when(scaled < F.lit(2.0**53), whole + 0.0).otherwise(value)


def two_way_except(
    a: DataFrame,
    b: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows found on one side only, tagged ``a_minus_b`` / ``b_minus_a``.

    Both sides are tagged, stacked and grouped on all compared columns: one shuffle with a
    map-side combine instead of two EXCEPTs with two shuffles each, and copies of one row
    collapse before they travel. NULLs compare as equal.
    """
    columns = comparable_columns(a, b, compare_columns, exclude_columns)
    kinds = {f.name.lower(): f.dataType for f in a.schema}

    def side(df: DataFrame, in_a: bool) -> DataFrame:
        cols = []
        for name in columns:
            c = F.col(f"`{name}`")
            kind = kinds[name.lower()]
            if precision is not None and isinstance(kind, T.DecimalType):
                c = F.round(c, precision)
            elif precision is not None and isinstance(kind, T.FractionalType):
                c = _rounded(c.cast("double"), precision)
            cols.append(c.alias(name))
        return df.select(*cols, F.lit(in_a).alias("_in_a"))

    stacked = side(a, True).unionByName(side(b, False))
    found = stacked.groupBy(*columns).agg(F.bool_or("_in_a").alias("_a"), F.bool_or(~F.col("_in_a")).alias("_b"))
    one_sided = found.filter(F.col("_a") != F.col("_b"))
    which = F.when(F.col("_a"), "a_minus_b").otherwise("b_minus_a").alias("which_diff")
    return one_sided.select(which, *columns)


def _order_terms(terms: str | Sequence[str]) -> list[tuple[str, bool]]:
    """``"min(x) desc"`` as (aggregate, descending)."""
    out = []
    for term in [terms] if isinstance(terms, str) else terms:
        found = re.fullmatch(r"(.*?)(?:\s+(asc|desc))?", term.strip(), re.IGNORECASE | re.DOTALL)
        out.append((found[1], (found[2] or "").lower() == "desc"))
    return out


def column_values(
    df: DataFrame,
    column: str,
    order_by: str | Sequence[str] = "count(*) desc",
    max_records: int | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """Distinct values with their counts, most frequent first (the value breaks ties).

    ``order_by`` is SQL text over the group, such as ``"min(created_at)"`` or the column's
    own name.
    """
    if where is not None:
        df = df.filter(where)
    terms = _order_terms(order_by)
    keys = [F.expr(text).alias(f"_o{i}") for i, (text, _) in enumerate(terms)]
    counted = df.groupBy(column).agg(F.count("*").alias("n"), *keys)
    order = [F.desc(f"_o{i}") if down else F.asc(f"_o{i}") for i, (_, down) in enumerate(terms)]
    ordered = counted.orderBy(*order, F.asc(column))
    ordered = ordered if max_records is None else ordered.limit(max_records)
    return ordered.select(F.col(column).alias("value"), "n")


def column_value_list(df: DataFrame, column: str, max_records: int, default=None, **options) -> list:
    """The first ``max_records`` values on the driver, e.g. to name pivot columns."""
    rows = column_values(df, column, max_records=max_records, **options).select("value").collect()
    return [r["value"] for r in rows] if rows else default


def group_by_first(df: DataFrame, n: int):
    """``groupBy`` on the first ``n`` columns."""
    if not 1 <= n <= len(df.columns):
        raise ValueError(f"n must be between 1 and {len(df.columns)}")
    return df.groupBy(*df.columns[:n])


def single_value(df: DataFrame, default=None):
    """First column of the first row, or ``default`` when there is no row (runs the query)."""
    row = df.select(df.columns[0]).head()
    return default if row is None else row[0]


def results_as_lists(df: DataFrame, max_rows: int) -> dict[str, list]:
    """Whole small result as ``{column: values}``; refuses a result of more than ``max_rows``."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; keep it distributed")
    return {c: [r[c] for r in rows] for c in df.columns}


def missing_keys(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys with no row in ``present``.

    ``present`` is reduced to its distinct keys first, so the join sees one row per key
    however large or skewed the table is.
    """
    return expected.join(present.select(*keys).distinct(), list(keys), "left_anti")


def orphans(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    from_condition: str | Column | None = None,
    to_condition: str | Column | None = None,
) -> DataFrame:
    """Child rows whose non-NULL key has no match among the (filtered) parent rows."""
    if from_condition is not None:
        child = child.filter(from_condition)
    if to_condition is not None:
        parent = parent.filter(to_condition)
    keys = parent.select(F.col(parent_column).alias("_key")).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")
