"""Readers for landed files. Every value stays text until the silver layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetide.plans.layers import rename_variables
from placetide.schemas import BOUNDARY_BRONZE
from placetide.sources.storage import stored

_DOCUMENT = "array<array<string>>"


def explode_header_json(df: DataFrame, column: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of ``[[header...], [row...], ...]`` documents held in a text column.

    Each row is paired with its own document's header, so column order may differ between
    documents. A name the header lacks reads as NULL.
    """
    parsed = F.from_json(F.col(column), _DOCUMENT)
    rows = (
        df.select(*keep, parsed.alias("_doc"))
        .filter(F.size("_doc") > 1)
        .select(*keep, F.col("_doc")[0].alias("_head"), F.explode(F.slice("_doc", 2, F.size("_doc") - 1)).alias("_row"))
    )
    return _named_cells(rows, names, keep)


def _named_cells(rows: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    # A short or long row is paired with its header as far as both go.
    cut = F.least(F.size("_head"), F.size("_row"))
    cells = F.map_from_arrays(F.slice("_head", 1, cut), F.slice("_row", 1, cut))
    return rows.select(*keep, cells.alias("_cells")).select(*keep, *(F.try_element_at("_cells", F.lit(n)).alias(n) for n in names))


def read_header_json(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Landed survey responses, one document per file, files read in parallel.

    A document is one response of the source (a level and a year, or one state of it), so
    its size is set by the source, not by how much has landed. Documents that hold a row a line
    need not be read whole: see :func:`read_header_lines`.
    """
    files = spark.read.text(path, wholetext=True)
    return explode_header_json(files, "value", names)


def read_header_lines(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Landed survey responses of one or more whole rows a line, so that several tasks share a file.

    The line that opens a document, ``[[...]``, holds its header; all other lines are paired
    with it by the file's path. Headers, one row per file, are stored first: their true size is
    known then, and Spark sends them to all tasks or joins them by path. Files are read twice for that. A line that
    is no row, a file with rows but no header and a file with two headers raise.
    """
    text = F.regexp_replace("value", r"^\s+|\s*,?\s*$", "")
    lines = spark.read.text(path).select(text.alias("text"), F.col("_metadata.file_path").alias("file")).filter("text <> ''")
    opens = F.col("text").rlike(r"^\[\s*\[")
    whole = F.concat(
        F.when(opens, "").otherwise("["), "text", F.when(F.col("text").rlike(r"\]\s*\]$"), "").otherwise("]")
    )
    broken = F.raise_error(F.concat(F.lit("no rows of a response in "), "file")).cast(_DOCUMENT)
    lines = lines.select("file", opens.alias("opens"), F.coalesce(F.from_json(whole, _DOCUMENT), broken).alias("_doc"))
    heads = lines.filter("opens").groupBy("file").agg(F.min(F.col("_doc")[0]).alias("_head"), F.count("*").alias("n"))
    twice = F.raise_error(F.concat(F.lit("more than one header in "), "file")).cast("array<string>")
    heads = stored(heads.select(F.col("file"), F.when(F.col("n") == 1, F.col("_head")).otherwise(twice).alias("_head")), "headers")
    body = F.when(F.col("opens"), F.slice("_doc", F.lit(2), F.size("_doc"))).otherwise(F.col("_doc"))
    rows = lines.select("file", F.explode(body).alias("_row")).join(heads, "file", "left")
    none = F.raise_error(F.concat(F.lit("no header in "), "file")).cast("array<string>")
    return _named_cells(rows.select(F.coalesce("_head", none).alias("_head"), "_row"), names)


def add_ingest_columns(df: DataFrame, year: int | Column, ingest_date: str) -> DataFrame:
    """``survey_year`` and ``ingest_date``; the date is an argument so a re-run repeats."""
    survey_year = year if isinstance(year, Column) else F.lit(year)
    return df.withColumns({"survey_year": survey_year.cast("bigint"), "ingest_date": F.lit(ingest_date)})


def survey_bronze(
    spark: SparkSession, path: str, variables: Sequence[str], year: int, ingest_date: str, by_lines: bool = False
) -> DataFrame:
    """Survey responses as bronze rows: renamed variables, place codes, ingest columns.

    ``by_lines`` shares large documents of a row a line among tasks (:func:`read_header_lines`).
    """
    names = ["NAME", *variables, "state", "county", "tract"]
    read = read_header_lines if by_lines else read_header_json
    return add_ingest_columns(rename_variables(read(spark, path, names)), year, ingest_date)


def read_text_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header and only string columns.

    Undecodable bytes become U+FFFD and the row is kept. With a string ``schema`` no pass
    over the data is needed to learn the columns.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("encoding", encoding)
    return reader.schema(schema).csv(path) if schema is not None else reader.csv(path)


def period_year(file_name: Column) -> Column:
    """Second year of a file name such as ``stateoutflow1213.csv`` (2013)."""
    return F.regexp_extract(file_name, r"outflow[0-9]{2}([0-9]{2})\.csv", 1).try_cast("int") + 2000


def flow_bronze(spark: SparkSession, path: str, ingest_date: str, schema: T.StructType | None = None) -> DataFrame:
    """Flow files with the year taken from each file's own name."""
    rows = read_text_csv(spark, path, schema)
    return add_ingest_columns(rows, period_year(F.col("_metadata.file_name")), ingest_date)


def normalise_objects(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Object columns to text: NaN and NULL become NULL, anything else its text.

    By default the non-numeric columns are treated; numeric ones keep their type unless
    named.
    """
    names = columns or [f.name for f in df.schema if not isinstance(f.dataType, (T.NumericType, T.StringType))]
    fixes = {}
    for name in names:
        c = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        fixes[name] = c.cast("string")
    return df.withColumns(fixes) if fixes else df


def read_boundaries(
    spark: SparkSession,
    path: str,
    year: int,
    ingest_date: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Landed boundary attributes with the outline as WKT text, in bronze shape.

    Attributes a level lacks (county, tract) read as NULL. Text formats are read as the bronze
    attributes, all text, unless another ``schema`` is given: learning it would read every file
    once more.
    """
    if schema is None and fmt in ("json", "csv"):
        names = [f.name for f in BOUNDARY_BRONZE if f.name not in ("survey_year", "ingest_date")]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.format(fmt)
    landed = (reader.schema(schema) if schema is not None else reader).load(path)
    present = {c.lower(): c for c in landed.columns}
    cols = [
        (F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present else F.lit(None)).alias(f.name)
        for f in BOUNDARY_BRONZE
        if f.name not in ("survey_year", "ingest_date")
    ]
    shaped = add_ingest_columns(normalise_objects(landed.select(*cols)), year, ingest_date)
    return shaped.select(*(F.col(f.name).cast(f.dataType) for f in BOUNDARY_BRONZE))


def wkt_from_geojson(geometry: Column) -> Column:
    """WKT of a GeoJSON Polygon / MultiPolygon given as text, for boundaries landed that way."""
    kind = F.get_json_object(geometry, "$.type")
    body = F.get_json_object(geometry, "$.coordinates")
    pairs = F.regexp_replace(body, r"\[\s*([-+0-9.eE]+)\s*,\s*([-+0-9.eE]+)[^\]]*\]", "$1 $2")
    text = F.regexp_replace(F.translate(pairs, "[]", "()"), r"\s*,\s*", ", ")
    return F.when(kind.isin("Polygon", "MultiPolygon"), F.concat(F.upper(kind), F.lit(" "), text))
