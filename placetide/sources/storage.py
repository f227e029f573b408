"""Partitioned files and tables: write, replay, read back.

Tables are parquet. A replayed year is written beside the old one, into a folder of its own, and
the table's partition is then pointed at it: whoever reads the table by its name sees the old rows
of that year or the new ones, never none or half of them. There is no transaction log: several
years of one replay change one after the other.
"""

from __future__ import annotations

import atexit
import tempfile
import time
from collections.abc import Sequence
from urllib.parse import unquote, urlparse
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetide.schemas import BUCKET_COUNT

YEAR = "survey_year"
# Kept with the table: an overwrite replaces the partitions it brings and no others, whatever the
# session's own mode is at that moment.
_DYNAMIC = "partitionOverwriteMode"
# A bucket is read by one task; with so few rows it is never too large for it.
BUCKET_ROWS = 20_000_000
# How long replaced partitions stay for readers that have begun with them: a day.
KEEP_SECONDS = 86_400


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """New folder path under the cluster's shared checkpoint folder.

    Only a local session without one gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="placetide-")
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), "placetide", *parts, uuid4().hex])


_scratch: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """Like :func:`shared_dir`, for what only this process needs: removed when it ends."""
    path = shared_dir(spark, *parts)
    _scratch.append((spark, path))
    return path


@atexit.register
def remove_scratch() -> None:
    """Remove the scratch folders made so far whose session still runs."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            folder, files = _folder(spark, path)
            files.delete(folder, True)
        except Exception:  # noqa: BLE001  the session has ended; its folders stay
            return


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a scratch folder and read back.

    This cuts the lineage: later steps neither repeat the work nor depend on the executors
    that did it.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Group rows by partition keys before a write.

    REBALANCE is a shuffle AQE may split: small partitions merge into right-sized files, and
    a key holding much of the data becomes several files written by several tasks.
    """
    return df.hint("rebalance", *[F.col(k) for k in keys]) if keys else df


def write_bronze(df: DataFrame, path: str, *keys: str) -> None:
    """Snappy parquet at ``year=Y`` or ``year=Y/state=FF``; only the folders present in ``df``
    change.

    ``year`` repeats ``survey_year``, which stays in the files. A ``state`` key lives in the
    folder name only and :func:`read_bronze` puts it back.
    """
    if "year" in keys:
        year = F.col("year") if "year" in df.columns else F.col(YEAR)
        # A row without a year would land in a folder that nothing finds again.
        df = df.withColumn("year", F.coalesce(year, F.raise_error(F.lit("row without a year")).cast("int")))
    spread(df, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "snappy"
    ).partitionBy(*keys).parquet(path)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType, year: int | None = None) -> DataFrame:
    """Bronze files under a declared schema, all years or one, with all nested folders.

    No partition discovery: it would turn the text code "06" into the number 6. Columns a
    file lacks read as NULL, or as the folder's own key where there is one (``state=06``).
    """
    root = path if year is None else f"{path}/year={int(year)}"
    files = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root)
    if "state" not in schema.fieldNames():
        return files
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/state=([^/]+)/", 1)
    known = ~folder.isin("", "__HIVE_DEFAULT_PARTITION__")
    state = F.coalesce(F.col("state"), F.when(known, folder)).alias("state")
    return files.select(*(state if c == "state" else F.col(c) for c in schema.fieldNames()))


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (YEAR,),
    bucket_by: str | None = None,
    buckets: int = BUCKET_COUNT,
    location: str | None = None,
) -> bool:
    """Create a typed, partitioned (and bucketed) table unless it exists; True if created."""
    if spark.catalog.tableExists(name):
        return False
    inner = [f for f in schema if f.name not in partition_by]
    ordered = inner + [schema[p] for p in partition_by]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered)
    clauses = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"]
    if partition_by:
        clauses.append(f"OPTIONS ({_DYNAMIC} 'dynamic')")
        clauses.append("PARTITIONED BY (" + ", ".join(f"`{p}`" for p in partition_by) + ")")
    if bucket_by:
        clauses.append(f"CLUSTERED BY (`{bucket_by}`) INTO {int(buckets)} BUCKETS")
    if location:
        quoted = location.replace("'", "\\'")
        clauses.append(f"LOCATION '{quoted}'")
    clauses.append("TBLPROPERTIES ('parquet.compression'='snappy')")
    spark.sql(" ".join(clauses))
    return True


def _described(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").collect()
    # A partition's own facts come before those of its table.
    return {r["col_name"]: r["data_type"] for r in reversed(rows)}


def _partitions(spark: SparkSession, table: str) -> dict[str, str]:
    """Partitions of a table: folder name (``survey_year=2020/state=06``) -> SQL clause."""
    parts = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]

    def clause(part: str) -> str:
        keys = [p.split("=", 1) for p in part.split("/")]
        return "PARTITION (" + ", ".join(f"`{k}` = {_key_literal(v)}" for k, v in keys) + ")"

    return {p: clause(p) for p in parts}


def _key_literal(folder_value: str) -> str:
    if folder_value == "__HIVE_DEFAULT_PARTITION__":
        return "NULL"
    return _quoted(unquote(folder_value))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _of_years(partitions: dict[str, str], years: Sequence[int]) -> dict[str, str]:
    wanted = {f"{YEAR}={y}" for y in years}
    return {p: c for p, c in partitions.items() if wanted & set(p.split("/"))}


def _observed_years(seen: Observation, rows: DataFrame, years: list[int]) -> dict[int, int]:
    try:
        found = seen.get
        return {y: found[f"y{y}"] for y in years}
    except Py4JJavaError:
        # A source the optimizer knows to be empty takes the observation out with it.
        counted = {r[YEAR]: r["count"] for r in rows.groupBy(YEAR).count().collect()}
        return {y: counted.get(y, 0) for y in years}


def backfill_years(
    df: DataFrame,
    table: str,
    years: Sequence[int],
    bucket_by: str | None = None,
    keep_seconds: float = KEEP_SECONDS,
) -> dict[int, int]:
    """Replace the given years of a table by the rows of ``df``; returns rows per year.

    The rows are written to a new folder under the table's own (``_versions/``), by a twin of the
    table with the same columns, partitions and buckets. Then the partitions are pointed there, one
    change of the catalog each, so a reader of the table never meets a year absent or half written,
    and a run that dies before that changes nothing. Running it twice leaves the same table. Row
    counts come from the write itself (observed metrics, no second scan); a year delivered without
    rows ends up absent. What the partitions pointed at before is left to readers that have begun
    with it and removed by a later replay after ``keep_seconds`` (:func:`sweep_replaced`).

    Read such a table by its name: its folder alone does not tell which version is in force.
    """
    spark = df.sparkSession
    years = [int(y) for y in years]
    rows = df.filter(F.col(YEAR).isin(*years)).select(*spark.table(table).columns)
    home = _described(spark, table)["Location"].rstrip("/")
    version = f"{home}/_versions/{uuid4().hex}"
    twin = f"{table}_v{uuid4().hex}"
    spark.sql(f"CREATE TABLE {twin} LIKE {table} LOCATION {_quoted(version)}")
    try:
        seen = Observation()
        counts = [F.count_if(F.col(YEAR) == y).alias(f"y{y}") for y in years]
        keys = [YEAR] + ([bucket_by] if bucket_by else [])
        spread(rows.observe(seen, *counts), *keys).write.insertInto(twin)
        written = _observed_years(seen, rows, years)
        delivered = _partitions(spark, twin)
    finally:
        # The twin has a location of its own, so its files stay.
        spark.sql(f"DROP TABLE {twin}")
    held = _of_years(_partitions(spark, table), years)
    before = {p: _described(spark, table, clause)["Location"] for p, clause in held.items()}
    for part in held.keys() & delivered.keys():
        spark.sql(f"ALTER TABLE {table} {held[part]} SET LOCATION {_quoted(f'{version}/{part}')}")
    new = [f"{c} LOCATION {_quoted(f'{version}/{p}')}" for p, c in delivered.items() if p not in held]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(new))
    gone = [c for p, c in held.items() if p not in delivered]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(gone))
    spark.catalog.refreshTable(table)
    for folder in before.values():
        _note_replaced(spark, home, folder)
    sweep_replaced(spark, table, keep_seconds)
    return written


def _note_replaced(spark: SparkSession, home: str, folder: str) -> None:
    note, files = _folder(spark, f"{home}/_replaced/{uuid4().hex}")
    out = files.create(note, True)
    out.write(bytearray(folder.encode()))
    out.close()


def sweep_replaced(spark: SparkSession, table: str, keep_seconds: float = KEEP_SECONDS) -> list[str]:
    """Remove the folders of replaced partitions ``keep_seconds`` after they were replaced; returns
    them. A reader that takes longer than that fails rather than reading less."""
    home = _described(spark, table)["Location"].rstrip("/")
    notes, files = _folder(spark, f"{home}/_replaced")
    removed = []
    for note in files.listStatus(notes) if files.exists(notes) else []:
        if time.time() - note.getModificationTime() / 1000 < keep_seconds:
            continue
        stream = files.open(note.getPath())
        folder = bytes(stream.readAllBytes()).decode()
        stream.close()
        files.delete(_folder(spark, folder)[0], True)
        files.delete(note.getPath(), False)
        removed.append(folder)
    return removed


def full_refresh(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (YEAR,),
    bucket_by: str | None = None,
    buckets: int = BUCKET_COUNT,
    location: str | None = None,
) -> None:
    """Drop and rebuild a table from ``df`` (all years)."""
    spark = df.sparkSession
    keys = [*partition_by, *([bucket_by] if bucket_by else [])]
    # What is read may be the table itself; its rows are safe before it goes.
    if spark.catalog.tableExists(table):
        own = urlparse(_described(spark, table).get("Location") or "").path.rstrip("/") + "/"
        if any(urlparse(f).path.startswith(own) for f in df.inputFiles()):
            df = stored(df, "refresh")
        spark.sql(f"DROP TABLE {table}")
    if location:
        folder, files = _folder(spark, location)
        files.delete(folder, True)
    create_table(spark, table, df.schema, partition_by, bucket_by, buckets, location)
    spread(df.select(*spark.table(table).columns), *keys).write.insertInto(table, overwrite=True)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def set_mark(spark: SparkSession, path: str, name: str) -> None:
    """Leave an empty file as a note that outlives the process."""
    file, files = _folder(spark, f"{path}/{name}")
    files.create(file, True).close()


def clear_mark(spark: SparkSession, path: str, name: str) -> None:
    file, files = _folder(spark, f"{path}/{name}")
    files.delete(file, False)


def marks(spark: SparkSession, path: str) -> list[str]:
    """Names of the notes left under a path."""
    return sorted(n for n in _listing(spark, path) or [] if not n.startswith((".", "_")))


def _listing(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder, or None where there is no such folder; file metadata only."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return None
    return [f.getPath().getName() for f in files.listStatus(folder)]


def has_landed(spark: SparkSession, path: str) -> bool:
    """The folder is there and holds something."""
    return bool(_listing(spark, path))


def landed_years(spark: SparkSession, path: str) -> list[int]:
    """Years with a ``year=Y`` folder under a bronze path."""
    names = _listing(spark, path) or []
    return sorted(int(n[5:]) for n in names if n.startswith("year=") and n[5:].isdigit())


def table_years(spark: SparkSession, table: str, key: str = YEAR) -> list[int]:
    """Years a partitioned table holds, from its partition list: no row is read."""
    parts = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    found = {dict(x.split("=", 1) for x in p.split("/")).get(key) for p in parts}
    return sorted(int(y) for y in found if y and y.isdigit())


def partition_keys(spark: SparkSession, table: str, keys: Sequence[str] = (YEAR,)) -> DataFrame:
    """The different keys a table holds, as they are at the call.

    Where all keys are partition columns they come from the table's partition list, one row for
    each partition and typed as in the table: no data file is opened. A partition that other
    writers left without rows is listed as well. For any other table the rows are reduced.
    """
    held = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not set(keys) <= set(held):
        return spark.table(table).select(*keys).distinct()
    types = {f.name: f.dataType for f in spark.table(table).schema}
    parts = F.split("partition", "/")

    def value(key: str) -> Column:
        # Folder names are escaped as in addresses, but for the plus sign.
        text = F.get(parts, held.index(key)).substr(F.lit(len(key) + 2), F.length("partition"))
        plain = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
        return F.when(text != "__HIVE_DEFAULT_PARTITION__", plain).cast(types[key]).alias(key)

    listed = spark.sql(f"SHOW PARTITIONS {table}").select(*(value(k) for k in keys))
    # Several partitions share a key where the table has further partition columns.
    return listed if set(keys) == set(held) else listed.distinct()


def buckets_of(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    """Bucket columns and number of buckets of a table, None where it has none."""
    described = _described(spark, table)
    if "Num Buckets" not in described:
        return None
    columns = described["Bucket Columns"].strip("[]").replace("`", "")
    return [c.strip() for c in columns.split(",")], int(described["Num Buckets"])


def bucket_rows(spark: SparkSession, table: str) -> DataFrame:
    """``bucket, n``: rows of each bucket that has some, counted from file footers."""
    # Fixed form of the names of bucketed files: the bucket's number behind the last underscore.
    number = F.regexp_extract("_metadata.file_name", r"_(\d+)(?:\..*)?$", 1).cast("int")
    return spark.table(table).groupBy(number.alias("bucket")).agg(F.count("*").alias("n"))


def even_buckets(spark: SparkSession, table: str, rows: int = BUCKET_ROWS, times: float = 4) -> bool:
    """No bucket has both more than ``rows`` rows and ``times`` the mean of all buckets."""
    held = buckets_of(spark, table)
    if held is None:
        return False
    most = bucket_rows(spark, table).agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    return not most["total"] or most["most"] <= max(rows, times * most["total"] / held[1])


def create_view(df: DataFrame, name: str) -> None:
    """Session view of a projection (staging views)."""
    df.createOrReplaceTempView(name)


def with_metrics(df: DataFrame, name: str = "write", **extra: Column) -> tuple[DataFrame, Observation]:
    """The frame to write and an observation of its row count and any further aggregates."""
    seen = Observation(name)
    metrics = [F.count(F.lit(1)).alias("row_count"), *(c.alias(k) for k, c in extra.items())]
    return df.observe(seen, *metrics), seen


def write_with_metrics(df: DataFrame, path: str, *keys: str, **labels) -> dict:
    """Write bronze and report row count, target and duration of that one write."""
    start = time.monotonic()
    observed, seen = with_metrics(df)
    write_bronze(observed, path, *keys)
    return {
        "row_count": seen.get["row_count"],
        "target": path,
        "duration_seconds": round(time.monotonic() - start, 2),
        **labels,
    }
