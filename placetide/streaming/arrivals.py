"""Arrival-driven refresh: which partitions are due, and reacting to landed files."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetide.functions.keys import available_years, latest_flow_year, latest_survey_year
from placetide.operators.relational import missing_keys
from placetide.plans.refresh import FLOW_LEVELS, FLOW_STEM, Layout, refresh_gold, refresh_marts, silver_sources
from placetide.schemas import LEVELS, STATE_FIPS_CODES
from placetide.sources.storage import (
    backfill_years,
    clear_mark,
    create_table,
    has_landed,
    marks,
    partition_keys,
    read_bronze,
    set_mark,
    table_years,
)


def expected_years(spark: SparkSession, as_of: str, source: str = "survey") -> DataFrame:
    """Years that should exist on a date, from the release rule of the source."""
    day = F.lit(as_of).cast("date")
    latest = latest_survey_year(day) if source == "survey" else latest_flow_year(day)
    return spark.range(1).select(F.explode(available_years(latest)).alias("survey_year"))


def expected_partitions(years: DataFrame, states: Sequence[str] = STATE_FIPS_CODES) -> DataFrame:
    """Every year with every state code (the codes are exploded, not joined)."""
    codes = F.array(*(F.lit(s) for s in states))
    return years.select("survey_year", F.explode(codes).alias("state"))


def due_partitions(expected: DataFrame, present: DataFrame, keys: Sequence[str] = ("survey_year",)) -> DataFrame:
    """Expected partitions not yet held."""
    return missing_keys(expected, present, keys)


def due_in_table(
    spark: SparkSession, expected: DataFrame, table: str, keys: Sequence[str] = ("survey_year",)
) -> DataFrame:
    """Expected partitions a stored table does not hold, from its partition list where it has one."""
    return missing_keys(expected, partition_keys(spark, table, keys), keys)


def sync_years(
    spark: SparkSession,
    bronze: Callable[[int], DataFrame],
    table: str,
    expected: DataFrame,
    batch: int = 6,
) -> list[int]:
    """Backfill the missing years of a table, ``batch`` years per write; returns the years.

    The key list is years, a few dozen at most, so it is read to the driver.
    """
    held = set(table_years(spark, table))
    years = sorted(r["survey_year"] for r in expected.select("survey_year").distinct().collect())
    years = [y for y in years if y not in held]
    for i in range(0, len(years), batch):
        some = years[i : i + batch]
        frames = [bronze(y) for y in some]
        rows = frames[0]
        for frame in frames[1:]:
            rows = rows.unionByName(frame)
        backfill_years(rows, table, some)
    return years


def refresh_on_arrival(
    spark: SparkSession,
    bronze_path: str,
    schema: T.StructType,
    to_silver: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    after: Callable[[list[int]], None] | None = None,
) -> list[int]:
    """Process newly landed bronze files once and stop; returns the years refreshed.

    The stream only says *which years* have new files. Each of those years is then rebuilt
    from its whole bronze folder and overwritten, so a year spread over several batches, a
    re-delivery or a retried batch all end in the same table. ``after`` runs once per batch
    with the years, for the layers above. Files outside a ``year=`` folder are reported with a
    warning and left alone; a folder that has not landed yet gives no year.
    """
    if not has_landed(spark, bronze_path):
        return []
    touched: set[int] = set()

    def refresh(batch: DataFrame, _: int) -> None:
        folders = batch.groupBy(F.col("year").try_cast("int").alias("y")).agg(F.min("file").alias("file")).collect()
        years = sorted(r["y"] for r in folders if r["y"] is not None)
        for stray in (r["file"] for r in folders if r["y"] is None):
            warnings.warn(f"file outside a year folder: {stray}", stacklevel=2)
        if not years:
            return
        frames = [to_silver(read_bronze(spark, bronze_path, schema, y)) for y in years]
        rows = frames[0]
        for frame in frames[1:]:
            rows = rows.unionByName(frame)
        backfill_years(rows, table, years)
        touched.update(years)
        if after:
            after(years)

    folder_year = F.regexp_extract(F.col("_metadata.file_path"), "/year=([0-9]{4})/", 1)
    # Only the path is used, so no data column is read.
    query = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .parquet(bronze_path)
        .select(folder_year.alias("year"), F.col("_metadata.file_path").alias("file"))
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sorted(touched)


def cascade_on_arrival(
    spark: SparkSession,
    layout: Layout,
    checkpoint: str,
    levels: Sequence[str] = LEVELS,
    flow_levels: Sequence[str] = FLOW_LEVELS,
) -> dict[str, list[int]]:
    """Carry newly landed files of every source through silver, gold and marts, then stop.

    Gold is refreshed inside the batch, before the stream commits it: a run that dies in between
    is replayed, and every step replaces whole years, so nothing is lost or doubled. Marts are
    refreshed once, after all sources, for the years noted as due; a year stays due until its
    marts are done. A source that has not landed is passed over. Returns the years refreshed per
    silver table.
    """
    sources = silver_sources(levels, flow_levels)
    for source in sources:
        create_table(spark, layout.table(source.silver), source.silver_schema, location=layout.location(source.silver))
    done: dict[str, list[int]] = {}
    for source in sources:
        flow = source.folder == "irs"

        def upward(years: list[int], source=source, flow=flow) -> None:
            refresh_gold(spark, layout, () if flow else (source.level,), (source.level,) if flow else (), years)
            # Noted before the stream commits: a run that dies before the marts are due finds it.
            for year in years:
                set_mark(spark, f"{checkpoint}/due/{source.level}", str(year))

        done[source.silver] = refresh_on_arrival(
            spark,
            layout.bronze(source.folder, source.level),
            source.schema,
            source.to_silver,
            layout.table(source.silver),
            f"{checkpoint}/{source.silver}",
            after=upward,
        )
    # Marts follow once all sources are in, and only the years that changed.
    for level in dict.fromkeys([*levels, *flow_levels]):
        due = f"{checkpoint}/due/{level}"
        changed = sorted(int(m) for m in marks(spark, due))
        have = [x for x in levels if x == level and spark.catalog.tableExists(layout.table(f"gold_{x}"))]
        feeds = [x for x in flow_levels if x == level and spark.catalog.tableExists(layout.table(f"gold_{FLOW_STEM[x]}"))]
        if changed and have:
            refresh_marts(spark, layout, have, feeds, changed)
            for year in changed:
                clear_mark(spark, due, str(year))
    return done
