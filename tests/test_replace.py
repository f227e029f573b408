"""Replay of a year while others read it."""

import glob
import threading

from support import plan_of, rows
from pyspark.sql import functions as F

from placetide.schemas import FLOW_GOLD, FLOW_SILVER
from placetide.sources import storage as S


def flows(spark, n, years=(2020, 2021), households=1):
    return spark.range(n * len(years)).selectExpr(
        "CAST(id % 50 AS string) AS origin_geography_id",
        "CAST(id AS string) AS dest_geography_id",
        "'S' AS dest_state",
        "'N' AS dest_name",
        f"CAST({households} AS bigint) AS households",
        "id AS individuals",
        "id AS agi",
        f"CAST({years[0]} + id % {len(years)} AS int) AS survey_year",
    ).select(*[F.col(f.name).cast(f.dataType) for f in FLOW_SILVER])


def test_reader_never_sees_less_than_one_version(spark, tmp_path):
    S.create_table(spark, "t_switch", FLOW_SILVER, location=str(tmp_path / "t"))
    S.backfill_years(flows(spark, 500), "t_switch", [2020, 2021])
    stop, seen, failed = threading.Event(), [], []

    def reader():
        while not stop.is_set():
            try:
                found = spark.table("t_switch").filter("survey_year = 2020").agg(F.count("*"), F.min("households"), F.max("households")).first()
                seen.append(tuple(found))
            except Exception as error:  # noqa: BLE001  reported by the test
                failed.append(error)

    threads = [threading.Thread(target=reader) for _ in range(3)]
    for t in threads:
        t.start()
    try:
        for k in range(2, 10):
            assert S.backfill_years(flows(spark, 500, households=k), "t_switch", [2020]) == {2020: 500}
    finally:
        stop.set()
        for t in threads:
            t.join()
    assert not failed and len(seen) > 8
    assert {n for n, _, _ in seen} == {500}
    assert all(low == high for _, low, high in seen)
    assert rows(spark.table("t_switch").groupBy("survey_year").agg(F.max("households")), "survey_year") == [(2020, 9), (2021, 1)]


def test_write_that_fails_changes_nothing(spark, tmp_path):
    S.create_table(spark, "t_fails", FLOW_SILVER, location=str(tmp_path / "t"))
    S.backfill_years(flows(spark, 20), "t_fails", [2020, 2021])
    broken = flows(spark, 20, households=7).withColumn("agi", F.when(F.col("agi") > 30, F.raise_error(F.lit("late"))).otherwise(F.col("agi")))
    try:
        S.backfill_years(broken, "t_fails", [2020, 2021])
        raise AssertionError("the write should fail")
    except Exception as error:  # noqa: BLE001
        assert "late" in str(error)
    assert spark.table("t_fails").count() == 40 and spark.table("t_fails").agg(F.max("households")).first()[0] == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("t_fails_v")]


def test_replaced_files_go_after_their_time(spark, tmp_path):
    S.create_table(spark, "t_sweep", FLOW_SILVER, location=str(tmp_path / "t"))
    for k in (1, 2, 3):
        S.backfill_years(flows(spark, 20, households=k), "t_sweep", [2020, 2021])
    found = lambda: len(glob.glob(f"{tmp_path}/t/_versions/*/survey_year=2020"))
    assert found() == 3 and S.sweep_replaced(spark, "t_sweep") == []
    assert len(S.sweep_replaced(spark, "t_sweep", keep_seconds=0)) == 4
    assert found() == 1 and spark.table("t_sweep").count() == 40
    assert S.backfill_years(flows(spark, 20, households=4), "t_sweep", [2020], keep_seconds=0) == {2020: 20}
    assert found() == 1


def test_further_partition_columns_are_replaced_whole(spark, tmp_path):
    """Partitions of the year that the new rows lack go as well; odd names keep their meaning."""
    S.create_table(spark, "t_nested", FLOW_SILVER, ("survey_year", "dest_name"), location=str(tmp_path / "t"))
    named = lambda name, years: flows(spark, 6, years).withColumn("dest_name", name)
    odd = F.when(F.col("individuals") % 3 == 0, "a/b=c'd").when(F.col("individuals") % 3 == 1, "x+y %z")
    S.backfill_years(named(odd, (2020, 2021)), "t_nested", [2020, 2021])
    table = lambda: rows(spark.table("t_nested").groupBy("survey_year", "dest_name").count().na.fill("none"), "survey_year", "dest_name")
    both = [(y, n, 2) for y in (2020, 2021) for n in ("a/b=c'd", "none", "x+y %z")]
    assert table() == both
    S.backfill_years(named(F.when(F.col("individuals") % 2 == 0, "a/b=c'd").otherwise("new"), (2021,)), "t_nested", [2021])
    assert table() == both[:3] + [(2021, "a/b=c'd", 3), (2021, "new", 3)]


def test_buckets_survive_a_replay(spark, tmp_path):
    S.create_table(spark, "t_rebucket", FLOW_GOLD, bucket_by="origin_geography_id", buckets=4, location=str(tmp_path / "t"))
    for k in (1, 2):
        S.backfill_years(flows(spark, 200, households=k).withColumn("is_non_migrant", F.lit(False)), "t_rebucket", [2020, 2021], bucket_by="origin_geography_id")
    grouped = spark.table("t_rebucket").groupBy("origin_geography_id").agg(F.sum("households").alias("n"))
    assert "Exchange" not in plan_of(grouped)
    assert grouped.agg(F.sum("n")).first()[0] == 800
