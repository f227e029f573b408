import glob

import pytest
from support import plan_of, rows
from pyspark.sql import functions as F

from placetide.plans import serving
from placetide.schemas import FLOW_GOLD, FLOW_SILVER, STATE_FLOW_BRONZE, SURVEY_BRONZE
from placetide.sources import storage as S
from placetide.streaming import arrivals as A


def flows(spark, *specs):
    data = [(o, "02", "S", "N", n, n, n, y) for o, y, n in specs]
    return spark.createDataFrame(data, FLOW_SILVER)


def test_replay_replaces_and_empty_year_disappears(spark, tmp_path):
    assert S.create_table(spark, "t_replay", FLOW_SILVER, location=str(tmp_path / "t"))
    assert not S.create_table(spark, "t_replay", FLOW_SILVER)
    first = flows(spark, ("01", 2020, 5), ("03", 2020, 6), ("01", 2021, 7))
    assert S.backfill_years(first, "t_replay", [2020, 2021]) == {2020: 2, 2021: 1}
    again = flows(spark, ("01", 2020, 50))
    for _ in range(2):
        assert S.backfill_years(again, "t_replay", [2020]) == {2020: 1}
    spark.catalog.refreshTable("t_replay")
    assert rows(spark.table("t_replay").select("survey_year", "households"), "survey_year") == [(2020, 50), (2021, 7)]
    # Rows of years that were not asked for are not written.
    S.backfill_years(flows(spark, ("09", 2021, 1), ("09", 2020, 2)), "t_replay", [2021])
    assert rows(spark.table("t_replay").select("survey_year", "households"), "survey_year") == [(2020, 50), (2021, 1)]
    assert S.backfill_years(again, "t_replay", [2021]) == {2021: 0}
    assert rows(spark.table("t_replay").select("survey_year")) == [(2020,)]


def test_overwrite_mode_is_restored(spark, tmp_path):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    S.create_table(spark, "t_replay_mode", FLOW_SILVER, location=str(tmp_path / "t"))
    S.backfill_years(flows(spark, ("01", 2020, 5)), "t_replay_mode", [2020])
    assert spark.conf.get(key) == before


def test_year_filter_prunes_partitions_and_state_prunes_buckets(spark, tmp_path):
    df = flows(spark, *((f"{o:02d}", y, o) for o in range(1, 50) for y in (2020, 2021))).withColumn("is_non_migrant", F.lit(False))
    S.create_table(spark, "t_buckets", FLOW_GOLD, bucket_by="origin_geography_id", location=str(tmp_path / "t"))
    S.backfill_years(df, "t_buckets", [2020, 2021], bucket_by="origin_geography_id")
    picked = spark.table("t_buckets").filter("survey_year = 2020 AND origin_geography_id = '06'")
    plan = plan_of(picked)
    assert "PartitionFilters: [isnotnull(survey_year" in plan and "PushedFilters: [IsNotNull(origin_geography_id)" in plan
    assert len(picked.inputFiles()) > 0 and picked.count() == 1
    assert "32" in spark.sql("DESCRIBE EXTENDED t_buckets").filter("col_name = 'Num Buckets'").first().data_type


def test_full_refresh_drops_old_rows(spark, tmp_path):
    where = str(tmp_path / "t")
    S.full_refresh(flows(spark, ("01", 2020, 5), ("01", 2021, 6)), "t_full", location=where)
    S.full_refresh(flows(spark, ("01", 2021, 7)), "t_full", bucket_by="origin_geography_id", buckets=4, location=where)
    assert rows(spark.table("t_full").select("survey_year", "households")) == [(2021, 7)]


def test_bronze_keeps_text_codes_and_missing_columns(spark, tmp_path):
    path = str(tmp_path / "bronze")
    names = [f.name for f in SURVEY_BRONZE if f.name not in ("county", "tract")]
    df = spark.createDataFrame([tuple("1" if n not in ("state", "survey_year") else {"state": s, "survey_year": y}[n] for n in names) for s, y in (("06", 2020), ("01", 2020), ("06", 2021))],
        ", ".join(f"{n} {'bigint' if n == 'survey_year' else 'string'}" for n in names))
    S.write_bronze(df, path, "year", "state")
    assert glob.glob(f"{path}/year=2020/state=06/*.snappy.parquet")
    out = S.read_bronze(spark, path, SURVEY_BRONZE, 2020)
    assert out.schema.fieldNames() == SURVEY_BRONZE.fieldNames()
    assert rows(out.select("state", "county", "survey_year"), "state") == [("01", None, 2020), ("06", None, 2020)]
    # A second delivery of one folder leaves the others alone.
    S.write_bronze(df.filter("state = '06' AND survey_year = 2020").withColumn("NAME", F.lit("new")), path, "year", "state")
    assert rows(S.read_bronze(spark, path, SURVEY_BRONZE).select("survey_year", "state", "NAME"), "survey_year", "state") == [
        (2020, "01", "1"), (2020, "06", "new"), (2021, "06", "1"),
    ]


def test_hot_year_is_split_over_files(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 8).selectExpr("id", "uuid() AS u", "CAST(2020 AS int) AS survey_year")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        S.write_bronze(df, str(tmp_path / "hot"), "year")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/hot/year=2020/*.parquet")) > 1


def test_write_metrics(spark, tmp_path):
    report = S.write_with_metrics(flows(spark, ("01", 2020, 5), ("01", 2021, 6)), str(tmp_path / "m"), "year", state="06")
    assert report["row_count"] == 2 and report["state"] == "06" and report["duration_seconds"] >= 0
    assert spark.read.parquet(report["target"]).count() == 2


def test_shared_dir_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = S.shared_dir(spark, "x"), S.shared_dir(spark, "x")
    assert one.startswith(base) and one != two


def test_streamed_arrivals(spark, tmp_path):
    from placetide.plans.layers import flow_silver
    from placetide.streaming.arrivals import refresh_on_arrival

    path, check = str(tmp_path / "land"), str(tmp_path / "check")
    S.create_table(spark, "t_stream", FLOW_SILVER, location=str(tmp_path / "t"))

    def bronze(*specs):
        data = [("1", d, "S", "N", n, n, "9", y, "2024-01-01") for d, y, n in specs]
        return spark.createDataFrame(data, STATE_FLOW_BRONZE)

    seen = []

    def run():
        return refresh_on_arrival(spark, path, STATE_FLOW_BRONZE, lambda df: flow_silver(df, "states"), "t_stream", check, after=seen.append)

    S.write_bronze(bronze(("2", 2020, "5"), ("96", 2020, "50"), ("2", 2021, "6")), path, "year")
    assert run() == [2020, 2021]
    assert run() == []  # nothing new
    S.write_bronze(bronze(("2", 2021, "60"), ("3", 2021, "-1")), path, "year")
    assert run() == [2021]
    assert rows(spark.table("t_stream").select("survey_year", "households"), "survey_year") == [(2020, 5), (2021, 60)]
    # A second file beside the first extends the year; it is rebuilt whole, not replaced by half.
    bronze(("4", 2021, "7")).write.mode("append").parquet(f"{path}/year=2021")
    assert run() == [2021]
    assert rows(spark.table("t_stream").select("survey_year", "households"), "survey_year", "households") == [(2020, 5), (2021, 7), (2021, 60)]
    assert seen == [[2020, 2021], [2021], [2021]]


def test_due_partitions(spark):
    from placetide.streaming import arrivals as A

    years = A.expected_years(spark, "2015-12-01")
    assert rows(years, "survey_year") == [(2012,), (2013,), (2014,)]
    assert A.expected_years(spark, "2030-01-01", "flows").count() == 12
    wanted = A.expected_partitions(years)
    assert wanted.count() == 3 * 51
    have = wanted.filter("NOT (survey_year = 2013 AND state = '06')")
    assert rows(A.due_partitions(wanted, have, ["survey_year", "state"])) == [(2013, "06")]


@pytest.mark.parametrize("bad", ["", None])
def test_no_machine_local_folder_off_local_master(spark, bad, monkeypatch):
    class Context:
        master = "spark://cluster:1"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return bad

    with pytest.raises(RuntimeError):
        S.shared_dir(Session())


def test_arrivals_cascade_to_marts(spark, tmp_path):
    from placetide.plans.refresh import Layout
    from placetide.schemas import BOUNDARY_BRONZE
    from placetide.streaming.arrivals import cascade_on_arrival

    layout = Layout(str(tmp_path), prefix="cas_")

    def survey(year, *states):
        names = SURVEY_BRONZE.fieldNames()
        special = {"survey_year": year, "county": None, "tract": None}
        data = [tuple(special[n] if n in special else s if n == "state" else "10" for n in names) for s in states]
        return spark.createDataFrame(data, SURVEY_BRONZE)

    def shapes(year, *states):
        names = BOUNDARY_BRONZE.fieldNames()
        special = {"survey_year": year, "ALAND": 1, "AWATER": 2, "geometry_wkt": "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"}
        return spark.createDataFrame([tuple(special.get(n, s) for n in names) for s in states], BOUNDARY_BRONZE)

    def moves(year, *pairs):
        return spark.createDataFrame([(o, d, "S", "N", "5", "9", "100", year, "x") for o, d in pairs], STATE_FLOW_BRONZE)

    def land(year, states, pairs):
        S.write_bronze(survey(year, *states), layout.bronze("census_acs5", "states"), "year")
        S.write_bronze(shapes(year, *states), layout.bronze("tiger", "states"), "year")
        S.write_bronze(moves(year, *pairs), layout.bronze("irs", "states"), "year")

    def run():
        return cascade_on_arrival(spark, layout, str(tmp_path / "check"), ("states",), ("states",))

    # Nothing has landed; then the sources land one by one.
    assert set(map(tuple, run().values())) == {()}
    S.write_bronze(moves(2020, ("1", "6")), layout.bronze("irs", "states"), "year")
    assert run()["silver_irs_state_outflows"] == [2020]
    assert not spark.catalog.tableExists("cas_mart_migration_flows_states")
    S.write_bronze(survey(2020, "01", "06"), layout.bronze("census_acs5", "states"), "year")
    S.write_bronze(shapes(2020, "01", "06"), layout.bronze("tiger", "states"), "year")
    run()
    land(2020, ["01", "06"], [("1", "6"), ("6", "6"), ("1", "96")])
    assert set(map(tuple, run().values())) == {(2020,)}
    land(2021, ["01"], [("1", "6")])
    assert set(map(tuple, run().values())) == {(2021,)}
    assert set(map(tuple, run().values())) == {()}
    got = rows(spark.table("cas_mart_migration_flows_states").select("survey_year", "origin_lat", "dest_lat", "agi_per_household"), "survey_year")
    assert got == [(2020, 1.0, 1.0, 20.0), (2021, 1.0, None, 20.0)]
    assert spark.table("cas_gold_states").count() == 3
    # No year is left due, and one marked by a run that died is made up for.
    assert S.marks(spark, f"{tmp_path}/check/due/states") == []
    S.set_mark(spark, f"{tmp_path}/check/due/states", "2020")
    spark.sql("ALTER TABLE cas_mart_migration_flows_states DROP PARTITION (survey_year=2020)")
    run()
    assert S.table_years(spark, "cas_mart_migration_flows_states") == [2020, 2021]


def test_years_that_have_not_landed_are_reported_and_left(spark, tmp_path):
    from placetide.plans.refresh import Layout, refresh_silver, silver_sources

    layout = Layout(str(tmp_path), prefix="late_")
    flows = spark.createDataFrame([("1", "6", "S", "N", "5", "9", "100", y, "x") for y in (2021, 2022)], STATE_FLOW_BRONZE)
    S.write_bronze(flows, layout.bronze("irs", "states"), "year")
    sources = silver_sources((), ("states",))
    assert refresh_silver(spark, layout, sources, [2021, 2022]) == {"silver_irs_state_outflows": {2021: 1, 2022: 1}}
    assert refresh_silver(spark, layout, sources, [2022, 2023]) == {"silver_irs_state_outflows": {2022: 1, 2023: None}}
    assert S.table_years(spark, "late_silver_irs_state_outflows") == [2021, 2022]
    missing = refresh_silver(spark, Layout(str(tmp_path / "none"), prefix="none_"), sources, [2022])
    assert missing == {"silver_irs_state_outflows": {2022: None}}


def test_a_row_without_a_year_does_not_land(spark, tmp_path):
    from pyspark.errors import PySparkException

    flows = spark.createDataFrame([("1", "6", "S", "N", "5", "9", "100", None, "x")], STATE_FLOW_BRONZE)
    with pytest.raises(PySparkException, match="without a year"):
        S.write_bronze(flows, str(tmp_path / "land"), "year")


def test_stray_files_are_reported_not_fatal(spark, tmp_path):
    from placetide.plans.layers import flow_silver
    from placetide.streaming.arrivals import refresh_on_arrival

    path = str(tmp_path / "land")
    S.create_table(spark, "t_stray", FLOW_SILVER, location=str(tmp_path / "t"))
    flows = spark.createDataFrame([("1", "6", "S", "N", "5", "9", "100", 2020, "x")], STATE_FLOW_BRONZE)
    flows.write.parquet(f"{path}/year=__HIVE_DEFAULT_PARTITION__")
    S.write_bronze(flows, path, "year")

    def run():
        return refresh_on_arrival(spark, path, STATE_FLOW_BRONZE, lambda df: flow_silver(df, "states"), "t_stray", str(tmp_path / "c"))

    with pytest.warns(UserWarning, match="outside a year folder"):
        assert run() == [2020]
    assert run() == [] and spark.table("t_stray").count() == 1


def test_scratch_folders_go(spark):
    df = S.stored(spark.range(5), "test")
    path = S._scratch[-1][1]
    assert df.count() == 5 and S.has_landed(spark, path)
    folder, files = S._folder(spark, path)
    files.delete(folder, True)
    assert not S.has_landed(spark, path)


def _years_table(spark, tmp_path, name):
    S.create_table(spark, name, FLOW_SILVER, location=str(tmp_path / name))
    rows_ = spark.range(12).selectExpr(*[
        f"CAST({'2010 + id % 4' if f.name == 'survey_year' else 'id'} AS {f.dataType.simpleString()}) AS {f.name}" for f in FLOW_SILVER
    ])
    S.backfill_years(rows_, name, range(2010, 2014))
    return rows_


def test_replay_does_not_depend_on_the_session_s_mode(spark, tmp_path):
    import threading

    rows_ = _years_table(spark, tmp_path, "t_replay_other_writer")
    stop = threading.Event()

    def other_writer():
        # Another write of the same session that wants whole tables replaced.
        while not stop.is_set():
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")

    thread = threading.Thread(target=other_writer)
    thread.start()
    try:
        for year in (2010, 2012, 2010):
            assert S.backfill_years(rows_, "t_replay_other_writer", [year]) == {year: 3}
    finally:
        stop.set()
        thread.join()
    assert rows(spark.table("t_replay_other_writer").groupBy("survey_year").count(), "survey_year") == [(y, 3) for y in range(2010, 2014)]


def test_replay_of_a_table_made_elsewhere(spark, tmp_path):
    rows_ = _years_table(spark, tmp_path, "t_source")
    rows_.write.partitionBy("survey_year").option("path", str(tmp_path / "own")).saveAsTable("t_own")
    assert S.backfill_years(rows_, "t_own", [2011, 2013]) == {2011: 3, 2013: 3}
    assert S.table_years(spark, "t_own") == [2010, 2011, 2012, 2013]
    assert spark.table("t_own").count() == 12


def test_full_refresh_of_a_table_from_itself(spark, tmp_path):
    _years_table(spark, tmp_path, "t_self")
    S.full_refresh(spark.table("t_self").filter("survey_year > 2010"), "t_self", location=str(tmp_path / "t_self"))
    assert S.table_years(spark, "t_self") == [2011, 2012, 2013] and spark.table("t_self").count() == 9


def test_keys_come_from_the_partition_list(spark, tmp_path):
    odd = ["06", "a/b=c", "x+y %z", None, "é"]
    df = spark.createDataFrame([(2020 + k % 2, v, k) for k, v in enumerate(odd)], "survey_year int, state string, n int")
    df.write.partitionBy("survey_year", "state").option("path", str(tmp_path / "odd")).saveAsTable("t_listed")
    both = S.partition_keys(spark, "t_listed", ["survey_year", "state"])
    assert sorted(map(repr, map(tuple, both.collect()))) == sorted(repr((2020 + k % 2, v)) for k, v in enumerate(odd))
    assert dict(both.dtypes) == {"survey_year": "int", "state": "string"}
    years = serving.years_held(spark, "t_listed")
    assert rows(years) == [(2020,), (2021,)]
    wanted = spark.createDataFrame([(2020,), (2022,)], "survey_year int")
    due = A.due_in_table(spark, wanted, "t_listed")
    assert rows(due) == [(2022,)]
    assert not any("FileScan" in plan_of(d) for d in (both, years, due))


def test_keys_of_other_tables_come_from_their_rows(spark, tmp_path):
    df = spark.createDataFrame([(2020, 1), (2020, 2), (2019, 3)], "survey_year int, n int")
    df.write.option("path", str(tmp_path / "flat")).saveAsTable("t_flat")
    held = serving.years_held(spark, "t_flat")
    assert rows(held) == [(2019,), (2020,)] and "FileScan" in plan_of(held)
