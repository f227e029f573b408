"""Physical plans of the main queries: pruning, early limits, reuse."""

import pytest
from support import plan_of

from placetide.workload import all_queries, standins
from placetide.workload.registry import Tables


def test_dedup_limits_before_the_shuffle(spark, data_dir):
    plan = plan_of(all_queries()["dedup_hot_key"](spark, data_dir))
    assert "Partial" in plan and plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_only_needed_columns_are_read(spark, data_dir):
    plan = plan_of(all_queries()["silver_flows_states"](spark, data_dir))
    line = next(x for x in plan.splitlines() if "l_orderkey" in x and "ReadSchema" in x)
    assert "l_tax" not in line and "l_returnflag" not in line


def test_year_filter_reaches_the_line_item_scan(spark, data_dir):
    plan = plan_of(all_queries()["flows_top"](spark, data_dir))
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "l_shipdate" in x)
    # Plans print bottom up: the filter sits right above the scan, below every join.
    assert any("Filter" in x and "l_shipdate" in x and "1998" in x for x in lines[scan - 2 : scan])
    assert "TakeOrderedAndProject" in plan


def test_two_sided_profile_is_computed_once(spark, data_dir):
    df = all_queries()["flows_states"](spark, data_dir)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_orders_are_summed_before_the_customer_join(spark, data_dir):
    plan = plan_of(all_queries()["typed_cast"](spark, data_dir))
    assert "partial_count" in plan
    assert plan.index("HashJoin" if "HashJoin" in plan else "SortMergeJoin") < plan.index("partial_count")


@pytest.mark.parametrize("name", ["coverage", "geojson_features", "metrics_list", "display_format"])
def test_tables_that_grow_are_not_gathered_on_the_driver(spark, data_dir, name):
    plan = plan_of(all_queries()[name](spark, data_dir))
    sent = [x for x in plan.splitlines() if "BroadcastHashJoin [" in x]
    # Nations alone go to all tasks; customers, outlines and survey rows are merged.
    assert not [x for x in sent if "c_custkey" in x or "geography_id" in x]
    assert plan.count("SortMergeJoin [") >= 2


def test_places_of_one_file_are_dealt_to_many_tasks(spark, data_dir, monkeypatch):
    places = Tables(spark, data_dir).customer.count()
    whole = {n: sorted(map(tuple, all_queries()[n](spark, data_dir).collect())) for n in ("bbox_rows", "centroid")}
    monkeypatch.setattr(standins, "PLACES_PER_TASK", 200)
    for name, expected in whole.items():
        df = all_queries()[name](spark, data_dir)
        plan = plan_of(df)
        assert "hashpartitioning(k#" in plan and f", {-(-places // 200)})" in plan
        # The lines after the exchange's are its input: no outline is parsed below the exchange.
        assert "from_json" in plan[: plan.index("hashpartitioning")] and "from_json" not in plan[plan.index("hashpartitioning") :]
        assert sorted(map(tuple, df.collect())) == expected
