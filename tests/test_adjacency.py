"""Neighbour checks against brute force in plain Python."""

from collections import defaultdict
from itertools import groupby

import pytest
from support import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placetide.operators import adjacency as A

RANGES = "g int, lo int, hi int"


def brute_ranges(data, keep, zero):
    groups = defaultdict(list)
    for g, lo, hi in data:
        groups[g].append((lo, hi))
    bad = 0
    for ranges in groups.values():
        ranges.sort()
        for i, (lo, hi) in enumerate(ranges):
            shape = lo <= hi if zero else lo < hi
            follows = i + 1 == len(ranges) or keep(hi, ranges[i + 1][0])
            bad += not (shape and follows)
    return bad


KEEP = {"not_allowed": lambda a, b: a == b, "allowed": lambda a, b: a <= b, "required": lambda a, b: a < b}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 2), st.integers(-5, 20), st.integers(-5, 20)), min_size=1, max_size=40),
    st.sampled_from(sorted(KEEP)),
    st.booleans(),
    st.sampled_from([1, 3, 40]),
)
def test_ranges_match_brute_force(spark, data, gaps, zero, stretches):
    df = spark.createDataFrame(data, RANGES)
    found = A.exclusive_range_violations(df, "lo", "hi", ["g"], gaps, zero)
    assert sum(r.violations for r in found.collect()) == brute_ranges(data, KEEP[gaps], zero)
    # The neighbours do not depend on how many stretches the rows are dealt into.
    whole = sorted(rows(A.with_next(df, ["g"], ["lo", "hi"])), key=str)
    assert sorted(rows(A.with_next(df, ["g"], ["lo", "hi"], stretches)), key=str) == whole


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12)), min_size=1, max_size=30), st.sampled_from([1, 2]))
def test_sequences_match_brute_force(spark, data, interval):
    df = spark.createDataFrame(data, "g int, v int")
    want = 0
    for _, group in groupby(sorted(data), key=lambda r: r[0]):
        values = [v for _, v in group]
        want += sum(b != a + interval for a, b in zip(values, values[1:]))
    assert sum(r.violations for r in A.sequence_violations(df, "v", interval, group_by=["g"]).collect()) == want
    flat = sorted(v for _, v in data)
    want = sum(b != a + interval for a, b in zip(flat, flat[1:]))
    assert sum(r.violations for r in A.sequence_violations(df, "v", interval).collect()) == want


GAP_EXAMPLES = {
    "not_allowed": [(0, 1), (1, 2), (2, 3)],
    "allowed": [(0, 1), (2, 3), (3, 4)],
    "required": [(0, 1), (2, 3), (4, 5)],
}
# Which example passes under which rule.
PASSES = {
    "not_allowed": {"not_allowed"},
    "allowed": {"not_allowed", "allowed", "required"},
    "required": {"required"},
}


@pytest.mark.parametrize("rule", sorted(PASSES))
def test_gap_examples(spark, rule):
    for name, data in GAP_EXAMPLES.items():
        df = spark.createDataFrame(data, "lo int, hi int")
        ok = A.exclusive_range_violations(df, "lo", "hi", gaps=rule).count() == 0
        assert ok == (name in PASSES[rule])
    with pytest.raises(ValueError):
        A.exclusive_range_violations(df, "lo", "hi", gaps="maybe")


def test_zero_length_examples(spark):
    df = spark.createDataFrame([(0, 1), (2, 2), (3, 4)], "lo int, hi int")
    assert rows(A.exclusive_range_violations(df, "lo", "hi")) == [(2, 2, 1, 1)]
    assert A.exclusive_range_violations(df, "lo", "hi", zero_length_range_allowed=True).count() == 0


def test_null_bound_is_a_violation(spark):
    df = spark.createDataFrame([(0, 1), (None, 2), (3, None)], "lo int, hi int")
    assert A.exclusive_range_violations(df, "lo", "hi").count() == 2


def test_hourly_sequence(spark):
    hours = ["2024-03-10 01:00:00", "2024-03-10 02:00:00", "2024-03-10 03:00:00", "2024-03-10 05:00:00"]
    df = spark.createDataFrame([(h,) for h in hours], "t string").selectExpr("CAST(t AS timestamp_ntz) AS t")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            bad = A.sequence_violations(df, "t", 1, "hour").collect()
            assert [(r.t.hour, r.violations) for r in bad] == [(3, 1)]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def _stretch_sizes(spark, df, group_by, order, stretches):
    """Rows of each stretch, found from the stored pairs."""
    from placetide.sources import storage

    A.with_next(df, group_by, order, stretches)
    pairs = spark.read.parquet(storage._scratch[-1][1])
    return [r["count"] for r in pairs.groupBy("_stretch").count().collect()]


@pytest.mark.parametrize(
    "sql",
    [
        # 1,500 groups of the same size; a narrow hot group beside a wide one; one equal first value.
        "id % 1500 AS g, id AS lo, id AS hi",
        "IF(id < 20000, 1, 2) AS g, IF(id < 20000, id, id * 1000000000) AS lo, id AS hi",
        "1 AS g, 7 AS lo, id AS hi",
        "IF(id % 3 = 0, NULL, 1) AS g, NULL AS lo, id AS hi",
        "1 AS g, IF(id = 0, 1000000000000, id) AS lo, 0 AS hi",
    ],
)
def test_no_stretch_is_much_longer_than_the_others(spark, sql):
    df = spark.range(30000).selectExpr(*_terms(sql))
    sizes = _stretch_sizes(spark, df, ["g"], ["lo", "hi"], 16)
    assert sum(sizes) == 30000 and max(sizes) < 3 * 30000 / 16


def _terms(sql):
    """Terms of a select list; commas inside brackets do not part them."""
    out, depth = [""], 0
    for ch in sql:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return out


def test_groups_end_where_they_end(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, NULL, 1) AS g", "id AS v")
    found = A.with_next(df, ["g"], ["v"], 7)
    assert found.count() == 1000 and found.filter("next IS NULL").count() == 2
    assert A.sequence_violations(df.filter("g = 1"), "v").count() == 332


def test_source_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)
    # Each input partition adds one when it is read.
    rdd = spark.sparkContext.parallelize([(k % 5, k) for k in range(2000)], 4)

    def counted(part):
        seen.add(1)
        yield from part

    df = spark.createDataFrame(rdd.mapPartitions(counted), "g int, v int")
    assert A.sequence_violations(df, "v", 5, group_by=["g"]).count() == 0
    assert seen.value == 4


def test_copies_are_counted_before_the_shuffle(spark, data_dir):
    orders = spark.read.parquet(f"{data_dir}/orders.parquet")
    plan = plan_of(orders.groupBy("o_orderdate").count())
    assert "partial_count" in plan
    final = plan_of(A.with_next(orders, [], ["o_orderdate"]))
    assert "CartesianProduct" not in final and "Join" not in final


def test_empty_table(spark):
    df = spark.range(0).selectExpr("id AS g", "id AS v")
    assert A.with_next(df, ["g"], ["v"]).count() == 0
