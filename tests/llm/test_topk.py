import numpy as np
import pytest
from pyspark.sql import functions as F

from placetide.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    """Every pair of usable rows; components beyond the shorter vector count as 0."""
    ok = {}
    for key, v, _ in rows:
        if key is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ok.setdefault((key, tuple(np.float32(v).tolist())), [int(np.floor(64 * float(np.float32(x)))) for x in v])
    out = []
    for (key, _), q in ok.items():
        if key % every == 0:
            scored = [(-sum(a * b for a, b in zip(q, p, strict=False)), other) for (other, _), p in ok.items() if other != key]
            out += [(key, r + 1, o, -s) for r, (s, o) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def run(spark, rows, every=4, k=5, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, F.col("key") % every == 0, k, **options)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("options", [{}, {"row_block": 37, "query_block": 5}])
def test_against_brute_force(spark, options):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(0, 0.2, 8).tolist(), 0) for k in range(150)]
    rows += [(k, rows[0][1], 0) for k in range(200, 280)]  # a large group of equal vectors
    rows += [(k, [0.0] * 8, 0) for k in range(300, 310)]
    assert run(spark, rows, **options) == brute(rows, 4, 5)


@pytest.mark.parametrize("shared", [1, 3])
def test_tiles_of_several_slices(spark, monkeypatch, shared):
    monkeypatch.setattr(topk, "SLICE_BLOCKS", shared)
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(0, 0.2, 5).tolist(), 0) for k in range(400)]
    assert run(spark, rows, every=2, row_block=64, query_block=7) == brute(rows, 2, 5)


def test_blocks_of_rows_are_copied_once_a_slice(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(k, rng.normal(0, 0.2, 4).tolist(), 0) for k in range(600)], SCHEMA)
    plan = topk.top_k(df, F.col("key") % 4 == 0, 5, row_block=64, query_block=5)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_odd_vectors_take_no_part(spark):
    rows = [
        (0, [0.5, -0.5], 1), (4, None, 1), (8, [], 1), (12, [float("nan"), 1.0], 1), (16, [float("inf"), 1.0], 1),
        (20, [None, 1.0], 1), (None, [1.0, 1.0], 1), (1, [1.0, 1.0], None), (2, [-1.0, 1.0], 1), (3, [3.0], 1),
        (5, [0.25, 0.25, 9.0], 1), (1, [1.0, 1.0], None),
    ]
    got = run(spark, rows)
    assert got == brute(rows, 4, 5)
    assert {r[0] for r in got} == {0} and len(got) == 4


def test_large_and_constant_values(spark):
    rows = [(k, [1e6 * ((k * 7) % 5 - 2), 3.0, -1e5 * k], 0) for k in range(40)]
    assert run(spark, rows) == brute(rows, 4, 5)


def test_empty_table_and_no_query(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 0), (2, [2.0], 0)]) == []
    assert run(spark, [(4, [1.0], 0)]) == []


def test_extra_columns_with_the_same_names(spark):
    df = spark.createDataFrame([(0, [1.0], 5), (1, [2.0], 6)], SCHEMA).withColumnRenamed("label", "q")
    got = topk.top_k(df, F.col("key") % 4 == 0, 5).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 64 * 128)]
