"""Every named query against its SQL twin on the same parquet tables, and its plan."""

import math

import pytest
from support import plan_of

from placetide.workload import all_queries, all_sql
from placetide.workload.registry import SCHEMAS

duckdb = pytest.importorskip("duckdb")

# Spark type -> the SQL engine's name of the same type.
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}
NAMES = sorted(all_queries())
# No query may plan a cross join or leave the JVM.
UNWANTED = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow", "MapPartitions",
)


@pytest.fixture(scope="module")
def engine(data_dir):
    con = duckdb.connect()
    for table in SCHEMAS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data_dir}/{table}.parquet'")
    return con


def _cell(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def test_every_query_has_sql():
    assert set(all_sql()) == set(all_queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(name, spark, data_dir, engine):
    df = all_queries()[name](spark, data_dir)
    plan = plan_of(df)
    assert not [bad for bad in UNWANTED if bad in plan]
    columns = sorted(df.columns)
    result = engine.execute(all_sql()[name])
    other = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert sorted(other) == columns
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds
    got = sorted(tuple(_cell(r[c]) for c in columns) for r in df.collect())
    want = sorted(tuple(_cell(r[other.index(c)]) for c in columns) for r in result.fetchall())
    assert len(got) > 0
    assert got == want


def test_entry_runs(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert "households" in df.columns
    df.collect()
