"""The package's queries against their SQL, and what every one of them keeps to."""

import duckdb
import pytest

from placetide.llm import queries
from placetide.workload.registry import SCHEMAS

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(name, spark, data_dir):
    con = duckdb.connect()
    for table in SCHEMAS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data_dir}/{table}.parquet'")
    df = queries.QUERIES[name](spark, data_dir)
    result = con.execute(queries.SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert {d[0]: str(d[1]) for d in result.description} == {f.name: TYPES[f.dataType.simpleString()] for f in df.schema}
    want = sorted(result.fetchall(), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got == want and got
