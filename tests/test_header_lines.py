"""Survey responses read line by line."""

import json

import pytest
from support import rows

from placetide.sources import landing as L

NAMES = ["NAME", "B1", "state", "missing"]


def write(path, *documents, joint=",\n"):
    path.mkdir()
    for k, doc in enumerate(documents):
        text = doc if isinstance(doc, str) else "[" + joint.join(json.dumps(r) for r in doc) + "]"
        (path / f"{k}.json").write_text(text, encoding="utf-8")
    return str(path)


def both(spark, path):
    bag = lambda df: sorted(map(repr, rows(df)))
    lines, whole = (read(spark, path, NAMES) for read in (L.read_header_lines, L.read_header_json))
    assert lines.columns == whole.columns and bag(lines) == bag(whole)
    return rows(lines)


def test_lines_equal_whole_documents(spark, tmp_path):
    first = [["NAME", "B1", "state"], ["a]]", "1", "06"], ["é, \"[[\"", None, "01"], ["short"], ["x\ny", "2", "03", "long"]]
    turned = [["state", "NAME"], ["06", "b"], ["", ""]]
    assert len(both(spark, write(tmp_path / "a", first, turned, [["NAME"]], first))) == 10
    # A document on one line, with spaces, with carriage returns, and with blank lines at the end.
    assert len(both(spark, write(tmp_path / "b", first, joint=","))) == 4
    assert len(both(spark, write(tmp_path / "c", '[ ["NAME","B1"],\r\n  ["a","1"] ,\r\n["b","2"],["c","3"] ]\r\n\r\n'))) == 3
    assert both(spark, write(tmp_path / "d", [["NAME"]])) == []


def test_large_document_is_shared_among_tasks(spark, tmp_path):
    big = [["NAME", "B1", "state"], *([f"place {k} " + "x" * 60, str(k), f"{k % 50:02d}"] for k in range(60_000))]
    path = write(tmp_path / "big", big, [["B1", "NAME"], ["7", "small"]])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1MB")
    try:
        df = L.read_header_lines(spark, path, NAMES)
        assert df.rdd.getNumPartitions() >= 5
        got = df.selectExpr("count(*)", "sum(cast(B1 AS bigint))", "count(state)", "count(missing)").first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(got) == (60_001, 60_000 * 59_999 // 2 + 7, 60_000, 0)


@pytest.mark.parametrize(
    "text, words",
    [
        ('[["NAME"],\n["a"],\n{"error": 1}]', "no rows of a response"),
        ('["NAME"],\n["a"]]', "no header"),
        ('[["NAME"],\n["a"]]\n[["NAME"],\n["b"]]', "more than one header"),
    ],
)
def test_what_is_no_response_raises(spark, tmp_path, text, words):
    path = write(tmp_path / "bad", text)
    with pytest.raises(Exception, match=words):
        L.read_header_lines(spark, path, NAMES).collect()


def test_survey_bronze_by_lines(spark, tmp_path):
    path = write(tmp_path / "s", [["NAME", "B01001_001E", "state"], ["A", "5", "1"], ["B", "6", "2"]])
    one, two = (L.survey_bronze(spark, path, ["B01001_001E"], 2020, "2024-01-01", by_lines=x) for x in (True, False))
    assert one.schema == two.schema and sorted(map(repr, rows(one))) == sorted(map(repr, rows(two)))
