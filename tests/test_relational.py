import pytest
from support import plan_of, rows
from pyspark.sql import functions as F

from placetide.operators import relational as R


@pytest.fixture(scope="module")
def shirts(spark):
    return spark.createDataFrame([("S", "red", 1), ("S", "blue", 2), ("S", "red", 4), ("M", "red", 8)], "size string, color string, quantity int")


def test_pivot_counts_and_sums(shirts):
    assert sorted(rows(R.pivot(shirts, ["size"], "color", ["red", "blue"]))) == [("M", 1, 0), ("S", 2, 1)]
    summed = R.pivot(shirts, ["size"], "color", ["red", "blue"], then_value="quantity", prefix="qty ")
    assert summed.columns == ["size", "qty red", "qty blue"]
    assert sorted(rows(summed)) == [("M", 8, 0), ("S", 5, 2)]
    top = R.pivot(shirts, ["size"], "color", ["red", "it's"], agg="max", then_value="quantity", else_value=None)
    assert top.columns == ["size", "red", "it's"] and sorted(rows(top)) == [("M", 8, None), ("S", 4, None)]
    with pytest.raises(ValueError):
        R.pivot_columns("color", ["red"], cmp="; drop")
    with pytest.raises(ValueError):
        R.pivot_columns("color", ["red"], agg="sum(")
    other = R.pivot(shirts, ["size"], "color", ["red"], cmp="!=", quote_identifiers=False, suffix="-n")
    assert other.columns == ["size", "red_n"] and sorted(rows(other)) == [("M", 0), ("S", 1)]


def test_unpivot_example(spark):
    df = spark.createDataFrame([(1, "S", "red", True, None), (2, "M", "blue", False, "x")], "id int, size string, color string, ok boolean, gone string")
    out = R.unpivot(df, exclude=["id"], remove=["GONE"], field_name="field", value_name="value")
    assert sorted(rows(out)) == sorted(
        [(1, "size", "S"), (1, "color", "red"), (1, "ok", "true"), (2, "size", "M"), (2, "color", "blue"), (2, "ok", "false")]
    )
    assert R.unpivot(df, exclude=["id"], remove=["size", "color", "ok"]).filter("value IS NULL").count() == 1
    with pytest.raises(ValueError):
        R.unpivot(df, exclude=df.columns)


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id bigint, b double")
    out = R.union_relations({"a": a, "b": b})
    assert out.columns == ["source_relation", "id", "a", "b"]
    assert sorted(rows(out)) == [("a", 1, "x", None), ("b", 2, None, 3.0)]
    assert dict(R.union_relations({"a": a, "b": b}, {"id": "string"}).dtypes)["id"] == "string"
    assert R.union_relations({"a": a, "b": b}, include=["ID"], source_column_name=None).columns == ["id"]
    assert rows(R.union_relations({"a": a, "b": b}, where="id > 1", exclude=["a", "b"])) == [("b", 2)]
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["id"], exclude=["a"])
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["nope"])


def test_relations_by_pattern(spark):
    for name in ("pat_one", "pat_two", "patxthree", "pat_skip"):
        spark.range(1).createOrReplaceTempView(name)
    assert list(R.relations_by_prefix(spark, "pat_", exclude="%skip")) == ["pat_one", "pat_two", "patxthree"]
    assert list(R.relations_by_pattern(spark, "%_two")) == ["pat_two"]


def test_two_way_except_is_null_safe_and_ignores_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, s string")
    b = spark.createDataFrame([(1, None), (3, "y"), (3, "y")], "i int, s string")
    assert sorted(rows(R.two_way_except(a, b))) == [("a_minus_b", 2, "x"), ("b_minus_a", 3, "y")]
    assert R.two_way_except(a, a).count() == 0
    assert plan_of(R.two_way_except(a, b)).count("Exchange hashpartitioning") == 1


def test_two_way_except_columns_and_precision(spark):
    a = spark.createDataFrame([(1, 1.234, "p")], "i int, v double, s string")
    b = spark.createDataFrame([(1, 1.236, "q")], "i int, v double, s string")
    assert R.two_way_except(a, b, exclude_columns=["S"], precision=2).count() == 2
    assert R.two_way_except(a, b, exclude_columns=["S"], precision=1).count() == 0
    assert R.two_way_except(a, b, compare_columns=["i"]).count() == 0
    with pytest.raises(ValueError):
        R.two_way_except(a, b.drop("s"))
    with pytest.raises(ValueError):
        R.two_way_except(a, b, ["i"], ["s"])


def test_deduplicate_keeps_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, 5, None), (1, 7, "b"), (2, 1, None), (None, 3, "n")], "k int, t int, v string")
    out = R.deduplicate(df, ["k"], [F.desc("t")])
    assert sorted(rows(out), key=str) == sorted([(1, 7, "b"), (2, 1, None), (None, 3, "n")], key=str)


def test_star_nullcheck_group_by(spark):
    df = spark.createDataFrame([("", 1, "x"), ("a", 1, "")], "s string, n int, t string")
    assert df.select(*R.star(df, ["N"], prefix="p_", suffix="_q")).columns == ["p_s_q", "p_t_q"]
    assert rows(R.nullcheck(df)) == [(None, 1, "x"), ("a", 1, None)]
    assert rows(R.nullcheck(df, ["S"])) == [(None, 1, "x"), ("a", 1, "")]
    assert rows(R.group_by_first(df.select("n", "s"), 1).count()) == [(1, 2)]
    with pytest.raises(ValueError):
        R.group_by_first(df, 4)


def test_values_and_lists(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("c",), ("b",)], "v string")
    assert rows(R.column_values(df, "v")) == [("a", 2), ("b", 2), ("c", 1)]
    assert R.column_value_list(df, "v", 2) == ["a", "b"]
    assert R.column_value_list(df, "v", 5, order_by="v desc") == ["c", "b", "a"]
    timed = df.withColumn("t", F.when(F.col("v") == "c", 0).otherwise(1))
    assert R.column_value_list(timed, "v", 5, order_by=["min(t)", "count(*) DESC"]) == ["c", "a", "b"]
    assert R.column_value_list(df, "v", 2, default=["z"], where="v > 'x'") == ["z"]
    assert R.single_value(df.filter("v = 'q'"), 7) == 7 and R.single_value(df.orderBy("v")) == "a"
    assert R.results_as_lists(df.orderBy("v"), 5) == {"v": ["a", "a", "b", "b", "c"]}
    with pytest.raises(ValueError):
        R.results_as_lists(df, 4)


def test_missing_keys_and_orphans(spark):
    want = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    have = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(R.missing_keys(want, have, ["k"])) == [(2,)]
    child = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a"), (2, "b")], "k int, g string")
    assert rows(R.orphans(child, "k", have, "k", "g = 'a'")) == [(2, "a")]
    assert R.orphans(child, "k", have, "k", to_condition="k > 5").count() == 3


def test_union_ignores_case(spark):
    a, b = spark.range(1).selectExpr("id AS Id"), spark.range(2).selectExpr("id", "'x' AS Extra")
    out = R.union_relations({"a": a, "b": b}, column_override={"ID": "string"}, source_column_name=None)
    assert out.columns == ["Id", "Extra"] and dict(out.dtypes)["Id"] == "string" and out.count() == 3


def test_precision_of_large_values_and_nan(spark):
    nan, inf = float("nan"), float("inf")
    a = spark.createDataFrame([(1e30,), (nan,), (0.14,), (-0.04,), (inf,), (None,)], "d double")
    b = spark.createDataFrame([(1e30,), (None,), (0.1,), (0.0,), (-inf,)], "d double")
    got = [(r[0], str(r[1])) for r in R.two_way_except(a, b, precision=1).collect()]
    assert sorted(got) == [("a_minus_b", "inf"), ("a_minus_b", "nan"), ("b_minus_a", "-inf")]
