"""Every rule passes on good rows, fails on a planted defect, and fails on an empty table."""

import pytest
from pyspark.sql import functions as F
from support import plan_of, rows

from placetide.operators import checks as C
from placetide.plans import quality as Q

YEAR = ("survey_year",)


def verdicts(spark, df, *rules):
    return {r.check: r for r in C.check_table(spark, "t", df, rules).collect()}


PLACES = "geography_id string, survey_year int, n bigint, flag boolean"
GOOD = [("01", 2020, 5, True), ("02", 2020, 6, False), ("01", 2021, 7, True), ("02", 2021, 8, False)]


def rule_cases():
    """(rule, rows that break it); every rule holds on GOOD."""
    ts = F.lit("2021-06-01").cast("date")
    return {
        "exact_rows": (C.rows_per_year(2, exact=True), GOOD + [("03", 2021, 1, True)]),
        "min_rows": (C.rows_per_year(2, exact=False), GOOD[:3]),
        "years_with_rows": (C.rows_in_years([2020, 2021]), GOOD[:2]),
        "year_count": (C.year_count(2), GOOD + [("01", 2022, 1, True)]),
        "not_null": (C.not_null("geography_id", "survey_year", by=YEAR), GOOD + [(None, 2020, 1, True)]),
        "not_null_other": (C.not_null("geography_id", "survey_year"), GOOD + [("01", None, 1, True)]),
        "codes": (C.codes_absent(F.col("geography_id").cast("int"), [96, 97], by=YEAR), GOOD + [("96", 2020, 1, True)]),
        "sentinel": (C.sentinel_absent(["n"], -1, by=YEAR), GOOD + [("03", 2020, -1, True)]),
        "covered": (C.fully_covered("n", by=YEAR), GOOD + [("03", 2020, None, True)]),
        "spot": (
            C.range_spot("spot", F.col("n"), F.col("geography_id") == "01", 5, 7, by=YEAR),
            GOOD + [("01", 2022, 99, True)],
        ),
        "flags": (C.both_flags("flag", by=YEAR), [r for r in GOOD if r[3]]),
        "expression": (C.expression_is_true("n > 0"), GOOD + [("03", 2020, None, True)]),
        "expression_where": (C.expression_is_true("n = 5", where="geography_id = '01' AND survey_year = 2020"), [("01", 2020, 4, True)]),
        "not_empty": (C.not_empty_string("geography_id"), GOOD + [("  ", 2020, 1, True)]),
        "not_accepted": (C.not_accepted_values("n", [42]), GOOD + [("03", 2020, 42, True)]),
        "range": (C.accepted_range("n", 5, 8), GOOD + [("03", 2020, 9, True)]),
        "range_open": (C.accepted_range("n", 4, inclusive=False), GOOD + [("03", 2020, 4, True)]),
        "range_column": (C.accepted_range("n", max_value=F.col("survey_year")), GOOD + [("03", 2020, 3000, True)]),
        "one": (C.at_least_one("n", ["geography_id"]), GOOD + [("03", 2020, None, True)]),
        "varies": (C.not_constant("n", ["geography_id"]), GOOD + [("03", 2020, 1, True)]),
        "varies_null": (C.not_constant("n", ["geography_id"]), GOOD + [("03", 2020, None, True)]),
        "share": (C.not_null_proportion("n", 0.9, group_by=["geography_id"]), GOOD + [("01", 2022, None, True)]),
        "share_top": (C.not_null_proportion("flag", 0.1, 1.0), [("01", 2020, 1, None)]),
        "unique": (C.unique_key("geography_id", "survey_year"), GOOD + GOOD[:1]),
        "recent": (
            C.expression_is_true(F.make_date("survey_year", F.lit(1), F.lit(1)) <= ts, name="recent"),
            [("01", 2022, 1, True)],
        ),
    }


CASES = (
    "exact_rows min_rows years_with_rows year_count not_null not_null_other codes sentinel covered spot flags expression "
    "expression_where not_empty not_accepted range range_open range_column one varies varies_null share share_top unique recent"
).split()


@pytest.mark.parametrize("case", CASES)
def test_rule_passes_fails_and_fails_on_empty(spark, case):
    rule, bad = rule_cases()[case]
    good = spark.createDataFrame(GOOD, PLACES)
    assert verdicts(spark, good, rule)[rule.name].passed is True
    assert verdicts(spark, spark.createDataFrame(bad, PLACES), rule)[rule.name].passed is False
    empty = verdicts(spark, good.limit(0), rule)[rule.name]
    assert empty.passed is False and empty.sample == "empty table"


def test_all_cases_are_listed(spark):
    assert set(rule_cases()) == set(CASES)


def test_spot_check_skips_null_and_zero_and_warns(spark):
    df = spark.createDataFrame([("01", 2022, 0, True), ("01", 2023, None, True), ("01", 2024, 40, True)], PLACES)
    rule = C.range_spot("spot", F.col("n"), F.col("geography_id") == "01", 35, 45)
    out = verdicts(spark, df, rule)["spot"]
    assert out.passed and out.severity == "WARN"


def test_recency(spark):
    df = spark.createDataFrame([("a", "2024-01-05 10:00:00"), ("a", "2024-01-01 00:00:00"), ("b", "2024-01-02 00:00:00"), ("c", None)], "g string, t string")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    as_of = F.lit("2024-01-06 12:00:00").cast("timestamp_ntz")
    out = verdicts(
        spark, df, C.recency("t", as_of, "2 days", name="all"), C.recency("t", as_of, "1 day", name="strict"),
        C.recency("t", as_of, "1 day", ignore_time_component=True, name="by_day"), C.recency("t", as_of, "2 days", ["g"], name="groups"),
    )
    assert (out["all"].passed, out["strict"].passed, out["by_day"].passed) == (True, False, True)
    # Group b is too old, group c holds no value at all.
    assert out["groups"].passed is False and out["groups"].observed == "2"


def test_sample_lists_first_three_keys(spark):
    df = spark.createDataFrame([(k, 2020, 1, True) for k in "dcba" for _ in range(2)], PLACES)
    out = verdicts(spark, df, C.unique_key("geography_id", "survey_year"))["no_duplicate_keys"]
    assert out.observed == "4" and out.sample == "a/2020, b/2020, c/2020"


def test_relations(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, g string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, g string")
    out = verdicts(
        spark, a, C.equal_rowcount(b, name="rows"), C.equal_rowcount(a, ["g"], name="same"), C.fewer_rows_than(b, name="fewer"),
        C.fewer_rows_than(b, ["g"], name="fewer_groups"), C.cardinality_equality("k", b, "k", name="card"),
        C.equality(b, name="equal"), C.equality(b.filter("k = 1"), name="unequal"), C.relationships("k", b, "k", name="found"),
        C.relationships("k", b, "k", to_condition="k = 1", name="lost"),
    )
    got = {k: (v.passed, v.observed) for k, v in out.items()}
    assert got == {
        "rows": (False, "1"), "same": (True, "0"), "fewer": (True, "0"), "fewer_groups": (False, "1"), "card": (False, "1"),
        "equal": (True, "0"), "unequal": (False, "2"), "found": (True, "0"), "lost": (False, "1"),
    }


def test_unreadable_table_fails_every_rule(spark, tmp_path):
    rules = {"t": [C.year_count(1), C.unique_key("k")], "gone": [C.year_count(1)], "odd": [C.not_null("nope"), C.unique_key("id")]}

    def missing():
        return spark.read.parquet(str(tmp_path / "no_such_folder"))

    out = {(r.table, r.check): r for r in C.run_checks(spark, {"t": missing, "odd": spark.range(3)}, rules).collect()}
    assert not out["t", "all_years_present"].passed and out["t", "no_duplicate_keys"].sample.startswith("unreadable")
    assert not out["gone", "all_years_present"].passed
    assert not out["odd", "no_null_keys"].passed and out["odd", "no_duplicate_keys"].passed


def test_standing_rules_count(spark):
    layers = [Q.bronze_rules(), Q.silver_rules(), Q.gold_rules()]
    assert sum(len(v) for rules in layers for v in rules.values()) == 53
    sources = Q.source_rules()
    names = [r.name for v in sources.values() for r in v]
    assert len(names) == 16 and names.count("unique_combination") == 4
    assert "unique_combination" not in [r.name for r in sources["gold_irs_county_outflows"]]


def test_aggregate_rules_share_one_scan(spark):
    df = spark.createDataFrame(GOOD, PLACES)
    rules = [C.not_null("geography_id", by=YEAR), C.fully_covered("n", by=YEAR), C.year_count(2), C.both_flags("flag", by=YEAR)]
    plan = C.planned("t", df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_a_damaged_file_fails_its_own_rules_only(spark, tmp_path):
    spark.range(10).selectExpr("id", "id AS v").write.parquet(str(tmp_path / "bad"))
    part = next((tmp_path / "bad").glob("part-*.parquet"))
    data = bytearray(part.read_bytes())
    data[4:60] = b"\xff" * 56
    part.write_bytes(bytes(data))
    for crc in (tmp_path / "bad").glob(".*.crc"):
        crc.unlink()
    tables = {"good": spark.range(10).selectExpr("id", "id AS v"), "bad": lambda: spark.read.parquet(str(tmp_path / "bad"))}
    rules = {t: [C.not_null("id"), C.unique_key("v")] for t in tables}
    got = C.run_checks(spark, tables, rules).collect()
    assert len(got) == 4
    assert all(r["passed"] for r in got if r["table"] == "good")
    broken = [r for r in got if r["table"] == "bad"]
    assert not any(r["passed"] for r in broken) and all(r["sample"].startswith("unreadable") for r in broken)


def test_a_code_that_is_no_number_does_not_end_the_check(spark):
    from placetide.plans.quality import silver_rules

    rules = silver_rules()["silver_irs_state_outflows"]
    columns = "origin_geography_id string, dest_geography_id string, households bigint, individuals bigint, survey_year int"
    df = spark.createDataFrame([("01", "XX", 1, 2, 2020), ("01", "96", 1, 2, 2020)], columns)
    got = {r["check"]: r["passed"] for r in C.check_table(spark, "t", df, rules).collect()}
    assert len(got) == len(rules) and not all(got.values())


def test_key_rule_shares_the_scan_of_its_groups(spark, tmp_path):
    spark.range(60).selectExpr("id % 20 AS k", "2000 + id % 2 AS y", "IF(id % 7 = 0, NULL, id) AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [
        C.rows_per_year(30, exact=True, year="y"), C.not_null("v", by=("y",)), C.fully_covered("v", by=("y",)),
        C.not_constant("v", ["y"]), C.at_least_one("v", ["y"]), C.unique_key("k", "y"),
    ]
    together, apart = (
        rows(C._built(C._jobs("t", df, rules, together=t)), "check") for t in (True, False)
    )
    assert together == apart and len(together) == 6
    folded = C._jobs("t", df, rules)
    assert len(folded) == 1
    assert plan_of(C._built(C._jobs("t", df, rules, sample_keys=False))).count("FileScan") == 1
    assert rows(C.check_table(spark, "t", df, rules), "check") == apart
    empty = rows(C._built(C._jobs("t", df.limit(0), rules)), "check")
    assert empty == rows(C._built(C._jobs("t", df.limit(0), rules, together=False)), "check")
    assert all(r[3] is False for r in empty)
