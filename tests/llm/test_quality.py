import random
import time
from collections import Counter

import pytest
from helpers import docs, plan, split_words, words
from pyspark.sql import functions as F

from placetide.llm import quality, queries

LABELS = "doc_id long, quality int, toxic int"


def counts(text):
    """The base counts, word by word."""
    found = split_words(text)
    grams = [tuple(found[k : k + 5]) for k in range(len(found) - 4)]
    often = Counter(grams)
    covered = {p + j for p, g in enumerate(grams) if often[g] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if split_words(x)]
    return (
        len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
    )


def failed(n_words, n_repeat):
    return n_words < 10 or 100 * n_repeat > 20 * n_words


def test_query_on_the_test_table(spark, data_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_quality_rules"](spark, data_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == failed(want[0], want[4])
        assert not (r["base_failed"] and r["kept"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{data_dir}/labels.parquet").collect()}
    good = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(good) > 0.99 * len(good) and sum(bad) < 0.1 * len(bad)


ODD = [
    None, "", " \n\t ", "one", "é à\x0bü\x0c#|x\r\n", "a b c d e " * 4, "a a a a a a a a", "x\n\nx\n \nx \ny\ny", "no\xa0break space here",
    "1 2 3 4 5 6 7 1 2 3 4 5 9 9", "$$$ ### *** %%% <tag> a|b & c", "A B C\n" * 30, "w " * 3000 + "end",
]


def test_counts_of_odd_texts(spark):
    rng = random.Random(1)
    texts = ODD + [words(rng, rng.randrange(60), 4) for _ in range(60)] + [words(rng, 9000, 100_000)]
    got = quality.statistics(docs(spark, list(enumerate(texts)))).collect()
    for r in got:
        s = r["stats"]
        assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == counts(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert s["n_distinct"] == len(set(split_words(texts[r["doc_id"]])))


def labelled(spark, bad_text, n=300):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        rows.append((k, bad_text(rng) if bad else words(rng, 60, 10_000)))
        labels.append((k, 0 if bad else 1, 0))
    return docs(spark, rows), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize(
    "bad_text",
    [
        lambda rng: words(rng, 60, 10_000).upper() + "!",
        lambda rng: " ".join(w + "$" for w in words(rng, 60, 10_000).split()),
        lambda rng: words(rng, 60, 10_000).replace(" ", " | "),
        lambda rng: words(rng, 60, 10_000) + " 1234567890" * 8 if rng.random() < 0.5 else words(rng, 60, 10_000).upper(),
    ],
)
def test_rules_find_what_is_bad_and_keep_the_rest(spark, bad_text):
    table, labels = labelled(spark, bad_text)
    rules = quality.fit(table, labels)
    assert rules and all(r.precision >= quality.MIN_PRECISION for r in rules)
    judged = quality.judge(table, rules).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    shares = {r[0]: r[1] for r in judged}
    assert shares[1] > 0.98 and shares[0] < 0.05
    kept = quality.keep_good(table, labels)
    assert kept.columns == table.columns
    assert kept.count() == quality.judge(table, rules).filter("kept").count()


def test_rules_run_in_order_as_conditions(spark):
    stats = quality.statistics(docs(spark, [(1, "plain words " * 3 + "and some more of them here ok"), (2, "A# B# C# D# E# F# G# H# I# J# K#")]))
    rules = [
        quality.Rule((quality.Condition("symbol_share", True, 0.9),), 1, 1.0),
        quality.Rule((quality.Condition("symbol_share", True, 0.1), quality.Condition("words", False, 50.0)), 1, 1.0),
    ]
    got = {r[0]: r[1] for r in stats.select("doc_id", quality.verdict(rules, F.col("stats"))).collect()}
    assert got == {1: None, 2: 2}
    assert str(rules[1]) == "symbol_share > 0.1 AND words <= 50"


def test_no_labels_or_one_class_give_no_rules(spark):
    table, labels = labelled(spark, lambda rng: words(rng, 60, 10_000).upper(), 40)
    assert quality.fit(table, labels.filter("false")) == []
    assert quality.fit(table, labels.filter("quality = 1")) == []
    nulls = spark.createDataFrame([(None, 0, 0), (1, None, 0), (1, 1, 0), (1, 0, 0)], LABELS)
    assert quality.fit(table, nulls) == []
    assert quality.labelled_sample(table, nulls).select("bad").collect()[0][0] is True


def test_sample_is_bounded_and_the_same_each_time(spark):
    table, labels = labelled(spark, lambda rng: words(rng, 60).upper(), 80)
    one, two = (sorted(r["doc_id"] for r in quality.labelled_sample(table.repartition(n), labels.repartition(n), 25).collect()) for n in (1, 5))
    assert one == two and len(one) == 25


def test_null_ids_repeats_empty_tables_and_clashing_names(spark):
    df = docs(spark, [(None, "a b", "x", "y", 1), (1, "c " * 40, "x", "y", 1), (1, "c " * 40, "x", "y", 1)])
    df = df.withColumnRenamed("lang", "stats").withColumnRenamed("source", "kept")
    out = quality.judge(df, [])
    assert out.columns == ["doc_id", "stats", "kept", "n_chars", "_stats", "rule", "_kept"]
    assert out.count() == 3 and out.filter("_kept").count() == 0
    empty = quality.keep_good(docs(spark, []), spark.createDataFrame([], LABELS))
    assert empty.count() == 0


def test_native_and_computed_once(spark, data_dir):
    table, labels = (spark.read.parquet(f"{data_dir}/{t}.parquet") for t in ("documents", "labels"))
    for df in (quality.judge(table, []), quality.keep_good(table, labels)):
        text = plan(df)
        assert not any(x in text for x in ("Python", "Pandas", "InArrow", "Cartesian", "NestedLoop"))
        assert text.count("split(") == 2  # words and lines


@pytest.mark.parametrize("condition", ["kept", "rule IS NOT NULL", "stats.n_words > 50", "kept AND stats.n_repeat_words > 0"])
def test_filters_on_computed_columns(spark, data_dir, condition):
    documents = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text")
    rules = quality.fit(spark.read.parquet(f"{data_dir}/documents.parquet"), spark.read.parquet(f"{data_dir}/labels.parquet"))
    judged = quality.judge(documents, rules)
    want = judged.withColumn("hit", F.expr(condition)).toPandas()
    start = time.monotonic()
    got = {r["doc_id"] for r in judged.filter(condition).collect()}
    assert time.monotonic() - start < 60
    assert got == set(want[want["hit"].fillna(False).astype(bool)]["doc_id"]) and got
