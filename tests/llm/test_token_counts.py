import random

import pytest
from helpers import BYTE, docs, library, words

from placetide.llm import queries, token_counts


def brute(lengths):
    total = sum(lengths)
    return [
        (
            n, lengths.count(n), sum(x >= n for x in lengths), sum(x for x in lengths if x >= n),
            sum(min(x, n) for x in lengths), sum(max(0, x - n) for x in lengths), len(lengths), total,
        )
        for n in sorted(set(lengths))
    ]


def test_query_on_the_test_table(spark, data_dir):
    encode = library(BYTE)
    lengths = [len(encode(r["text"])) for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("text").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op6_token_counts"](spark, data_dir).collect())
    assert got == brute(lengths)


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_limits_and_quantiles(spark, block):
    rng = random.Random(block)
    rows = [(k, words(rng, rng.choice([0, 1, 2, 5, 40, 300]))) for k in range(80)] + [(99, None), (99, None), (98, "")]
    encode = library(BYTE)
    lengths = [len(encode(t)) for _, t in rows]
    hist = token_counts.histogram(token_counts.encoded_lengths(docs(spark, rows), BYTE))
    sums = token_counts.suffix_sums(hist, block)
    assert sorted(tuple(r) for r in sums.collect()) == brute(lengths)
    limits = [0, 1, 3, 100, 10**6]
    got = {r["context_limit"]: tuple(r)[1:] for r in token_counts.at_limits(sums, limits).collect()}
    for x in limits:
        cut = sum(min(n, x) for n in lengths)
        assert got[x] == (sum(n > x for n in lengths), cut, sum(lengths) - cut)
    ordered = sorted(lengths)
    for r in token_counts.at_quantiles(sums, [0.1, 0.5, 0.9, 1.0]).collect():
        share = r["share"]
        want = next(n for k, n in enumerate(ordered) if k + 1 >= share * len(ordered))
        assert r["n_tokens"] == want


def test_empty_table(spark):
    sums = token_counts.suffix_sums(token_counts.histogram(token_counts.encoded_lengths(docs(spark, []), BYTE)))
    assert sums.count() == 0
    assert [tuple(r) for r in token_counts.at_limits(sums, [5]).collect()] == [(5, 0, 0, 0)]
    assert token_counts.at_quantiles(sums, [0.5]).count() == 0


def test_clashing_names(spark):
    df = docs(spark, [(1, "a b")]).withColumnRenamed("lang", "n_tokens")
    assert [r[0] for r in token_counts.encoded_lengths(df, BYTE).collect()] == [2]
