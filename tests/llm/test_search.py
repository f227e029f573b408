"""Ranked search against scoring every document."""

import math
import random
import re

import numpy as np
import pytest
from helpers import docs, plan, words

from placetide.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute(rows, queries, k):
    bags = [(d, terms(t)) for d, t in rows]
    bags = [(d, w) for d, w in bags if w]
    n, total = len(bags), sum(len(w) for _, w in bags)
    out = []
    for item, text in queries:
        scores = {}
        for t in set(terms(text)):
            df = sum(t in w for _, w in bags)
            weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
            for at, (_, w) in enumerate(bags):
                tf = w.count(t)
                m = 100 - 50 + (50 * len(w) * n) // total
                scores[at] = scores.get(at, 0) + weight * ((1000000000 * tf) // (1000 * tf + 20 * m))
        best = sorted(((-s, bags[at][0] is not None, bags[at][0] or 0) for at, s in scores.items() if s > 0))[:k]
        out += [(item, r + 1, d if known else None, -s) for r, (s, known, d) in enumerate(best)]
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(df):
    assert [c for c, _ in df.dtypes] == ["item_id", "rank", "doc_id", "score"] and dict(df.dtypes)["rank"] == "int"
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n=150):
    rng = random.Random(seed)
    rows = [(k, words(rng, rng.randint(1, 40), 60)) for k in range(n)]
    rows += [(n + k, rows[3][1]) for k in range(30)]
    rng.shuffle(rows)
    queries = [(q, words(rng, rng.randint(1, 12), 70)) for q in range(8)]
    return rows, queries


@pytest.mark.parametrize("seed,k,postings,block", [(1, 5, 1 << 19, 1024), (2, 10, 200, 3), (3, 1, 60, 1), (4, 500, 300, 5)])
def test_against_scoring_all(spark, seed, k, postings, block):
    rows, queries = corpus(seed)
    got = search.search(
        docs(spark, rows).repartition(3), table(spark, queries), k, shard_postings=postings, query_block=block
    )
    assert found(got) == brute(rows, queries, k)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " .,!"), (None, "Alpha beta"), (5, "ALPHA, beta"), (4, "alpha beta"), (4, "alpha beta"), (6, "Éa éa É"),
            (7, "x" * 100_000 + " alpha"), (8, "other " * 50_000)]
    queries = [(1, "alpha Alpha BETA"), (None, "éa"), (2, None), (3, "?"), (1, "nowhere"), (9, "É x-ray")]
    assert found(search.search(docs(spark, rows), table(spark, queries), 4)) == brute(rows, queries, 4)


def test_empty_tables_and_other_names(spark):
    none = search.search(docs(spark, []), table(spark, [(1, "a")]), 3)
    assert none.count() == 0 and found(search.search(docs(spark, [(1, "a")]), table(spark, []), 3)) == []
    rows = spark.createDataFrame([(1, "a b", 5, "x"), (2, "c", 6, "y")], "id long, body string, rank int, score string")
    asked = spark.createDataFrame([(3, "a", "z")], "q long, said string, key string")
    got = search.search(rows, asked, 3, "id", "body", "q", "said").collect()
    assert [tuple(r)[:3] for r in got] == [(3, 1, 1)]


def test_range_maxima(spark):
    rng = np.random.default_rng(3)
    term, doc = np.divmod(rng.choice(40 * 500, 6000, replace=False), 500)
    impact = rng.integers(0, 50, 6000)
    shard = search.Shard(500, term, doc, impact)
    score = np.zeros((40, 500), np.int64)
    score[term, doc] = impact
    for _ in range(200):
        bag = np.unique(rng.integers(0, 45, rng.integers(1, 20)))
        k = int(rng.integers(1, 30))
        all_scores = score[bag[bag < 40]].sum(axis=0)
        order = np.lexsort([np.arange(500), -all_scores])[:k]
        want = [(int(all_scores[d]), int(d)) for d in order if all_scores[d] > 0]
        assert shard.best(bag, k, 0) == want
        floor = int(np.median(all_scores))
        assert shard.best(bag, k, floor) == [x for x in want if x[0] >= floor]


def test_plan_has_no_cross_join(spark):
    text = plan(search.search(docs(spark, [(1, "a b")]), table(spark, [(1, "a")]), 3))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
