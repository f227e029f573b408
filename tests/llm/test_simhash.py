import random
import re

import numpy as np
import pytest
from helpers import docs, plan, split_words, words
from xxhash import xxh64_intdigest

from placetide.llm import components, queries, shared, simhash


def fingerprint(text):
    """Word by word and bit by bit."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = split_words(lower)
    if not found:
        return 0
    shingles = [" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints):
    """Smallest key in reach of each, over all pairs."""
    keys = sorted(prints)
    up = {k: k for k in keys}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    values = np.array([prints[k] for k in keys], np.uint64)
    for i, k in enumerate(keys):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[:i]) <= 3):
            a, b = root(k), root(keys[int(j)])
            up[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def found(spark, rows):
    got = simhash.classes(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    return {r["key"]: (r["print"] & (1 << 64) - 1, r["component"]) for r in got}


def test_query_on_the_test_table(spark, data_dir):
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_simhash"](spark, data_dir).collect()}
    table = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: fingerprint(r["text"]) for r in table}
    want = brute(prints)
    assert {k: (r["fingerprint"], r["component_id"]) for k, r in got.items()} == {k: (f"{prints[k]:016x}", want[k]) for k in prints}


def test_near_copies_and_chains(spark):
    rng = random.Random(1)
    rows = []
    for group in range(12):
        text = words(rng, 150).split()
        for copy in range(15):
            if copy % 3:
                text[rng.randrange(len(text))] = f"x{rng.randrange(999)}"
            rows.append((group * 100 + copy, " ".join(text)))
    want = brute({k: fingerprint(t) for k, t in rows})
    got = found(spark, rows)
    assert {k: c for k, (_, c) in got.items()} == want
    assert len(set(want.values())) < len(rows) - 40


def test_a_group_of_many_blocks(spark):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    prints = {centre}
    while len(prints) < 300:
        p = centre
        for b in rng.choice(64, rng.integers(1, 6), replace=False):
            p ^= np.uint64(1) << np.uint64(b)
        prints.add(p)
    prints = sorted(int(p) for p in prints) + [int(x) for x in rng.integers(0, 2**62, 50)]
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    links = simhash.near_links(df, block=16)
    assert links.count() < 40 * len(prints)
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = brute(dict(enumerate(prints)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    groups = {}
    for k, p in enumerate(signed):
        groups.setdefault(want[k], set()).add(roots.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    left = rng.integers(0, 2**63, 130, dtype=np.uint64)
    right = np.concatenate([left[:70], rng.integers(0, 2**63, 7, dtype=np.uint64)])
    for k in range(70):
        for b in rng.choice(64, rng.integers(0, 8), replace=False):
            right[k] ^= np.uint64(1) << np.uint64(b)
    got = {(i, j) for a, b in simhash.near_pairs(left, right, radius) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    assert got == {(i, j) for i in range(130) for j in range(77) if int(left[i] ^ right[j]).bit_count() <= radius}


def test_null_empty_short_long_and_repeated_texts(spark):
    rows = [(4, None), (3, ""), (9, " \n"), (5, "one"), (6, "ONE"), (7, "one two"), (8, "x y z " * 20_000), (10, "É a b"), (11, "é a b")]
    got = found(spark, rows)
    assert {k: p for k, (p, _) in got.items()} == {k: fingerprint(t) for k, t in rows}
    assert got[4] == got[3] == got[9] == (0, 3)
    assert got[5][1] == got[6][1] == 5
    assert got[10] != got[11]


def test_null_keys_repeats_and_an_empty_table(spark):
    rng = random.Random(4)
    text = words(rng, 50)
    df = docs(spark, [(None, text), (2, text), (2, text), (None, "alone here now")])
    got = sorted((r["key"] or 0, r["component"]) for r in simhash.classes(df).collect() if r["component"] is not None)
    assert got == [(0, 2), (2, 2), (2, 2)]
    kept = simhash.keep_one(df).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 0, 2]
    assert simhash.classes(docs(spark, [])).count() == 0
    assert simhash.keep_one(docs(spark, [])).count() == 0


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(5)
    texts = [words(rng, 80) for _ in range(5)]
    rows = [(k, texts[k % 5], "en", "s", k) for k in range(40)]
    df = docs(spark, rows).withColumnRenamed("source", "print")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("bits", [shared.FILTER_BITS, 8])
def test_keys_that_repeat_and_full_filters(spark, monkeypatch, bits):
    """Whether the bits tell the rows that stay or all rows have to be joined."""
    monkeypatch.setattr(shared, "FILTER_BITS", bits)
    monkeypatch.setattr(shared, "ROW_BITS", min(bits, shared.ROW_BITS))
    rng = random.Random(8)
    a, b, c, d = (words(rng, 80) for _ in range(4))
    rows = [(1, a), (2, a), (3, b), (3, b), (3, c), (4, c), (5, a), (5, d), (None, a), (None, None), (6, None), (7, "")]
    rows += [(k, words(rng, 60)) for k in range(100, 160)] + [(k, d) for k in range(200, 230)]
    kept = [(r["doc_id"], r["text"]) for r in simhash.keep_one(docs(spark, rows)).collect()]
    # Key 3 is the least of both its texts' groups, so one row stays; key 5 only of one of them.
    want = [(1, a), (3, min(b, c)), (5, a), (5, d), (None, a), (None, None), (6, None), *rows[12:72]]
    assert sorted(kept, key=str) == sorted(want, key=str)


def test_texts_that_stay_or_go_do_not_move(spark):
    rng = random.Random(9)
    texts = [words(rng, 80) for _ in range(20)]
    df = docs(spark, [(k, texts[k % 20]) for k in range(400)]).repartition(4).select("doc_id", "text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # As if the table of the keys that stay were large.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = simhash.keep_one(df)
        text = plan(kept)
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(20))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Of the parts of the union only those behind both filters are merged.
    whole, *joined = re.split(r"(?m)^   [:+]- ", text)[1:]
    assert "SortMergeJoin" not in whole and whole.count("BroadcastHashJoin") == 1
    assert len(joined) == 2 and all(p.count("SortMergeJoin") == 1 and p.count("BroadcastHashJoin") == 2 for p in joined)


def test_long_chains_settle(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {**{k: 0 for k in range(301)}, 1000: 1000, 1001: 1000}
