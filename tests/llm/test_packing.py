import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import BYTE, docs, library, words

from placetide.llm import packing, queries


def check(rows, texts, window, end_id=1):
    """Every id of every document lies in one piece, and every window is full or a power of two."""
    encode = library(BYTE)
    by_doc, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for key, text in texts.items():
        ids = np.array([*encode(text), end_id], "<u4")
        at = 0
        for r in sorted(by_doc[key], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]].tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            if "tokens" in r and r["tokens"] is not None:
                assert bytes(r["tokens"]) == part
            at += r["length"]
        assert at == len(ids)
    for pieces in windows.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == pieces[0]["window"] <= window
        assert at == window or at & (at - 1) == 0
    return windows


def test_query_on_the_test_table(spark, data_dir):
    rows = [r.asDict() for r in queries.QUERIES["op1_packing"](spark, data_dir).collect()]
    table = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    check(rows, {r["doc_id"]: r["text"] for r in table}, 2048)


@pytest.mark.parametrize(("window", "shard", "range_"), [(64, 300, 100_000), (16, 50, 200), (128, 1 << 19, 1 << 21)])
def test_small_windows_shards_and_ranges(spark, window, shard, range_):
    rng = random.Random(window)
    texts = {k: words(rng, rng.choice([0, 1, 5, 30, 200]), 50) for k in range(120)}
    texts |= {k: texts[3] for k in range(200, 240)} | {500: None, 501: "", 502: words(rng, 3000)}
    out = packing.pack(docs(spark, texts.items()), BYTE, 1, window=window, shard_tokens=shard, range_tokens=range_)
    check([r.asDict() for r in out.collect()], texts, window)


def test_neighbours_share_a_window(spark):
    rng = random.Random(5)
    topics = [[f"{chr(97 + t)}{k}x" for k in range(30)] for t in range(8)]
    texts = {k: " ".join(rng.choices(topics[k % 8], k=40)) for k in range(160)}
    out = packing.pack(docs(spark, texts.items()), BYTE, 1, window=512)
    windows = check([r.asDict() for r in out.collect()], texts, 512)
    mixed = [len({r["doc_id"] % 8 for r in w}) for w in windows.values() if len(w) > 1]
    # By chance nearly every window would hold three topics or more.
    assert sum(m <= 2 for m in mixed) > 0.8 * len(mixed)


def test_terms_of_a_third_of_all_documents_count(spark):
    rng = random.Random(6)
    topics = [
        "river water lake fish boat ocean island beach wave storm harbor sail".split(),
        "bread cheese butter sugar salt kitchen oven dinner soup apple lemon garlic".split(),
        "court judge law trial jury crime prison police guilty appeal verdict lawyer".split(),
    ]
    # One beginning for all, so that the anchors are equal and the order is that of the keys.
    header = " ".join(f"section {k} of the report on house street number time year people" for k in range(10))
    texts = {k: f"{header} " + " ".join(rng.choices(topics[k % 3], k=30)) for k in range(150)}
    out = packing.pack(docs(spark, texts.items()), BYTE, 1, window=1024)
    windows = check([r.asDict() for r in out.collect()], texts, 1024)
    mixed = [len({r["doc_id"] % 3 for r in w}) for w in windows.values() if len(w) > 3]
    assert len(mixed) > 10 and sum(m <= 2 for m in mixed) > 0.8 * len(mixed)


def test_neighbours_far_apart_in_a_range_are_found(spark):
    rng = random.Random(7)
    common = "section of the report on house street number time year people school city market".split()
    near = " ".join(common * 3 + "guilty verdict jury lawyer appeal".split() * 8)
    # Over 2^18 tokens lie between the two; all anchors are equal, so the order is that of the keys.
    texts = {0: near, 1000: near + " prison"} | {k: " ".join(common + rng.choices(common, k=1200)) for k in range(1, 240)}
    out = packing.pack(docs(spark, texts.items()), BYTE, 1)
    windows = check([r.asDict() for r in out.collect()], texts, 2048)
    assert any({0, 1000} <= {r["doc_id"] for r in w} for w in windows.values())


def test_used_documents_leave_the_index():
    rng = np.random.default_rng(3)
    bodies = [rng.integers(0, 200, rng.integers(1, 40)).astype("<u4") for _ in range(60)]
    idf = rng.random(200).astype(np.float32)
    whole, part = (packing.Shard(bodies, idf, 20.0) for _ in range(2))
    wanted = rng.random(60) < 0.4
    part.keep(wanted)
    for seed in range(60):
        assert np.allclose(part.scores(seed), whole.scores(seed)[wanted])


def test_same_result_again(spark, data_dir):
    table = spark.read.parquet(f"{data_dir}/documents.parquet").limit(100)
    first, again = (packing.pack(table, BYTE, 1, id_bytes=2).collect() for _ in range(2))
    assert sorted(first) == sorted(again)


def test_empty_table_nulls_repeats_and_clashing_names(spark):
    assert packing.pack(docs(spark, []), BYTE, 1).count() == 0
    clash = docs(spark, [(1, "a b"), (1, "a b"), (None, "c"), (None, None)])
    clash = clash.withColumnRenamed("lang", "tokens").withColumnRenamed("source", "anchor")
    rows = packing.pack(clash, BYTE, 1).collect()
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in rows if r["start"] == 0) == [(0, 1), (0, 2), (1, 3), (1, 3)]


def test_ids_too_wide_are_refused(spark):
    with pytest.raises(Exception, match="more than 1 bytes"):
        packing.pack(docs(spark, [(1, "hello world")]), BYTE, 1, id_bytes=1).collect()


def test_bm25_scores_match_the_formula():
    rng = np.random.default_rng(2)
    bodies = [rng.integers(0, 30, rng.integers(1, 40)).astype("<u4") for _ in range(20)]
    df = np.array([sum(t in b for b in bodies) for t in range(30)])
    idf = np.maximum(np.log((20 - df + 0.5) / (df + 0.5)), 0).astype(np.float32)
    average = float(np.mean([len(b) for b in bodies]))
    index = packing.Shard(bodies, idf, average)
    for seed in range(20):
        want = []
        for b in bodies:
            total = 0.0
            for t in set(bodies[seed].tolist()):
                tf = int((b == t).sum())
                norm = tf + packing.K1 * (1 - packing.B + packing.B * len(b) / average)
                total += idf[t] * tf * (packing.K1 + 1) / norm
            want.append(total)
        assert np.allclose(index.scores(seed), want, rtol=1e-5)


def test_frequencies_and_anchors_count_an_id_once_a_document(spark):
    rng = random.Random(8)
    texts = {k: words(rng, rng.choice([0, 1, 3, 60]), 40) for k in range(150)} | {200: None, 201: "a a a a"}
    expected = {k: {*library(BYTE)(t), 1} for k, t in texts.items()}
    made = packing.tokenized(docs(spark, texts.items()).repartition(3), BYTE, 1).cache()
    found = defaultdict(int)
    for ids in expected.values():
        for i in ids:
            found[i] += 1
    assert packing.token_frequencies(made) == found
    hashes = packing._hashes(1 << 17)
    anchors = {r["key"]: r["anchor"] for r in made.filter("n > 0").collect()}
    assert anchors == {k: min(int(hashes[i]) for i in ids) for k, ids in expected.items()}
