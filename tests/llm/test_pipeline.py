"""The pipeline, each stage against a plain re-computation on what the one before it kept."""

import duckdb
import numpy as np
import pytest
from test_packing import check
from test_quality import counts, failed
from test_simhash import brute, fingerprint

import corpus_pipeline
from placetide.llm import line_chunks, quality
from placetide.llm.shared import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, data_dir):
    """What goes into each stage, and the last one's result."""
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "test")
        stage(spark, out[-1], data_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
        if name != "packing":
            assert out[-1].columns == COLUMNS
    return out


def rows(df):
    found = {r["doc_id"]: tuple(r) for r in df.collect()}
    assert len(found) == df.count()
    return found


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "line dedup", "SimHash near-dedup", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_stage(steps, spark, data_dir):
    before, after = rows(steps[0]), rows(steps[1])
    rules = quality.fit(steps[0], spark.read.parquet(f"{data_dir}/labels.parquet"))
    kept = {r["doc_id"] for r in quality.judge(steps[0], rules).filter("kept").collect()}
    base = {k for k, r in before.items() if not failed(*(counts(r[1])[j] for j in (0, 4)))}
    assert set(after) == kept <= base
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{data_dir}/labels.parquet").collect()}
    good = {k for k in base if labels.get(k) == 1}
    bad = {k for k in base if labels.get(k) == 0}
    assert len(good & kept) > 0.97 * len(good) and len(bad & kept) < 0.1 * len(bad)
    assert all(after[k] == before[k] for k in after)


def test_language_stage(steps):
    before, after = rows(steps[1]), rows(steps[2])
    assert set(after) <= set(before) and len(after) > 0.99 * len(before)
    assert all(after[k] == before[k] for k in after)


def test_line_stage(steps):
    con = duckdb.connect()
    con.register("documents", steps[2].toPandas())
    want = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, text FROM ({line_chunks.SQL}) WHERE n_removed = 0 OR n_removed < n_lines").fetchall()}
    before, after = rows(steps[2]), rows(steps[3])
    assert {k: r[1] for k, r in after.items()} == want
    assert all(after[k][2:] == before[k][2:] for k in after) and len(after) < len(before)


def test_simhash_stage(steps):
    before, after = rows(steps[3]), rows(steps[4])
    found = brute({k: fingerprint(r[1]) for k, r in before.items()})
    assert set(after) == set(found.values())
    assert all(after[k] == before[k] for k in after)


def test_packing_stage(steps):
    texts = {k: r[1] for k, r in rows(steps[4]).items()}
    check([r.asDict() for r in steps[5].collect()], texts, 2048)


def test_run_gives_the_last_stage(steps, spark, data_dir):
    got = corpus_pipeline.run(spark, data_dir)
    assert got.columns == steps[5].columns
    key = lambda r: (r["sequence_id"], r["offset"])
    assert sorted(got.collect(), key=key) == sorted(steps[5].collect(), key=key)
    assert np.sum([r["length"] for r in got.collect()]) > 0
