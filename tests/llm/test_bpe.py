import hashlib

import numpy as np
from helpers import BYTE, docs, library, odd_texts
from tokenizers import Tokenizer

from placetide.llm import bpe, queries


def test_query_on_the_test_table(spark, data_dir):
    tokenizer = Tokenizer.from_file(BYTE)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_bpe"](spark, data_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want


def test_ids_and_texts_of_odd_nulls_empty_and_long_texts(spark):
    encode = library(BYTE)
    texts = [*odd_texts(200, seed=4), None, "", "word " * 50_000, "z" * 20_000, "same", "same"]
    got = bpe.round_trip(docs(spark, list(enumerate(texts))), BYTE).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == encode(text)
        assert r["decoded"] == (text or "")


def test_empty_table_and_clashing_names(spark):
    assert bpe.round_trip(docs(spark, []), BYTE).count() == 0
    df = docs(spark, [(None, "a b", "x", "y", 1)]).withColumnRenamed("lang", "ids").withColumnRenamed("source", "n_tokens")
    assert bpe.round_trip(df, BYTE).columns == ["doc_id", "ids", "n_tokens", "n_chars", "_ids", "decoded"]
    out = bpe.round_trip(df, BYTE, keep_ids=False)
    assert out.columns == ["doc_id", "ids", "n_tokens", "n_chars", "_n_tokens", "ids_sha256", "decoded_sha256"]
    assert out.first()["_n_tokens"] == 2 and out.first()["ids"] == "x"
