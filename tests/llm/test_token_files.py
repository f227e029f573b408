import io
import random
import zlib

import numpy as np
import pytest
from helpers import WORD, docs, library, words

from placetide.llm import queries, token_files
from placetide.llm.shared import scratch_path


def written(spark, rows, files=3, **options):
    target = scratch_path(spark, "files")
    token_files.write(docs(spark, rows), target, WORD, 2, files, **options)
    return target


def test_query_on_the_test_table(spark, data_dir):
    encode = library(WORD)
    got = sorted(tuple(r) for r in queries.QUERIES["op4_token_files"](spark, data_dir).collect())
    at, want = 0, []
    for r in spark.read.parquet(f"{data_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*encode(r["text"]), 2], "<u4")
        want.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


def test_round_trip_with_nulls_long_texts_and_repeats(spark):
    rng = random.Random(1)
    rows = [(k, words(rng, rng.choice([0, 3, 50]))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, words(rng, 150_000, 5000)), (103, "same"), (103, "same"), (None, "lost")]
    got = token_files.with_starts(token_files.read(spark, written(spark, rows))).orderBy("start").collect()
    encode = library(WORD)
    want = [[*encode(t), 2] for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in got] == want
    assert [r["start"] for r in got] == np.cumsum([0, *map(len, want)])[:-1].tolist()
    assert [r["doc_id"] for r in got][0] is None


def test_reader_decompresses_only_what_is_asked_for(spark):
    rng = random.Random(2)
    rows = [(k, words(rng, 3000, 10_000)) for k in range(200)]
    target = written(spark, rows, files=1)
    file = spark.read.format("binaryFile").load(target).filter("length > 0").first()
    reader = token_files.Reader(io.BytesIO(bytes(file["content"])))
    assert len(reader.plain) > 5 and reader.frames_read == 1  # the index
    ids = reader.ids(reader.keys.index(150))
    assert ids.tolist() == [*library(WORD)(rows[150][1]), 2]
    assert reader.frames_read <= 3
    some = token_files.read(spark, target, keys=[150, 7, 999]).collect()
    assert sorted(r["doc_id"] for r in some) == [7, 150]


def test_file_is_a_zstandard_stream(spark):
    import zstandard

    target = written(spark, [(1, "hello world"), (2, "again")], files=1)
    content = bytes(spark.read.format("binaryFile").load(target).filter("length > 0").first()["content"])
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
    encode = library(WORD)
    assert plain.startswith(np.array([*encode("hello world"), 2, *encode("again"), 2], "<u4").tobytes())


def test_damage_is_found(spark):
    target = written(spark, [(k, f"text {k} of some length") for k in range(50)], files=1, id_bytes=2)
    content = bytearray(spark.read.format("binaryFile").load(target).filter("length > 0").first()["content"])
    reader = token_files.Reader(io.BytesIO(bytes(content)))
    content[int(reader.places[0]) + 40] ^= 0xFF
    with pytest.raises(Exception):  # noqa: B017  the library or the checksum
        token_files.Reader(io.BytesIO(bytes(content))).ids(0)
    with pytest.raises(ValueError, match="seek table"):
        token_files.Reader(io.BytesIO(bytes(content[:-3])))


def test_empty_table(spark):
    assert token_files.with_starts(token_files.read(spark, written(spark, []))).count() == 0


def test_files_count_in_the_order_of_their_numbers(spark):
    names = [f"file:/x/part-1/part-{n:05d}-0a1b.txt" for n in (99_999, 100_000, 7)]
    rows = [(name, row, 10 * k + row, 2 + k) for k, name in enumerate(names) for row in range(2)]
    df = spark.createDataFrame(rows, "file string, row long, doc_id long, n_tokens long")
    got = {r["doc_id"]: r["start"] for r in token_files.with_starts(df).collect()}
    assert got == {20: 0, 21: 4, 0: 8, 1: 10, 10: 12, 11: 15}


def test_files_follow_the_bytes_of_the_texts(spark, monkeypatch):
    """More text makes more files, not larger ones; few bytes leave the session's partitions."""
    rng = random.Random(5)
    rows = [(k, words(rng, 200)) for k in range(300)]
    text = sum(len(t) for _, t in rows)
    monkeypatch.setattr(token_files, "FILE_TEXT", text // 20)
    target = written(spark, rows, files=None)
    found = token_files.read(spark, target).groupBy("file").count().collect()
    assert 15 <= len(found) <= 25 and max(r["count"] for r in found) < 40
    starts = token_files.with_starts(token_files.read(spark, target)).orderBy("start").collect()
    assert [r["doc_id"] for r in starts] == list(range(300))
    monkeypatch.undo()
    few = token_files.read(spark, written(spark, rows, files=None)).groupBy("file").count().collect()
    assert len(few) <= 8 and sum(r["count"] for r in few) == 300
