import random

import pytest
from helpers import docs, plan
from pyspark.sql import functions as F

from placetide.llm import line_chunks as lc


def cut(spark, rows, **options):
    out = lc.without_repeats(docs(spark, rows).select("doc_id", "text"), **options)
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in out.collect()}


def lines(rng, n, tag=""):
    return [f"{tag}line {rng.randrange(10**9)} of the text" for _ in range(n)]


def test_exact_copies_lose_all_chunks_but_the_first(spark):
    rng = random.Random(1)
    text = "\n".join(lines(rng, 30))
    got = cut(spark, [(5, text), (2, text), (9, text), (7, "one line"), (8, "one line")])
    assert got[2] == (text, 30, 0)
    assert got[5] == got[9] == ("", 30, 30)
    # A text of one line has no multi-line chunk.
    assert got[7] == got[8] == ("one line", 1, 0)


def test_shared_passage_goes_whatever_stands_around_it(spark):
    rng = random.Random(2)
    passage = lines(rng, 60)
    rows = [(k, "\n".join(lines(rng, 5 + k) + passage + lines(rng, 3 + k))) for k in range(8)]
    got = cut(spark, rows)
    kept = set("\n".join(t for t, _, _ in got.values()).split("\n"))
    assert set(passage) <= kept
    for k in range(1, 8):
        left = [x for x in got[k][0].split("\n") if x in passage]
        # Only the chunks over the passage's ends keep some of its lines.
        assert len(left) < 30
        assert set(rows[k][1].split("\n")) - set(passage) <= set(got[k][0].split("\n"))


def test_an_inserted_line_moves_few_cuts(spark):
    rng = random.Random(3)
    text = lines(rng, 200)
    rows = [(1, "\n".join(text)), (2, "\n".join([*text[:100], "new", *text[100:]]))]
    got = lc.chunked(docs(spark, rows)).orderBy("doc_id").collect()
    a, b = ({"\n".join(r["lines"][s:e]) for s, e in zip(r["starts"], [*r["starts"][1:], None], strict=True)} for r in got)
    assert len(a ^ b) <= 6


def test_chunks_cover_the_text_and_share_their_boundary_lines(spark):
    rng = random.Random(4)
    rows = [(k, "\n".join(lines(rng, k))) for k in range(1, 60)]
    for r in lc.chunked(docs(spark, rows)).collect():
        assert r["starts"][0] == 0 and r["starts"][-1] == len(r["lines"]) - 1
        assert all(a < b for a, b in zip(r["starts"], r["starts"][1:], strict=False))


def test_short_lines_are_no_boundaries(spark):
    body = [f"a line of its own {k}\n  }}\n}}\n" for k in range(4)]
    got = cut(spark, [(k, b + f"and an end {k}") for k, b in enumerate(body)])
    assert all(n == 0 for _, _, n in got.values())


@pytest.mark.parametrize("n", range(2, 9))
def test_short_shared_passages_go(spark, n):
    """Passages of few lines inside otherwise different texts: over 0.9 of their lines go."""
    rng = random.Random(n)
    passages = [lines(rng, n) for _ in range(60)]
    rows = [
        (100 * copy + k, "\n".join(lines(rng, 1 + k % 4) + p + lines(rng, 1 + k % 3)))
        for copy in range(2) for k, p in enumerate(passages)
    ]
    got = cut(spark, rows)
    own = {k: set(t.split("\n")) - set(passages[k % 100]) for k, t in rows}
    assert all(own[k] <= set(got[k][0].split("\n")) for k in own)
    assert all(got[k][2] == 0 for k in range(60))
    assert sum(got[100 + k][2] for k in range(60)) >= 0.9 * 60 * n


def brute(rows):
    """Whole rule over (doc_id, text) in plain Python."""
    import hashlib

    seen, out = set(), {}
    for key, text in sorted(rows):
        held = text.split("\n")
        last = len(held) - 1
        cuts = [
            i for i, x in enumerate(held)
            if i in (0, last) or (len(x) >= lc.MIN_LINE and int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % 2**31 % lc.SPARING)
        ]
        gone = set()
        for s, e in zip(cuts, cuts[1:], strict=False):
            body = tuple(held[s : e + 1])
            if body in seen:
                gone |= set(range(s, e + 1))
            seen.add(body)
        left = [x for i, x in enumerate(held) if i not in gone]
        out[key] = ("\n".join(left), len(held), len(gone))
    return out


def test_brute_force_with_overlaps_and_repeats_inside_a_text(spark):
    rng = random.Random(6)
    pool = lines(rng, 12) + ["", "}", "é" * 9]
    rows = [(k, "\n".join(rng.choices(pool, k=rng.randint(1, 14)))) for k in range(150)]
    got = cut(spark, rows)
    assert got == brute(rows)
    kept = lc.keep_new_lines(docs(spark, rows)).select("doc_id", "text").collect()
    want = {k: t for k, (t, n, lost) in brute(rows).items() if lost < n}
    assert {r["doc_id"]: r["text"] for r in kept} == want


def test_a_very_long_text(spark):
    rng = random.Random(8)
    long = lines(rng, 40_000)
    got = cut(spark, [(1, "\n".join(long)), (2, "\n".join([*long, "its own last line"]))])
    assert got[1][2] == 0 and got[2][2] >= 39_990


def test_equal_hashes_of_different_bytes_stay(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(k, "\n".join(lines(rng, 12))) for k in range(6)]
    monkeypatch.setattr(lc.F, "xxhash64", lambda *c: lc.F.lit(7).cast("bigint"))
    assert cut(spark, rows) == {k: (t, 12, 0) for k, t in rows}


def test_nulls_empty_texts_repeated_rows_and_an_empty_table(spark):
    text = "\n".join(f"l{k}" for k in range(12))
    got = cut(spark, [(1, None), (2, ""), (3, "\n\n\n"), (None, text), (6, text)])
    assert got[1] == (None, 0, 0) and got[2] == ("", 1, 0) and got[3] == ("\n\n\n", 4, 0)
    assert got[None] == (text, 12, 0) and got[6] == (text, 12, 0)
    # Rows that repeat both key and text are one text.
    twice = lc.without_repeats(docs(spark, [(1, text), (1, text)]).select("doc_id", "text"))
    assert [r["n_removed"] for r in twice.collect()] == [0, 0]
    # Rows that share a key only are told apart.
    shared = lc.without_repeats(docs(spark, [(0, text), (1, text), (1, "x\ny\nz")]).select("doc_id", "text")).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in shared) == [(0, 0), (1, 0), (1, 12)]
    assert lc.without_repeats(docs(spark, [])).count() == 0


def test_extra_columns_with_the_same_names_stay(spark):
    df = docs(spark, [(1, "a\nb"), (2, "a\nb")])
    for old, new in (("lang", "lines"), ("source", "n_removed"), ("n_chars", "gone")):
        df = df.withColumnRenamed(old, new)
    out = lc.without_repeats(df)
    assert out.columns == ["doc_id", "text", "lines", "n_removed", "gone", "n_lines", "_n_removed"]
    assert {r["doc_id"]: r["_n_removed"] for r in out.collect()} == {1: 0, 2: 2}
    kept = lc.keep_new_lines(df)
    assert kept.columns == df.columns and [r["doc_id"] for r in kept.collect()] == [1]


def test_native(spark, data_dir):
    table = spark.read.parquet(f"{data_dir}/documents.parquet")
    text = plan(lc.without_repeats(table))
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_short_texts_are_whole_chunks(spark, n):
    text = "\n".join("abcde"[:n])
    got = cut(spark, [(1, text), (2, text)])
    assert got[2] == ((text, 1, 0) if n == 1 else ("", n, n))


@pytest.mark.parametrize("hot", [1, 10, 10**6])
def test_hot_chunks_give_the_same_result(spark, monkeypatch, hot):
    """Whether no hash, some hashes or every repeated hash is hot, the first of equal chunks stays."""
    monkeypatch.setattr(lc, "HOT", hot)
    rng = random.Random(7)
    common, passages = "\n".join(lines(rng, 4)), [lines(rng, 3) for _ in range(20)]
    rows = [(k, common) for k in range(0, 120, 2)]
    rows += [(k, "\n".join(lines(rng, 2) + passages[k % 20] + lines(rng, 2))) for k in range(1, 120, 2)]
    got = cut(spark, rows)
    seen, want = set(), {}
    for k, text in sorted(rows):
        body = text.split("\n")
        starts = [i for i, x in enumerate(body) if i in (0, len(body) - 1) or _boundary(x)]
        gone = set()
        for s, e in zip(starts, starts[1:], strict=False):
            chunk = "\n".join(body[s : e + 1])
            gone |= set(range(s, e + 1)) if chunk in seen else set()
            seen.add(chunk)
        want[k] = ("\n".join(x for i, x in enumerate(body) if i not in gone), len(body), len(gone))
    assert got == want


def _boundary(line):
    import hashlib

    return len(line) >= lc.MIN_LINE and int(hashlib.md5(line.encode()).hexdigest()[:8], 16) % (1 << 31) % lc.SPARING != 0


def test_only_texts_that_may_hold_a_known_id_are_marked(spark):
    rows = spark.range(40_000).selectExpr("id AS key", "xxhash64(id) AS version")
    known = rows.filter("key % 100 = 0")
    got, mark = lc._marked(rows, [F.col("key"), F.col("version")], known)
    marked = {r["key"] for r in got.filter(mark).collect()}
    assert marked >= set(range(0, 40_000, 100)) and len(marked) < 440 and got.count() == 40_000
    none, mark = lc._marked(rows, [F.col("key"), F.col("version")], known.limit(0))
    assert none.filter(mark).count() == 0


def test_texts_that_lose_nothing_do_not_move(spark):
    rng = random.Random(21)
    big = [(k, "\n".join(lines(rng, 200))) for k in range(300)]
    shared = "\n".join(lines(rng, 12))
    rows = [*big, (1000, shared), (1001, shared), (None, shared), (1002, None)]
    df = docs(spark, rows).repartition(4).select("doc_id", "text")
    out = lc.without_repeats(df)
    text = plan(out)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in out.collect()}
    assert got == {**{k: (t, 0) for k, t in big}, 1000: (shared, 0), 1001: ("", 12), None: (shared, 0), 1002: (None, 0)}
    # Of both sides of the union only the texts with a mark are merged with what they lose.
    assert text.count("Union") == 1 and text.count("SortMergeJoin") == 1
    assert text.count("BroadcastHashJoin") == 2
