"""Substring dedup against brute force over all windows."""

import random

import pytest
from helpers import docs, plan, split_words, words

from placetide.llm import substrings
from placetide.llm.substrings import SuffixAutomaton


def brute(rows, span):
    """Removed word numbers by row number; rows in key order, equal keys in the order given."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    seen, gone = set(), {k: set() for k in order}
    for k in order:
        w = split_words(rows[k][1])
        for i in range(len(w) - span + 1):
            window = tuple(w[i : i + span])
            if window in seen:
                gone[k].update(range(i, i + span))
            seen.add(window)
    return gone


def expected(rows, span):
    out = []
    for k, gone in brute(rows, span).items():
        w = split_words(rows[k][1])
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        spans, begin = [], None
        for i in range(len(w) + 1):
            inside = i in gone
            if inside and begin is None:
                begin = i
            if not inside and begin is not None:
                spans.append((begin, i))
                begin = None
        out.append((rows[k][0], len(w), len(gone), kept, spans))
    return sorted(out, key=repr)


def found(df):
    return sorted(((*tuple(r)[:4], [tuple(s) for s in r["spans"]]) for r in df.collect()), key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    passages = [words(rng, rng.randint(3, 40), 12) for _ in range(6)]
    out = []
    for k in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else words(rng, rng.randint(0, 25), 12) for _ in range(4)]
        out.append((k, rng.choice([" ", "\n", "\t  "]).join(parts)))
    out += [(n + k, out[3][1]) for k in range(5)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("span,hot,size", [(5, 4096, 1 << 22), (5, 3, 700), (9, 2, 300), (20, 4096, 900), (1, 5, 500), (2, 4096, 500)])
def test_against_brute_force(spark, span, hot, size):
    rows = corpus(span)
    got = substrings.without_repeats(docs(spark, rows).repartition(3), span, hot=hot, chunk_bytes=size)
    assert found(got) == expected(rows, span)


def test_odd_rows(spark):
    text = words(random.Random(1), 60)
    rows = [(4, text), (None, text), (2, None), (3, ""), (1, " \n\t"), (5, "é  x \x85 " + text), (9, "q " * 300), (-7, "short")]
    assert found(substrings.without_repeats(docs(spark, rows))) == expected(rows, 20)
    # Of equal rows one stays; a key's rows with other words are told apart.
    rows = [(7, text), (7, text), (7, "new " + text)]
    got = found(substrings.without_repeats(docs(spark, rows)))
    assert sorted(r[2] for r in got) in ([0, 60, 60], [0, 60, 61]) and len(got) == 3


def test_empty_table_and_other_names(spark):
    assert substrings.without_repeats(docs(spark, [])).count() == 0
    rows = spark.createDataFrame([(1, "a b a b a b", "x", 2)], "id long, body string, kept string, part long")
    got = substrings.without_repeats(rows, 2, "id", "body")
    assert [tuple(r)[:4] for r in got.collect()] == [(1, 6, 4, "a b")] and got.columns[0] == "id"


def test_very_long_text(spark):
    rng = random.Random(5)
    passage = words(rng, 30)
    text = " ".join([words(rng, 150_000, 50_000), passage, "x" * 200_000, words(rng, 150_000, 50_000), passage, "y" * 200_000])
    rows = [(1, text), (2, "before " + passage + " behind"), (3, "x" * 200_000 + " z")]
    assert found(substrings.without_repeats(docs(spark, rows))) == expected(rows, 20)


def test_hot_passage_is_met_once_from_each_chunk(spark):
    rng = random.Random(2)
    passage = words(rng, 25)
    rows = [(k, f"{words(rng, 8)} {passage} {words(rng, 8)}") for k in range(400)]
    got = substrings.without_repeats(docs(spark, rows).repartition(4), hot=10)
    assert found(got) == expected(rows, 20)


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_matching_statistics(letters):
    rng = random.Random(letters)
    for _ in range(60):
        automaton, texts = SuffixAutomaton(), []
        for _ in range(4):
            text = [rng.randrange(letters) for _ in range(rng.randint(0, 14))]
            want = []
            for e in range(len(text)):
                best = 0
                for n in range(1, e + 2):
                    part = text[e + 1 - n : e + 1]
                    earlier = any(t[i : i + n] == part for t in texts for i in range(len(t)))
                    if earlier or any(text[i : i + n] == part for i in range(e + 1 - n)):
                        best = n
                want.append(best)
            assert automaton.read(text) == want
            texts.append(text)


def test_plan_has_no_cross_join(spark):
    text = plan(substrings.without_repeats(docs(spark, [(1, "a b")])))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
