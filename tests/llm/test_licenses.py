import pytest
from helpers import docs, plan
from pyspark.sql import functions as F

from placetide.llm import licenses


def found(spark, rows):
    return sorted(
        ((r["doc_id"], r["unit"], r["place"], r["license"]) for r in licenses.scan(docs(spark, rows)).collect()), key=str
    )


MIT = licenses.FULL_TEXTS["MIT"][1]


@pytest.mark.parametrize(
    ("text", "license_"),
    [
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("  LICENCED under Apache   Licence version 2  ", "Apache-2.0"),
        ("* Released under the MIT Licence!", "MIT"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
        ("All rights reserved.", "all-rights-reserved"),
        ("GPL v2", "GPL-2.0"),
        ("MIT", "MIT"),
    ],
)
def test_spellings_of_one_line(spark, text, license_):
    assert found(spark, [(1, f"before\n{text}\nafter")]) == [(1, "line", 2, license_)]


def test_only_entire_texts_match(spark):
    assert found(spark, [(1, "We like the MIT License very much"), (2, "Licensed under the Foo License"), (3, "MITx")]) == []


def test_whole_texts_with_copyright_lines(spark):
    text = MIT.replace("MIT License\n", "MIT Licence\n\nCopyright (c) 2020 Some One\n(c) 2021 another\n").upper()
    got = found(spark, [(1, text)])
    assert (1, "document", 1, "MIT") in got
    # The same words wrapped differently, as one paragraph between others.
    wrapped = "\n".join(licenses.FULL_TEXTS["ISC"][0].replace("\n\n", " ").split(". "))
    assert (2, "paragraph", 2, "ISC") in found(spark, [(2, f"Intro\n\n{wrapped}\n\nOutro")])
    parted = "MIT\nCopyright 2020 me\nLicense"
    assert found(spark, [(3, parted)])[-1] == (3, "paragraph", 1, "MIT")


def wrapped(text, width=70, mark=""):
    """A published form: paragraphs wrapped, each line behind the mark of a comment."""
    import textwrap

    paragraphs = [textwrap.wrap(x, width) for x in text.split("\n\n")]
    lines = [line for k, p in enumerate(paragraphs) for line in ([""] if k else []) + p]
    return "\n".join((mark + line).rstrip() for line in lines)


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_every_whole_text_is_found_wrapped_and_in_comments(spark, mark):
    texts = [(k, t) for k, ts in licenses.FULL_TEXTS.items() for t in ts]
    head = f"{mark}Copyright (c) 2021 Some One\n{mark}\n" if mark else "Copyright 2021 Some One\n\n"
    rows = [(n, "a file\n\n" + head + wrapped(t, 50 + 3 * (n % 9), mark) if mark else head + wrapped(t, 50 + 3 * (n % 9))) for n, (_, t) in enumerate(texts)]
    got = {(d, k) for d, unit, _, k in found(spark, rows) if unit == ("paragraph" if mark else "document")}
    assert {(n, k) for n, (k, _) in enumerate(texts)} <= got


def test_lines_of_text_that_begin_with_copyright_stay(spark):
    text = licenses.FULL_TEXTS["BSD-3-Clause"][0].replace("above copyright notice", "above\ncopyright notice")
    text = text.replace("of the copyright holder", "of the\ncopyright holder").replace("BY THE COPYRIGHT", "BY THE\nCOPYRIGHT")
    assert (1, "document", 1, "BSD-3-Clause") in found(spark, [(1, text)])
    other = text.replace("without specific prior written permission", "without permission")
    assert not [x for x in found(spark, [(1, other)]) if x[1] == "document"]


def test_the_spared_texts_would_not_match(spark):
    known = spark.createDataFrame(licenses.known_texts(), "license string, text string")
    known = known.select(F.monotonically_increasing_id().alias("doc_id"), "text")
    # Every known text is found as itself, so no beginning is missing.
    whole = licenses.scan(known.withColumn("text", F.concat(F.lit("-- "), F.upper("text"))))
    assert whole.select("doc_id").distinct().count() == known.count()


def test_nulls_empty_long_repeated_and_empty_tables(spark):
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, "x y. " * 100_000 + "\nMIT License\n"), (5, "MIT License"), (5, "MIT License"), (None, "ISC License")]
    assert found(spark, rows) == sorted(
        [(4, "line", 2, "MIT"), (5, "line", 1, "MIT"), (5, "line", 1, "MIT"), (None, "line", 1, "ISC")], key=str
    )
    each = {r[0]: (r[1], r[2]) for r in licenses.per_document(docs(spark, rows)).collect()}
    assert each == {1: ("", 0), 2: ("", 0), 3: ("", 0), 4: ("MIT", 1), 5: ("MIT", 2), None: ("ISC", 1)}
    assert licenses.scan(docs(spark, [])).count() == 0


def test_extra_columns_with_the_same_names(spark):
    df = docs(spark, [(1, "MIT License", "x", "y", 3)]).withColumnRenamed("lang", "license").withColumnRenamed("source", "digest")
    assert [tuple(r) for r in licenses.scan(df).collect()] == [(1, "line", 1, "MIT")]


def test_native(spark, data_dir):
    text = plan(licenses.scan(spark.read.parquet(f"{data_dir}/documents.parquet")))
    assert not any(x in text for x in ("Python", "Pandas", "InArrow", "Cartesian", "NestedLoop"))
