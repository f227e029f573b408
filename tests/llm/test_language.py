import numpy as np
from helpers import docs

from placetide.llm import language, queries


def test_held_out_accuracy(spark, data_dir):
    rows = queries.QUERIES["op3_language_id"](spark, data_dir)
    truth = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "lang")
    got = rows.join(truth, "doc_id").collect()
    assert len(got) == truth.count()
    held = [r for r in got if r["held_out"]]
    assert 0.15 < len(held) / len(got) < 0.35
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["near"] for r in got]) > 0.98


def test_held_out_split_matches_crc32(spark, data_dir):
    import zlib

    rows = queries.QUERIES["op3_language_id"](spark, data_dir).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


ENGLISH = "the cat sat on the mat and the dog was with them in this house of that man"
GERMAN = "die katze und der hund sind nicht mit einer frau auf den bergen gewesen und ich"


def model(spark):
    rows = [(k, " ".join(np.random.default_rng(k).permutation(t.split())), lang) for k in range(40) for t, lang in ((ENGLISH, "en"), (GERMAN, "de"))]
    return language.fit(docs(spark, rows))


def test_distance_rejects_what_is_like_no_language(spark):
    m = model(spark)
    said = language.identify(docs(spark, [(1, ENGLISH.upper()), (2, GERMAN), (3, "Ωμέγα καὶ ἄλφα λέξις ἐστίν"), (4, "зима холодная")]), m)
    got = {r["doc_id"]: (r["lang_pred"], r["near"]) for r in said.collect()}
    assert got[1] == ("en", True) and got[2] == ("de", True)
    assert not got[3][1] and not got[4][1]


FOREIGN = [
    "Il gatto dorme sulla sedia mentre la pioggia cade lentamente sui tetti della città vecchia e la gente corre verso casa",
    "Kissa nukkuu tuolilla ja sade putoaa hitaasti vanhan kaupungin katoille kun ihmiset juoksevat kotiin",
    "Kot śpi na krześle, a deszcz pada powoli na dachy starego miasta i ludzie biegną do domu",
    "Paka analala kwenye kiti wakati mvua inanyesha polepole juu ya paa za mji wa zamani na watu wanakimbia nyumbani",
    "Кошка спит на стуле, а дождь медленно падает на крыши старого города",
    "".join(np.random.default_rng(1).choice(list("abcdefghijklmnopqrstuvwxyz "), 400)),
    np.random.default_rng(1).bytes(300).hex(" ", 4),
]


def test_foreign_and_noise_texts_are_rejected_and_clean_ones_stay(spark, data_dir):
    # Large enough for samples of over 900 rows a language.
    table = spark.read.parquet(f"{data_dir}/../sf0.1/documents.parquet")
    m = language.fit(table)
    said = language.identify(docs(spark, enumerate(FOREIGN)), m).collect()
    assert [r["doc_id"] for r in said if r["near"]] == []
    clean = language.identify(table.filter("n_chars >= 200"), m).collect()
    assert np.mean([r["near"] for r in clean]) > 0.99


def test_one_odd_row_does_not_set_the_bar():
    rng = np.random.default_rng(4)
    usual, odd = np.abs(rng.normal(1, 0.2, (400, 50))), np.abs(rng.normal(1, 0.2, (1, 50)))
    usual[:, 25:] = odd[:, :25] = 0
    vectors = language._unit(np.concatenate([usual, odd]))
    assert language.least_cosines(vectors, language.cluster(vectors, 4)).min() > 0.5


def test_null_empty_and_letterless_texts(spark):
    said = language.identify(docs(spark, [(1, None), (2, ""), (3, "12 #!"), (None, ENGLISH), (5, ENGLISH * 3000)]), model(spark))
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["near"]) for r in said.collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0, False)
    assert got[None][0] == got[5][0] == "en" and got[5][1] > 0.5


def test_empty_tables_repeats_and_clashing_names(spark):
    nothing = language.fit(docs(spark, []))
    assert [r["lang_pred"] for r in language.identify(docs(spark, [(1, "abc")]), nothing).collect()] == ["und"]
    assert language.identify(docs(spark, []), nothing).count() == 0
    df = docs(spark, [(1, ENGLISH, "en", "s", 3), (1, ENGLISH, "en", "s", 3)]).withColumnRenamed("source", "score")
    out = language.identify(df, model(spark), keep_text=True)
    assert out.columns == ["doc_id", "text", "lang", "score", "n_chars", "lang_pred", "_score", "near"]
    assert out.count() == 2
    assert language.keep_identified(df).columns == df.columns


def test_counts_do_not_depend_on_partitions(spark, data_dir):
    table = spark.read.parquet(f"{data_dir}/documents.parquet").limit(300)
    a, b = (language.document_frequencies(table.repartition(n)) for n in (1, 7))
    assert (a[0] == b[0]).all() and a[1] == b[1] == 300


def test_sample_is_bounded(spark):
    rows = [(k, f"{ENGLISH} {k}", "en") for k in range(50)] + [(7, "same", "xx")] * 30
    m = language.fit(docs(spark, rows), per_language=10, clusters=3)
    assert sorted(set(m.languages)) == ["en", "xx"] and len(m.languages) <= 6
