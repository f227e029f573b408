"""The package's operators as named queries over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placetide.llm import alignment, bpe, language, licenses, line_chunks, packing, quality, search, simhash, substrings, token_counts, token_files, topk
from placetide.llm.shared import importable, scratch_path
from placetide.workload.registry import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[Tables], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return fn(Tables(spark, folder))

    QUERIES[fn.__name__] = run
    return fn


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies; every executor has the same library."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_packing(t: Tables) -> DataFrame:
    path = tokenizer_file("byte_bpe_50k.json")
    return packing.pack(t.documents.select("doc_id", "text"), path, end_id=1, id_bytes=2, keep_tokens=False).drop("tokens")


@_query
def op2_line_dedup(t: Tables) -> DataFrame:
    return line_chunks.without_repeats(t.documents.select("doc_id", "text"))


SQL["op2_line_dedup"] = line_chunks.SQL


@_query
def op3_language_id(t: Tables) -> DataFrame:
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    rows = t.documents.select("doc_id", "text", "lang")
    model = language.fit(rows.filter(part != 2))
    said = language.identify(rows.select("doc_id", "text", (part == 2).alias("held_out")), model)
    return said.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "lang_pred", "score", "near")


@_query
def op4_token_files(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "text")
    target = scratch_path(t.spark, "token_files")
    token_files.write(rows, target, tokenizer_file("word_bpe_49k.json"), 2, id_bytes=2)
    found = token_files.with_starts(token_files.read(t.spark, target, keep_ids=False))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@_query
def op5_topk(t: Tables) -> DataFrame:
    return topk.top_k(t.embeddings, F.col("key") % 20 == 0, 20)


SQL["op5_topk"] = topk.SQL


@_query
def op6_token_counts(t: Tables) -> DataFrame:
    lengths = token_counts.encoded_lengths(t.documents, tokenizer_file("byte_bpe_50k.json"))
    return token_counts.suffix_sums(token_counts.histogram(lengths))


@_query
def op7_simhash(t: Tables) -> DataFrame:
    found = simhash.classes(t.documents.select("doc_id", "text"))
    # The same 64 bits, unsigned and with all their digits.
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return found.select(F.col("key").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


@_query
def op8_licenses(t: Tables) -> DataFrame:
    return licenses.scan(t.documents.select("doc_id", "text"))


SQL["op8_licenses"] = licenses.sql()


@_query
def op9_bpe(t: Tables) -> DataFrame:
    path = tokenizer_file("byte_bpe_50k.json")
    return bpe.round_trip(t.documents.select("doc_id", "text"), path, keep_ids=False)


@_query
def op10_quality_rules(t: Tables) -> DataFrame:
    rules = quality.fit(t.documents, t.labels)
    judged = quality.judge(t.documents.select("doc_id", "text"), rules)
    return judged.select(
        "doc_id",
        *[f"stats.{c}" for c in quality.BASE],
        quality.base_failed(F.col("stats")).alias("base_failed"),
        "kept",
        "rule",
    )


@_query
def op11_alignment(t: Tables) -> DataFrame:
    paths = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return alignment.align(t.documents.select("doc_id", "text"), *paths, keep_groups=False).drop("groups")


@_query
def op12_search(t: Tables) -> DataFrame:
    return search.search(t.documents.select("doc_id", "text"), t.benchmark.select("item_id", "text"), 50)


SQL["op12_search"] = search.SQL


@_query
def op13_substrings(t: Tables) -> DataFrame:
    found = substrings.without_repeats(t.documents.select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op13_substrings"] = substrings.SQL
