"""Five filtering and packing stages over ``documents``, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placetide.llm import language, line_chunks, packing, quality, simhash
from placetide.llm.queries import tokenizer_file
from placetide.llm.shared import importable, scratch_path

END_ID = 1


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a learned one rejects."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is near enough to a centroid to be told."""
    return language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that stand in an earlier one; emptied ones go."""
    return line_chunks.keep_new_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows filled with lexical neighbours, with their ids."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), END_ID, id_bytes=2)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("packing", pack),
]

# Centroids, fingerprints' links and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the rows of the last one."""
    importable(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
