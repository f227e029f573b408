"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed byte trigrams, weighted by term frequency and inverse document
frequency and scaled to length 1. Document frequencies come from all training documents.
Centroids are clusters (spherical k-means) of a bounded sample of each language, one task per
language. A text takes the language of the centroid with the largest cosine, and is rejected
when that cosine lies below nearly all of those that sample rows reach with centroids they had no
part in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetide.llm.shared import free_name, slices, stored

# Buckets of the hashed trigrams: the length of every vector.
BUCKETS = 4096
# Documents of one language used for its centroids, at most: those with the smallest hash.
SAMPLE_PER_LANGUAGE = 1500
CLUSTERS = 4
ROUNDS = 8
# A cosine is too far when fewer of the sample's rows than this share lie below it.
FAR_SHARE = 0.005
# Two equal vectors may have a cosine that is less than 1 by this.
ROUNDING = 1e-6
UNKNOWN = "und"
# Bits of a hash that are counted at a time.
PART_BITS = 12
# Bytes of text turned into vectors at a time.
STEP = 4 << 20


def _letters(text: str) -> bool:
    return any(map(str.isalpha, text))


def term_counts(texts: list[str], buckets: int = BUCKETS) -> np.ndarray:
    """Counts of hashed trigrams of the lower-cased UTF-8 bytes, one row per text."""
    out = np.zeros((len(texts), buckets), np.float32)
    for row, text in enumerate(texts):
        b = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8).astype(np.uint32)
        if len(b) > 2:
            code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
            # Multiplicative hashing: the high bits of the product are the bucket.
            bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - (buckets - 1).bit_length())
            out[row] = np.bincount(bucket, minlength=buckets)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.maximum(size, 1e-12)[:, None]


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors of counts, with frequencies dampened by their logarithm."""
    return _unit(np.log1p(counts) * idf)


def document_frequencies(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts there are, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(buckets, np.int64), 0
        for piece in slices(batches, text, STEP):
            texts = [t for t in piece.column(text).to_pylist() if t is not None]
            rows += len(texts)
            found += (term_counts(texts, buckets) > 0).sum(axis=0)
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(found[used], rows))], ["bucket", "n"]
        )

    parts = df.select(text).mapInArrow(count, "bucket long, n long")
    sums = {r["bucket"]: r["n"] for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    out = np.zeros(buckets, np.int64)
    for bucket, n in sums.items():
        if bucket >= 0:
            out[bucket] = n
    return out, sums.get(-1, 0)


def cluster(vectors: np.ndarray, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of spherical k-means, started from rows spread evenly from the most to the least
    typical, so that odd rows are no centres of their own."""
    typical = np.argsort(-(vectors @ vectors.mean(axis=0)), kind="stable")
    clusters = min(clusters, len(vectors))
    centres = vectors[typical[(np.arange(clusters) + 0.5).astype(int) * len(vectors) // clusters]]
    for _ in range(rounds):
        nearest = np.argmax(vectors @ centres.T, axis=1)
        sums = [vectors[nearest == k].sum(axis=0) if (nearest == k).any() else centres[k] for k in range(len(centres))]
        centres = _unit(np.stack(sums))
    return centres


def least_cosines(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The least cosine of each centre that still counts as near.

    Each half of the rows is compared with centres made from the other half. The bar of a
    centre is the low quantile of the rows nearest to it, or that of all rows if lower, so that
    a tight cluster rejects nothing that is typical of the language. A single row gives none: 0.
    """
    if len(vectors) < 2:
        return np.zeros(len(centres))
    half = np.arange(len(vectors)) % 2 == 0
    cosines = np.zeros(len(vectors))
    for part in (half, ~half):
        cosines[part] = (vectors[part] @ cluster(vectors[~part], len(centres)).T).max(axis=1)
    nearest = np.argmax(vectors @ centres.T, axis=1)
    bars = np.full(len(centres), np.quantile(cosines, FAR_SHARE))
    for k in np.unique(nearest):
        bars[k] = min(bars[k], np.quantile(cosines[nearest == k], FAR_SHARE))
    return bars - ROUNDING


@dataclass(frozen=True)
class LanguageModel:
    """Weights, one centroid per row, and the language and least cosine of each centroid."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether it is near enough; UNKNOWN without any letter."""
        known = [t is not None and _letters(t) for t in texts]
        languages = [UNKNOWN] * len(texts)
        scores, near = np.zeros(len(texts)), np.zeros(len(texts), bool)
        rows = [k for k, ok in enumerate(known) if ok and len(self.languages)]
        if rows:
            vectors = weigh(term_counts([texts[k] for k in rows], len(self.idf)), self.idf)
            cosines = vectors @ self.centroids.T
            best = np.argmax(cosines, axis=1)
            top = np.clip(cosines[np.arange(len(rows)), best], 0.0, 1.0)
            for k, b in zip(rows, best, strict=True):
                languages[k] = self.languages[b]
            scores[rows] = top
            near[rows] = top >= self.least[best]
        return languages, scores, near


def _beginning(parts: int) -> Column:
    """The first 12 bits of ``hash``, or the first 24."""
    return F.shiftrightunsigned("hash", 64 - PART_BITS * parts)


def _last_hashes(rows: DataFrame, wanted: int) -> DataFrame:
    """``lang, last``: the least beginning of a hash (24 bits) up to which a language has
    ``wanted`` rows, or its greatest.

    Rows are counted by the first 12 bits, then those of the decisive 12 by the next 12, so no
    language has more than 4,096 counts at a time.
    """
    order = Window.partitionBy("lang").orderBy("part")

    def cut(counted: DataFrame, before: Column) -> DataFrame:
        running = counted.withColumn("sum", F.sum("n").over(order) + before)
        reached = F.min(F.when(F.col("sum") >= wanted, F.col("part")))
        return running.groupBy("lang").agg(
            F.coalesce(reached, F.max("part")).alias("at"),
            F.coalesce(F.max(F.when(F.col("sum") < wanted, F.col("sum"))), F.max(before)).alias("taken"),
        )

    first = cut(rows.groupBy("lang", _beginning(1).alias("part")).agg(F.count("*").alias("n")), F.lit(0))
    inside = rows.join(F.broadcast(first), "lang").filter(_beginning(1) == F.col("at"))
    counted = inside.groupBy("lang", _beginning(2).alias("part"), "taken").agg(F.count("*").alias("n"))
    return cut(counted, F.col("taken")).select("lang", F.col("at").alias("last"))


def fit(
    training: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    per_language: int = SAMPLE_PER_LANGUAGE,
    clusters: int = CLUSTERS,
    buckets: int = BUCKETS,
) -> LanguageModel:
    """Learn from the rows that have a language and a text with a letter.

    The clusters are those of ``per_language`` rows of a language at most, which bounds each
    task's group; the driver receives ``clusters`` rows per language.
    """
    rows = training.select(
        F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    found, n = document_frequencies(rows, "text", buckets)
    idf = (np.log((1 + n) / (1 + found)) + 1).astype(np.float32)
    # The smallest hashes are found without the texts; only the chosen texts move.
    hashed = rows.withColumn("hash", F.xxhash64("key"))
    last = _last_hashes(hashed.select("lang", "hash"), int(per_language))
    # One row per language.
    chosen = hashed.join(F.broadcast(last), "lang").filter(_beginning(2) <= F.col("last"))
    chosen = chosen.filter(F.col("text").rlike(r"\p{L}")).select("lang", "hash", "key", "text")
    order = Window.partitionBy("lang").orderBy("hash", "key", "text")
    ranked = chosen.withColumn("rank", F.row_number().over(order))
    sample = stored(ranked.filter(F.col("rank") <= int(per_language)), "sample")

    def centre(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        vectors = weigh(term_counts(list(pdf["text"]), buckets), idf)
        centres = cluster(vectors, clusters)
        least = least_cosines(vectors, centres)
        return pd.DataFrame(
            {"lang": pdf["lang"].iloc[0], "number": range(len(centres)), "least": least, "centre": list(centres)}
        )

    schema = "lang string, number int, least double, centre array<float>"
    centres = sample.groupBy("lang").applyInPandas(centre, schema).collect()
    centres = sorted(centres, key=lambda r: (r["lang"], r["number"]))
    return LanguageModel(
        idf,
        np.array([r["centre"] for r in centres], np.float32).reshape(len(centres), buckets),
        [r["lang"] for r in centres],
        np.array([r["least"] for r in centres]),
    )


def identify(df: DataFrame, model: LanguageModel, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Each row with ``lang_pred``, ``score`` (cosine) and ``near`` (false: rejected).

    NULL text and text without a letter give ``und``, score 0 and false. The text is dropped
    unless ``keep_text``. Extra columns stay; a taken name gets a leading underscore.
    """
    columns = [c for c in df.columns if keep_text or c != text]
    names = []
    for name in ("lang_pred", "score", "near"):
        names.append(free_name([*columns, *names], name))
    schema = T.StructType(
        [df.schema[c] for c in columns]
        + [T.StructField(n, k) for n, k in zip(names, (T.StringType(), T.DoubleType(), T.BooleanType()), strict=True)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text, STEP):
            languages, scores, near = model.predict(piece.column(text).to_pylist())
            arrays = [piece.column(c) for c in columns] + [pa.array(languages), pa.array(scores), pa.array(near)]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *names])

    return df.select(*dict.fromkeys([*columns, text])).mapInArrow(run, schema)


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents whose language is near enough to be told, with the columns they came with."""
    said = identify(docs, fit(docs), keep_text=True)
    return said.filter(F.col(said.columns[-1])).select(*docs.columns)
