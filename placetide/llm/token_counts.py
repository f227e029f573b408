"""Exact histogram of encoded lengths and what follows from it for every context limit.

Documents are encoded once and counted by length; everything else is computed on the histogram,
whose rows are as many as there are different lengths. Sums over all longer documents go in two
levels, blocks of lengths and lengths within a block, so no task needs the whole histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placetide.llm.encoding import encoder
from placetide.llm.shared import slices, stored

STEP = 6 << 20
# Lengths in a block of the histogram.
BLOCK = 1024


def encoded_lengths(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``n_tokens`` of every row; NULL text counts as empty and has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for piece in slices(batches, text, STEP):
            _, sizes = encode(piece.column(text))
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n_tokens"])

    return df.select(text).mapInArrow(run, "n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """``n_tokens, n_docs``: how many documents have each length that occurs; written once, as
    all answers come from it."""
    return stored(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "histogram")


def suffix_sums(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """The histogram with the answers for a context limit of ``n_tokens``, one row per length:

    ``docs_from`` and ``tokens_from`` (documents at least that long and their tokens),
    ``truncated_total`` (tokens left when every document is cut at this length), ``lost_tokens``
    (tokens cut off), and ``total_docs``, ``total_tokens``. An empty table gives no row.
    """
    rows = hist.withColumn("block", F.floor(F.col("n_tokens") / block).cast("long"))
    rows = rows.withColumn("n_sum", F.col("n_tokens") * F.col("n_docs"))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("n_sum").alias("block_tokens"))
    # One row per block of lengths: the longest document bounds them, not the corpus.
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(after), F.lit(0)).alias("above_docs"),
        F.coalesce(F.sum("block_tokens").over(after), F.lit(0)).alias("above_tokens"),
        F.sum("block_docs").over(everything).alias("total_docs"),
        F.sum("block_tokens").over(everything).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    rows = rows.select(
        "n_tokens", "n_docs", "block", F.sum("n_docs").over(inside).alias("d"), F.sum("n_sum").over(inside).alias("t")
    )
    rows = rows.join(above, "block").select(
        "n_tokens",
        "n_docs",
        (F.col("d") + F.col("above_docs")).alias("docs_from"),
        (F.col("t") + F.col("above_tokens")).alias("tokens_from"),
        "total_docs",
        "total_tokens",
    )
    lost = F.col("tokens_from") - F.col("docs_from") * F.col("n_tokens")
    return rows.select(
        "n_tokens",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("total_tokens") - lost).alias("truncated_total"),
        lost.alias("lost_tokens"),
        "total_docs",
        "total_tokens",
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context_limit, n_longer, truncated_total, lost_tokens`` for any limits, from
    :func:`suffix_sums`: the first length above a limit has all it takes."""
    spark = sums.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(int(x),) for x in limits], "context_limit long"))
    # Each length looks at the stated limits below it; a limit's answer is a maximum over them.
    longer = sums.select("*", F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("context_limit"))
    longer = longer.filter("n_tokens > context_limit").groupBy("context_limit")
    found = longer.agg(F.max(F.struct("docs_from", "tokens_from")).alias("s"))
    whole = sums.agg(F.max("total_tokens").alias("t")).select(F.coalesce("t", F.lit(0))).scalar()
    docs = F.coalesce("s.docs_from", F.lit(0))
    lost = F.coalesce(F.col("s.tokens_from"), F.lit(0)) - docs * F.col("context_limit")
    return wanted.join(found, "context_limit", "left").select(
        "context_limit",
        docs.alias("n_longer"),
        (whole - lost).alias("truncated_total"),
        lost.alias("lost_tokens"),
    )


def at_quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, n_tokens``: the smallest length that this share of the documents do not exceed."""
    below = F.col("total_docs") - F.col("docs_from") + F.col("n_docs")
    each = sums.select("n_tokens", "total_docs", below.alias("below"), F.explode(F.array(*map(F.lit, shares))).alias("share"))
    return each.filter("below >= share * total_docs").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
