"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placetide.sources import storage

# ASCII white space of the word rules: space, tab, line feed, vertical tab, form feed, return.
SPACE = "\x20\x09-\x0d"
# Bits by which texts are told that need not move (8 MB in all), and of them in one row.
FILTER_BITS = 1 << 26
ROW_BITS = 1 << 15


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; see :func:`storage.stored`."""
    return storage.stored(df, f"llm/{name}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """New folder path under the shared folder, removed when the Python process ends."""
    return storage.scratch_dir(spark, "llm", name)


def importable(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package from where it lies.

    On a cluster it is installed or sent with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if spark.sparkContext.master.startswith("local") and root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def free_name(columns: Sequence[str], name: str) -> str:
    """``name``, prefixed until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def filter_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on columns that are costly to compute.

    The optimizer would push a plain filter below the projections and write their expressions out
    in it, so that each is computed again, inside lambdas even once per element. A row number
    that is neither deterministic nor negative keeps the filter where it stands.
    """
    mark = free_name(df.columns, "_mark")
    marked = df.withColumn(mark, F.monotonically_increasing_id())
    return marked.filter(condition & (F.col(mark) >= 0)).drop(mark)


def marked(rows: DataFrame, ids: list[Column], known: DataFrame) -> tuple[DataFrame, str]:
    """``rows`` with an added column, and its name: false where no row of ``known`` has these ids.

    True may be wrong, so a join must follow; what is false needs none. Only the bits of the ids'
    hashes go to all tasks, as many whatever the corpus.
    """
    row, bits, mark = (free_name(rows.columns, n) for n in ("_row", "_bits", "_mark"))
    slot = lambda cols: F.pmod(F.xxhash64(*cols), F.lit(FILTER_BITS))
    row_of = lambda cols: F.floor(slot(cols) / ROW_BITS)
    held = known.groupBy(row_of(known.columns).alias(row)).agg(F.bitmap_construct_agg(slot(known.columns) % ROW_BITS).alias(bits))
    at = (slot(ids) % ROW_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(held), row_of(ids) == F.col(row), "left")
    return found.withColumn(mark, F.coalesce(F.getbit(byte, at.bitwiseAND(7)) == 1, F.lit(False))).drop(row, bits), mark


def parts_for(rows: int, each: int) -> int:
    """Partitions that hold about ``each`` rows."""
    return max(1, -(-int(rows) // each))


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a text column has about ``size`` bytes in each piece.

    One row always stays whole.
    """
    for batch in batches:
        done, held = 0, 0
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        for row, length in enumerate(lengths):
            if held and held + length > size:
                yield batch.slice(done, row - done)
                done, held = row, 0
            held += int(length)
        if batch.num_rows > done:
            yield batch.slice(done)
