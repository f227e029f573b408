"""Exact top-k inner products on a bit-sliced index.

Every component of a vector becomes an integer; the bits of one component over many rows are a
bitmap (slice). A query adds the slices of all components, each as often as its own integer
says: the integer is written in signed powers of two, a negative one adds the complement of the
slice, and slices of equal weight are reduced by carry-save adders. The sum is again a bit-sliced
number per row. Its top rows are found from the most significant slice downward with bitmaps
alone, rows that tie at the boundary are taken by their id, and the scores are read off the
slices exactly.

Blocks of rows meet blocks of queries; a task holds one of each, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placetide.llm.shared import parts_for, stored

SCALE = 64
# Rows in a block of the index, and queries that meet it in one task.
ROW_BLOCK = 1 << 16
QUERY_BLOCK = 128
# Query blocks that share one copy of a block of rows.
SLICE_BLOCKS = 32
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``key, q``: floor(scale * x) of every component; rows with a NULL key, a NULL or empty
    vector, or a component that is NULL or not finite are left out. Repeated rows count once."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    fit = F.col(key).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad
    q = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint"))
    return df.filter(fit).select(F.col(key).alias("key"), q.alias("q")).distinct()


def _pack(bits: np.ndarray) -> np.ndarray:
    """Booleans to little-endian words along the last axis, whose length is a multiple of 64."""
    return np.packbits(bits, axis=-1, bitorder="little").view("<u8")


class Block:
    """Slices of a block of rows, which are ordered by key."""

    def __init__(self, keys: np.ndarray, low: np.ndarray, bits: np.ndarray, body: np.ndarray):
        self.keys, self.low = keys, low
        words = -(-len(keys) // 64)
        self.rows = _pack(np.arange(words * 64) < len(keys))
        parts = body.reshape(-1, words) if words else body.reshape(0, 0)
        ends = np.cumsum(bits)
        # One list of slices per component, the lowest bit first.
        self.slices = [list(parts[e - n : e]) for n, e in zip(bits.tolist(), ends.tolist(), strict=True)]

    @staticmethod
    def build(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least value and number of bits of each component, and all slices one after the other."""
        words = -(-len(vectors) // 64)
        low = vectors.min(axis=0)
        above = np.zeros((words * 64, vectors.shape[1]), np.int64)
        above[: len(vectors)] = vectors - low
        bits = np.array([int(x).bit_length() for x in above.max(axis=0)], np.int64)
        parts = [_pack((above[:, d] >> k & 1).astype(bool)) for d, n in enumerate(bits) for k in range(n)]
        return low, bits, np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Sum of query[d] * row[d] over all d, as slices from the lowest and a constant."""
        # The shorter of both ends the product.
        constant = sum(q * low for q, low in zip(query.tolist(), self.low.tolist(), strict=False))
        columns: dict[int, list[np.ndarray]] = {}
        for q, parts in zip(query.tolist(), self.slices, strict=False):
            place = 0
            while q:
                # Signed digits without neighbours: the fewest slices to add.
                if q & 1:
                    digit = 2 - (q & 3)
                    q -= digit
                    for k, part in enumerate(parts):
                        column = columns.setdefault(place + k, [])
                        if digit > 0:
                            column.append(part)
                        else:
                            column.append(~part)
                            constant -= 1 << (place + k)
                q >>= 1
                place += 1
        out = []
        weight, top = 0, max(columns, default=-1)
        while weight <= top:
            column = columns.pop(weight, [])
            carries = columns.setdefault(weight + 1, [])
            while len(column) >= 3:
                a, b, c = column.pop(), column.pop(), column.pop()
                half = a ^ b
                column.append(half ^ c)
                carries.append((a & b) | (half & c))
            if len(column) == 2:
                a, b = column
                column = [a ^ b]
                carries.append(a & b)
            out.append(column[0] if column else np.zeros_like(self.rows))
            weight += 1
            if carries:
                top = max(top, weight)
        return out, constant

    def top(self, sums: list[np.ndarray], k: int, rows: np.ndarray) -> np.ndarray:
        """Places of the k rows with the largest sums among ``rows``; ties go to the first."""
        sure = np.zeros_like(rows)
        open_ = rows
        for part in reversed(sums):
            higher = open_ & part
            both = sure | higher
            n = int(np.bitwise_count(both).sum())
            if n > k:
                open_ = higher
            else:
                sure, open_ = both, open_ & ~part
                if n == k:
                    open_ = np.zeros_like(rows)
                    break
        places = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
        tied = np.flatnonzero(np.unpackbits(open_.view(np.uint8), bitorder="little"))
        return np.concatenate([places, tied[: k - len(places)]])

    def search(self, key: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and scores of the k best rows, without those of the query's own key."""
        rows = self.rows.copy()
        for place in range(*np.searchsorted(self.keys, [key, key + 1])):
            rows[place // 64] &= ~(np.uint64(1) << np.uint64(place % 64))
        sums, constant = self.scores(query)
        at = self.top(sums, k, rows)
        words, shifts = at // 64, (at % 64).astype(np.uint64)
        score = np.full(len(at), constant, np.int64)
        for weight, part in enumerate(sums):
            score += ((part[words] >> shifts) & np.uint64(1)).astype(np.int64) << weight
        return self.keys[at], score


def _matrix(lists: list, width: int) -> np.ndarray:
    """Rows of numbers as a matrix; missing components are 0."""
    out = np.zeros((len(lists), width), np.int64)
    for k, row in enumerate(lists):
        out[k, : len(row)] = row
    return out


def blocked(rows: DataFrame, size: int, parts: int, sliced: bool) -> DataFrame:
    """Blocks of up to ``size`` rows of ``key, q`` in key order: ``block, keys, width, body``, with
    ``low`` and ``bits`` and the body in slices if asked for."""
    schema = "block long, keys binary, width int, low binary, bits binary, body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int] = []
        vectors: list = []
        number = part = 0

        def block() -> pa.RecordBatch:
            width = max(map(len, vectors))
            body = _matrix(vectors, width)
            low, bits, body = Block.build(body) if sliced else (body[:0], body[:0], body)
            blobs = [x.astype("<u8" if x.dtype == np.uint64 else "<i8").tobytes() for x in (np.array(keys), low, bits, body)]
            row = [(part << 32) + number, blobs[0], width, *blobs[1:]]
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            names = [c.split()[0] for c in schema.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            for key, vector in zip(batch.column("key").to_pylist(), batch.column("q").to_pylist(), strict=True):
                keys.append(key)
                vectors.append(vector)
                if len(keys) == size:
                    yield block()
                    keys, vectors, number = [], [], number + 1
        if keys:
            yield block()

    dealt = rows.repartitionByRange(parts, "key").sortWithinPartitions("key", "q")
    dealt = dealt.select("key", "q", F.spark_partition_id().cast("long").alias("part"))
    return dealt.mapInArrow(run, schema)


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    row_block: int = ROW_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row the ``k`` other rows with the largest
    integer inner product, ties to the smaller key; fewer where there are fewer.

    ``is_query`` is a condition on the column ``key``. Vectors of unequal length count missing
    components as 0. Rows that repeat key and vector count once; a query passes over all rows of
    its key. Scores must fit 64 bits.
    """
    rows = stored(quantised(df, key, vector, scale), "vectors")
    n, asked = rows.agg(F.count("*"), F.count_if(is_query)).first()
    index = stored(blocked(rows, row_block, parts_for(n, row_block), True), "index")
    queries = stored(blocked(rows.filter(is_query), query_block, parts_for(asked, query_block), False), "queries")
    # A tile is one block of rows and one slice of the query blocks. Blocks of rows, which are
    # large, are copied once a slice; the small query blocks go to every block of rows and stream
    # past it. Slices are smaller where there are too few blocks of rows to occupy the cores.
    blocks = index.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    spare = min(parts_for(asked, query_block), parts_for(cores, max(1, blocks)))
    slices = max(parts_for(asked, query_block * SLICE_BLOCKS), spare)
    every = F.sequence(F.lit(0), F.lit(slices - 1))
    held = index.select("block", F.explode(every).alias("slice"), F.lit(0).alias("kind"), "keys", "low", "bits", "body")
    # One number for each block of rows.
    numbers = index.agg(F.collect_list("block")).scalar()
    slice_of = F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int").alias("slice")
    sent = queries.select(F.explode(numbers).alias("to"), slice_of, F.lit(1).alias("kind"), "keys", "low", "bits", "body")
    tiles = held.union(sent).repartition(max(1, blocks * slices), "block", "slice").sortWithinPartitions("block", "slice", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            for at in range(batch.num_rows):
                cell = batch.slice(at, 1).to_pylist()[0]
                if cell["kind"] == 0:  # the rows of the tile, ahead of its queries
                    parts = (("keys", "<i8"), ("low", "<i8"), ("bits", "<i8"), ("body", "<u8"))
                    block = Block(*(np.frombuffer(cell[c], t) for c, t in parts))
                    continue
                asked = np.frombuffer(cell["keys"], "<i8")
                mine = np.frombuffer(cell["body"], "<i8").reshape(len(asked), -1)
                found: list[list[np.ndarray]] = [[], [], []]
                for query, vector in zip(asked.tolist(), mine, strict=True):
                    keys, score = block.search(query, vector, k)
                    for column, values in zip(found, (np.full(len(keys), query, np.int64), keys, score), strict=True):
                        column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], ["query_id", "vec_id", "score"])

    best = tiles.select("kind", "keys", "low", "bits", "body").mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
WHERE rank <= 20
"""
