"""Ranked lexical search: exact best documents by range maxima over posting lists.

Texts are reduced once to the query terms they hold, with counts; document frequencies come from
the same pass. Tasks then build bounded shards: for each query term a posting list of impacts (the
term's share of a document's score) and over all lists one sparse table of range maxima, so the
largest impact of any list within any stretch of documents is two look-ups away. A query starts
with the interval of all documents of the shard. The sum of its lists' maxima bounds every score
inside; the best-bounded intervals are opened first, scored at the document that holds the
largest of those maxima and split there, until no interval can hold a better document.

All numbers are 64-bit integers and the bounds are exact, so the ranking is that of scoring every
document.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placetide.llm.shared import stored

# Queries that share one pass over the documents.
QUERY_BLOCK = 1024
# Postings in one shard, about.
SHARD_POSTINGS = 1 << 19
# Intervals opened together.
OPENED = 32

# Fixed values of the score.
HALF = 50
SCALE = 1_000_000_000
FACTOR = 20

# What is no ASCII letter or digit and no other character parts terms; A-Z are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return (text or b"").translate(_TERM_BYTES).split()


def term_counts(df: DataFrame, terms: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n, terms, counts``: how many terms each text has, and which of the wanted ones how often.

    Texts without a term are left out. Each task adds a row with ``n`` 0 that says in how many of
    its texts each wanted term occurs.
    """
    names = ["key", "n", "terms", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(terms), np.int64)
        get = terms.get
        for batch in batches:
            keys, sizes, bags, counts = [], [], [], []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                words = terms_of(body.as_py())
                if not words:
                    continue
                tally = Counter(map(get, words))
                tally.pop(None, None)
                bag = np.fromiter(tally.keys(), "<u4", len(tally))
                found[bag] += 1
                keys.append(name)
                sizes.append(len(words))
                bags.append(bag.tobytes())
                counts.append(np.fromiter(tally.values(), "<u4", len(tally)).tobytes())
            arrays = [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names)
        row = [pa.nulls(1, pa.int64()), pa.array([0]), pa.array([b""]), pa.array([found.astype("<i8").tobytes()])]
        yield pa.RecordBatch.from_arrays(row, names)

    return df.select(F.col(key).cast("long"), text).mapInArrow(run, "key long, n long, terms binary, counts binary")


def document_frequencies(made: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each wanted term occurs; one number for each query term."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                found = np.frombuffer(body.as_py(), "<i8")
                used = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used])], ["term", "n"])

    parts = made.filter("n = 0").select("counts").mapInArrow(spread, "term long, n long")
    out = np.zeros(terms, np.int64)
    for r in parts.groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def weights(documents: int, frequencies: np.ndarray) -> np.ndarray:
    """Integer weight of each term."""
    w = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequencies]
    return np.array(w, np.int64)


def impacts(weight: np.ndarray, counts: np.ndarray, sizes: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term that occurs ``counts`` times adds to the score of a text of ``sizes`` terms."""
    length = 100 - HALF + HALF * sizes * documents // max(total, 1)
    return weight * (SCALE * counts // (1000 * counts + FACTOR * length))


class Shard:
    """Posting lists of some documents, numbered in key order, and their range maxima."""

    def __init__(self, documents: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        good = impact > 0
        term, doc, impact = term[good], doc[good], impact[good]
        order = np.lexsort([doc, term])
        self.size = documents
        self.doc, self.impact = doc[order], impact[order]
        # One sorted number for each posting, to find a document's place in a list.
        self.place = term[order] * (documents + 1) + self.doc
        # Maxima carry the place where they stand, the first one of equal impacts.
        self.bits = max(1, len(order).bit_length())
        self.mask = (1 << self.bits) - 1
        level = (self.impact << self.bits) | (self.mask - np.arange(len(order)))
        longest = int(np.bincount(term).max()) if len(term) else 0
        self.levels = [level]
        width = 1
        while 2 * width <= longest:
            level = level.copy()
            level[:-width] = np.maximum(level[:-width], level[width:])
            self.levels.append(level)
            width *= 2
        self.table = np.stack(self.levels)

    def maxima(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Largest packed impact of each stretch ``left <= posting < right``, -1 for empty ones."""
        size = right - left
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        a = np.minimum(left, len(self.doc) - 1)
        b = np.maximum(right - (1 << level.astype(np.int64)), 0)
        return np.where(size > 0, np.maximum(self.table[level, a], self.table[level, b]), -1)

    def best(self, terms: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """``score, document`` of the best documents, equal scores by number; none below ``floor``."""
        if not len(self.doc) or not len(terms):
            return []
        base = terms * (self.size + 1)
        # Best so far, the worst first: higher scores and smaller numbers are better.
        top: list[tuple[int, int]] = []
        kept: list[tuple] = []
        heap: list[tuple[int, int, int]] = []

        def offer(low: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            """Put the intervals that can hold a wanted document on the heap."""
            packed = self.maxima(left, right)
            share = np.where(packed >= 0, packed >> self.bits, 0)
            bound = share.sum(axis=1)
            choice = packed[np.arange(len(packed)), share.argmax(axis=1)]
            split = self.doc[np.where(choice >= 0, self.mask - (choice & self.mask), 0)]
            worst = top[0] if len(top) == k else (max(floor, 1), -self.size)
            for row in np.flatnonzero(bound >= worst[0]).tolist():
                heapq.heappush(heap, (-int(bound[row]), int(low[row]), len(kept)))
                kept.append((int(split[row]), left[row], right[row]))

        left = np.searchsorted(self.place, base)
        right = np.searchsorted(self.place, base + self.size)
        offer(np.zeros(1, np.int64), left[None], right[None])
        while heap:
            opened = []
            while heap and len(opened) < OPENED:
                bound, low, row = heapq.heappop(heap)
                # Nothing left is better than the worst one kept.
                if len(top) == k and (-bound, -low) <= top[0]:
                    if -bound < top[0][0]:
                        heap.clear()
                    kept[row] = None
                    continue
                opened.append((low, *kept[row]))
                kept[row] = None
            if not opened:
                continue
            low, split, left, right = (np.array(c) for c in zip(*opened, strict=True))
            middle = np.searchsorted(self.place, base[None] + split[:, None])
            at = np.minimum(middle, len(self.doc) - 1)
            hit = (middle < right) & (self.doc[at] == split[:, None])
            score = np.where(hit, self.impact[at], 0).sum(axis=1)
            for s, d in zip(score.tolist(), split.tolist(), strict=True):
                if s < floor or s <= 0:
                    continue
                if len(top) < k:
                    heapq.heappush(top, (s, -d))
                elif (s, -d) > top[0]:
                    heapq.heapreplace(top, (s, -d))
            offer(np.concatenate([low, split + 1]), np.concatenate([left, middle + hit]), np.concatenate([middle, right]))
        return sorted(((s, -d) for s, d in top), key=lambda x: (-x[0], x[1]))


def _ranked(
    made: DataFrame, queries: list[tuple[int, np.ndarray]], weight: np.ndarray, documents: int, total: int, k: int,
    floors: dict[int, int], shard_postings: int, first_only: bool = False,
) -> DataFrame:
    """``query, key, score``: the best documents of every shard for each query, by range maxima.

    ``first_only`` leaves it at the first task's first shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answers(held: list[tuple]) -> pa.RecordBatch:
            # Key order: NULL first.
            held.sort(key=lambda h: (h[0] is not None, h[0] or 0))
            sizes = np.array([len(h[2]) for h in held])
            doc = np.repeat(np.arange(len(held)), sizes)
            term = np.concatenate([h[2] for h in held]).astype(np.int64)
            counts = np.concatenate([h[3] for h in held]).astype(np.int64)
            lengths = np.array([h[1] for h in held], np.int64)[doc]
            shard = Shard(len(held), term, doc, impacts(weight[term], counts, lengths, documents, total))
            rows = [
                (q, held[d][0], s) for q, bag in queries for s, d in shard.best(bag, k, floors.get(q, 0))
            ]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "key", "score"])

        held: list[tuple] = []
        size = 0
        if first_only and TaskContext.get().partitionId():
            return
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "n", "terms", "counts")]
            for name, n, terms, counts in zip(*columns, strict=True):
                if terms:
                    held.append((name, n, np.frombuffer(terms, "<u4"), np.frombuffer(counts, "<u4")))
                    size += len(terms) // 4
                if size >= shard_postings:
                    yield answers(held)
                    held, size = [], 0
                    if first_only:
                        return
        if held:
            yield answers(held)

    return made.mapInArrow(run, "query long, key long, score long")


def search(
    documents: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "doc_id",
    text: str = "text",
    query_key: str = "item_id",
    query_text: str = "text",
    query_block: int = QUERY_BLOCK,
    shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """``query_key, rank, key, score``: each query's ``k`` best documents with a score above 0.

    Equal scores go by ascending key, a NULL key first. NULL or empty texts have no terms: such
    documents count nowhere, such queries have no rows. Rows that repeat a document's key are
    documents of their own, rows that repeat a query's key queries of their own. Other columns are
    left out. The queries are read in blocks of ``query_block``; each block takes one pass. The first
    task's first shard is searched beforehand: its ``k``-th score is one that every query's ``k`` best
    reach anyway, which spares the other shards work.
    """
    spark = documents.sparkSession
    out = None
    block: list[tuple] = []

    def answered(rows: list[tuple]) -> DataFrame:
        terms: dict[bytes, int] = {}
        bags = [
            (q, np.array(sorted({terms.setdefault(t, len(terms)) for t in terms_of((body or "").encode())}), np.int64))
            for q, (_, body) in enumerate(rows)
        ]
        made = stored(term_counts(documents, terms, key, text), "term_counts")
        frequencies = document_frequencies(made, len(terms))
        texts = made.filter("n > 0")
        found, total = texts.agg(F.count("*"), F.sum("n")).first()
        weight = weights(found, frequencies)
        args = (bags, weight, found, total or 0, k)
        look = _ranked(texts, *args, {}, shard_postings, first_only=True)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("key"))
        placed = look.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)
        floors = {r["query"]: r["score"] for r in placed.collect()}
        best = _ranked(texts, *args, floors, shard_postings)
        ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = [r[0] for r in rows]
        return ranked.select(
            F.get(F.array(*[F.lit(n).cast("long") for n in names]), F.col("query").cast("int")).alias(query_key),
            "rank", F.col("key").alias(key), "score",
        )

    for row in queries.select(F.col(query_key).cast("long"), query_text).toLocalIterator():
        block.append(tuple(row))
        if len(block) == query_block:
            made = answered(block)
            out, block = made if out is None else out.unionAll(made), []
    if block or out is None:
        made = answered(block) if block else None
        if made is None:
            return spark.createDataFrame([], f"{query_key} long, rank int, {key} long, score long")
        out = made if out is None else out.unionAll(made)
    return out


SQL = r"""
WITH terms AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), sizes AS (
  SELECT doc_id, len(w) AS n FROM terms WHERE len(w) > 0
), corpus AS (
  SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS total FROM sizes
), counts AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM terms) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, corpus GROUP BY term, documents
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scores AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // total)))) AS BIGINT) AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""
