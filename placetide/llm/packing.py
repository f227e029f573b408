"""Lexical retrieval packing: training windows filled with related documents.

Texts become token ids once. Token document frequencies over the whole corpus give the BM25
weights. Documents are range-partitioned by a lexical anchor (the smallest hash of their
tokens, so like documents lie together), which splits a group of any size, and each task packs
its range shard by shard, mostly in one: a shard of bounded size gets an inverted index, and each seed
document asks it for the unused documents that score best. They fill the seed's window one
after the other; the last one is cut at the window's end and its rest seeds the next window. Full
windows inside a long document are cut off first. Only the end of a range can leave a window
unfilled; it is split into windows of a power of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetide.llm.encoding import encoder
from placetide.llm.shared import slices, stored

WINDOW = 2048
# Tokens in a shard, at most, and in a task's range, about: as a rule a range is one shard.
SHARD_TOKENS = 1 << 22
RANGE_TOKENS = 1 << 21
# BM25 constants.
K1 = 1.2
B = 0.75
# A term in one of so many documents of a shard or more has a row of all their weights.
DENSE = 8
# Bytes of text encoded at a time; the arrays made meanwhile take some twenty times as many.
STEP = 2 << 20
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "window long, tokens binary"
)


def _hashes(size: int) -> np.ndarray:
    """A fixed hash of every token id."""
    x = np.arange(size, dtype=np.uint64) + np.uint64(1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(1)


def tokenized(
    df: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text", id_bytes: int = 4
) -> DataFrame:
    """``key, n, anchor, tokens``: the ids of each text and ``end_id``, little-endian, in
    ``id_bytes`` bytes each. NULL text counts as empty, so every row has one id at least.

    Each task adds one row with ``n`` 0: in how many of its documents each id occurs (64 bits
    each), which spares a second pass over all tokens.
    """
    kind = np.dtype(f"<u{id_bytes}")
    names = ["key", "n", "anchor", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        hashes = _hashes(1 << 17)
        found, place = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for piece in slices(batches, text, STEP):
            flat, sizes = encode(piece.column(text))
            top = max(int(flat.max()) if len(flat) else 0, end_id)
            if top > np.iinfo(kind).max:
                raise ValueError(f"token ids need more than {id_bytes} bytes")
            if top >= len(found):
                found = np.concatenate([found, np.zeros(top + 1 - len(found), np.int64)])
                place = np.zeros(len(found), np.int64)
            # The end id behind each document.
            ends = np.cumsum(sizes)
            flat = np.insert(flat, ends, end_id).astype(np.int64)
            narrow = flat.astype(kind)
            ends = ends + np.arange(1, len(ends) + 1)
            at = np.arange(len(flat))
            anchors = []
            bodies = []
            begin = 0
            for end in ends.tolist():
                ids = flat[begin:end]
                # Each different id once: where it stands last.
                place[ids] = at[begin:end]
                used = ids[place[ids] == at[begin:end]]
                found[used] += 1
                anchors.append(int(hashes[used].min()))
                bodies.append(narrow[begin:end].tobytes())
                begin = end
            arrays = [piece.column(key).cast(pa.int64()), pa.array(sizes + 1), pa.array(anchors, pa.int64()), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names)
        counts = [pa.array([None], pa.int64()), pa.array([0]), pa.array([0]), pa.array([found.astype("<i8").tobytes()])]
        yield pa.RecordBatch.from_arrays(counts, names)

    return df.select(key, text).mapInArrow(run, "key long, n long, anchor long, tokens binary")


def token_frequencies(tokens: DataFrame) -> dict[int, int]:
    """In how many documents each token id occurs, over all rows; the vocabulary bounds it."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("tokens"):
                found = np.frombuffer(body.as_buffer(), "<i8")
                used = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used])], ["id", "n"])

    parts = tokens.filter("n = 0").select("tokens").mapInArrow(spread, "id long, n long")
    return {r["id"]: r["n"] for r in parts.groupBy("id").agg(F.sum("n").alias("n")).collect()}


class Shard:
    """BM25 inverted index of some documents: postings of one term lie side by side. Those of a
    frequent term are a row with a weight for every document, 0 where it does not occur; rows
    add up faster than postings, and all of them have ``DENSE`` times as many cells at most.
    """

    def __init__(self, bodies: list[np.ndarray], idf: np.ndarray, average: float):
        terms, docs, counts = [], [], []
        for number, ids in enumerate(bodies):
            term, count = np.unique(ids, return_counts=True)
            good = idf[term] > 0
            terms.append(term[good])
            docs.append(np.full(int(good.sum()), number))
            counts.append(count[good])
        self.bags = terms
        term, doc = np.concatenate(terms), np.concatenate(docs)
        tf = np.concatenate(counts).astype(np.float32)
        length = np.array([len(b) for b in bodies], np.float32)[doc]
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))
        self.size = len(bodies)
        found = np.bincount(term, minlength=len(idf))
        dense = found * DENSE >= max(self.size, 1)
        dense &= found > 0
        # The row of each frequent term, -1 for the others.
        self.row = np.where(dense, np.cumsum(dense) - 1, -1)
        often = dense[term]
        self.rows = np.zeros((int(dense.sum()), self.size), np.float32)
        self.rows[self.row[term[often]], doc[often]] = weight[often]
        term, doc, weight = term[~often], doc[~often], weight[~often]
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = doc[order], weight[order].astype(np.float64)
        self.first = np.append(0, np.cumsum(np.bincount(term, minlength=len(idf))))

    def keep(self, wanted: np.ndarray) -> None:
        """Leave out the documents that are not ``wanted``, in the order of the others; every
        document can still be a seed."""
        good = wanted[self.docs]
        self.first = np.append(0, np.cumsum(good))[self.first]
        self.docs, self.weights = (np.cumsum(wanted) - 1)[self.docs[good]], self.weights[good]
        self.rows = self.rows[:, wanted]
        self.size = int(wanted.sum())

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document in the index for the distinct terms of the seed."""
        bag = self.bags[seed]
        row = self.row[bag]
        often = self.rows[row[row >= 0]].sum(axis=0)
        bag = bag[row < 0]
        begin = self.first[bag]
        lengths = self.first[bag + 1] - begin
        ends = np.cumsum(lengths)
        at = np.repeat(begin - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
        return often + np.bincount(self.docs[at], self.weights[at], minlength=self.size)


def _windows(total: int, window: int) -> list[int]:
    """Sizes of the windows that hold ``total`` ids: full ones, then powers of two."""
    sizes = [window] * (total // window)
    rest = total % window
    return sizes + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


class _Packer:
    """Fills windows with pieces, in order."""

    def __init__(self, window: int):
        self.window = window
        self.open: list[tuple[int, int, int]] = []  # document, start, length
        self.filled = 0

    def add(self, doc: int, start: int, length: int) -> Iterator[list[tuple[int, int, int]]]:
        """Put ids of a document in; yields each window that becomes full."""
        while length:
            take = min(length, self.window - self.filled)
            self.open.append((doc, start, take))
            self.filled += take
            start, length = start + take, length - take
            if self.filled == self.window:
                yield self.open
                self.open, self.filled = [], 0

    def rest(self) -> Iterator[list[tuple[int, int, int]]]:
        """What is left, in windows of powers of two."""
        pieces, self.open = self.open, []
        sizes = _windows(self.filled, self.window)
        self.filled = 0
        for size in sizes:
            out = []
            while size:
                doc, start, length = pieces.pop(0)
                take = min(size, length)
                out.append((doc, start, take))
                if take < length:
                    pieces.insert(0, (doc, start + take, length - take))
                size -= take
            yield out


def pack_shard(
    bodies: list[np.ndarray], idf: np.ndarray, average: float, packer: _Packer
) -> Iterator[list[tuple[int, int, int]]]:
    """Windows of a shard's documents as (number, start, length); what does not fill one stays in
    the packer. Every id lies in one piece."""
    index = Shard(bodies, idf, average)
    # A long document's full windows come first; they need no neighbour.
    begins = np.zeros(index.size, np.int64)
    sizes = np.array([len(b) for b in bodies])
    for doc in np.flatnonzero(sizes >= packer.window):
        own = _Packer(packer.window)
        begins[doc] = sizes[doc] // packer.window * packer.window
        yield from own.add(int(doc), 0, int(begins[doc]))
    unused = sizes > begins
    left = int(unused.sum())
    follow = 0
    # The documents in the index: used ones leave it when they are a quarter.
    inside = np.arange(index.size)
    while left:
        if left <= 0.75 * index.size:
            wanted = unused[inside]
            index.keep(wanted)
            inside = inside[wanted]
        if packer.open and packer.open[-1][0] >= 0:
            seed = packer.open[-1][0]  # the rest of the document that the last window cut
        else:
            while not unused[follow]:
                follow += 1
            seed = follow
            unused[seed] = False
            left -= 1
            yield from packer.add(seed, int(begins[seed]), int(sizes[seed] - begins[seed]))
            if not packer.open:
                continue
        scores = np.where(unused[inside], index.scores(seed), -1.0)
        # Best first; of equal scores the first document.
        for doc in inside[np.argsort(-scores, kind="stable")[:left]]:
            unused[doc] = False
            left -= 1
            full = False
            for window in packer.add(int(doc), int(begins[doc]), int(sizes[doc] - begins[doc])):
                full = True
                yield window
            if full:
                break


def pack(
    df: DataFrame,
    path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    range_tokens: int = RANGE_TOKENS,
    id_bytes: int = 4,
    keep_tokens: bool = True,
) -> DataFrame:
    """Pieces of all texts: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    window, tokens``.

    ``start`` is the piece's place among its document's ids, ``offset`` its place in the
    sequence; ``window`` is the sequence's size and ``tokens`` the ids as little-endian 32 bits
    (NULL unless ``keep_tokens``). ``id_bytes`` is the width of ids on their way between tasks.
    NULL text is empty and has its end id only; a NULL key is kept as NULL; rows that repeat a
    key are documents of their own. Sequence ids are distinct, not gapless.
    """
    made = stored(tokenized(df, path, end_id, key, text, id_bytes), "tokens")
    frequencies = token_frequencies(made)
    tokens = made.filter("n > 0")
    kind = np.dtype(f"<u{id_bytes}")
    rows, total = tokens.agg(F.count("*"), F.sum("n")).first()
    total = total or 0
    size = max(frequencies, default=0) + 1
    found = np.zeros(size)
    found[list(frequencies)] = list(frequencies.values())
    # Positive for every term that occurs: all of them have postings, however frequent.
    idf = np.where(found > 0, np.log(1 + (rows - found + 0.5) / (found + 0.5)), 0.0).astype(np.float32)
    average = max(1.0, total / max(1, rows))
    ranges = max(1, -(-total // range_tokens))
    dealt = tokens.repartitionByRange(ranges, "anchor", "key", "n").sortWithinPartitions("anchor", "key", "tokens")
    dealt = dealt.select("key", "tokens", F.spark_partition_id().cast("long").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(window)
        number = 0
        held: dict[int, tuple[int | None, np.ndarray]] = {}
        part = 0

        def emitted(windows: Iterator[list[tuple[int, int, int]]], keys: list, bodies: list) -> Iterator[pa.RecordBatch]:
            nonlocal number
            columns: list[list] = [[] for _ in range(9)]
            for pieces in windows:
                offset, size = 0, sum(p[2] for p in pieces)
                for doc, start, length in pieces:
                    whole, name = (bodies[doc], keys[doc]) if doc >= 0 else held[doc][::-1]
                    ids = whole[start : start + length].astype("<u4").tobytes()
                    row = (name, start, length, zlib.crc32(ids), len(whole), (part << 32) + number, offset, size)
                    row = (*row, ids if keep_tokens else None)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += length
                number += 1
            if columns[0]:
                kinds = [pa.int64()] * 8 + [pa.binary()]
                names = [c.split()[0] for c in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        def shard(keys: list, bodies: list) -> Iterator[pa.RecordBatch]:
            nonlocal held
            yield from emitted(pack_shard(bodies, idf, average, packer), keys, bodies)
            # The open window's pieces go on into the next shard under numbers below 0.
            kept = {}
            moved = []
            for k, (doc, start, length) in enumerate(packer.open):
                kept[-1 - k] = (keys[doc], bodies[doc]) if doc >= 0 else held[doc]
                moved.append((-1 - k, start, length))
            held, packer.open = kept, moved

        keys, bodies, size = [], [], 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            for name, body in zip(batch.column("key").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                ids = np.frombuffer(body, kind)
                if bodies and size + len(ids) > shard_tokens:
                    yield from shard(keys, bodies)
                    keys, bodies, size = [], [], 0
                keys.append(name)
                bodies.append(ids)
                size += len(ids)
        if bodies:
            yield from shard(keys, bodies)
        yield from emitted(packer.rest(), [], [])

    return dealt.mapInArrow(run, PIECES)
