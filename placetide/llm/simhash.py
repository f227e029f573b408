"""SimHash near-duplicates by bit-sliced comparison of fingerprints.

Fingerprints are compared within groups that agree on two of five bit ranges: of three or fewer
differing bits two ranges at least are free, so no link is missed. Inside a group the
fingerprints stand as 64 bit planes; the distances of many pairs are counted at once by
carry-save adders on whole words, and pairs are given up as soon as none in their words can be
near. A group larger than a block is cut into blocks and every pair of blocks is a unit of its
own, so no task holds a group. Units return a spanning forest of their links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetide.llm.components import components
from placetide.llm.shared import free_name, marked, slices, stored

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
# Fingerprints in a block, and rows of small groups that are compared in one go.
BLOCK = 2048
TOGETHER = 512
# Queries whose distances are counted at a time.
QUERIES = 64
STEP = 4 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint: a bit is set if over half of the shingles' hashes have it.

    A-Z are lower-cased; words are runs without ASCII white space; a text with fewer words than
    a shingle is one shingle, and without any word the fingerprint is 0.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*[words[k:] for k in range(shingle)], strict=False))
    n = len(words) - shingle + 1
    hashes = np.fromiter((xxh64_intdigest(g, SEED) for g in grams), np.uint64, n)
    counts = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    over = 2 * counts.sum(axis=0, dtype=np.int64) > n
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Every row with ``print`` (signed 64 bits, a free name) in place of ``text``."""
    keep = [c for c in df.columns if c != text]
    name = free_name(keep, "print")
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text, STEP):
            prints = np.array([fingerprint(t, shingle) for t in piece.column(text).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in keep), pa.array(prints.view(np.int64))], [*keep, name]
            )

    return df.select(*keep, text).mapInArrow(run, schema)


def planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes: 64 rows of words, in which bit j of word w belongs to fingerprint 64 w + j."""
    padded = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in left and right whose fingerprints differ in ``radius`` bits or fewer, in parts.

    Each counter bit of all pairs lies in a word of its own: two planes and the lowest counter
    bit go through a full adder and the carries ripple up; a pair whose count leaves the
    counter is out for good. Rows of pairs that are all out are dropped every eight planes.
    """
    up = planes(right)
    counters = max(1, radius.bit_length())
    valid = np.zeros(up.shape[1] * 64, bool)
    valid[: len(right)] = True
    idle = ~np.packbits(valid, bitorder="little").view("<u8")
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for begin in range(0, len(left), QUERIES):
        rows = np.arange(begin, min(begin + QUERIES, len(left)))
        mine = left[rows].astype(np.uint64)
        count = [np.zeros((len(rows), up.shape[1]), np.uint64) for _ in range(counters)]
        out = np.repeat(idle[None, :], len(rows), axis=0)
        for bit in range(0, BITS, 2):
            x, y = (
                up[b][None, :] ^ (((mine >> np.uint64(b)) & np.uint64(1)) * full)[:, None] for b in (bit, bit + 1)
            )
            low = count[0]
            half = low ^ x
            carry = (low & x) | (half & y)
            count[0] = half ^ y
            for k in range(1, counters):
                count[k], carry = count[k] ^ carry, count[k] & carry
            out |= carry
            if bit % 8 == 6:
                live = (out != full).any(axis=1)
                if not live.all():
                    rows, mine, out = rows[live], mine[live], out[live]
                    count = [c[live] for c in count]
                if not len(rows):
                    break
        if not len(rows):
            continue
        # What the counter holds, 2^k - 1 at most, may still exceed the radius.
        over = np.zeros_like(out)
        same = np.full_like(out, full)
        for k in reversed(range(counters)):
            if radius >> k & 1:
                same &= count[k]
            else:
                over |= same & count[k]
                same &= ~count[k]
        hits = ~(out | over)
        a, b = np.nonzero(np.unpackbits(hits.view(np.uint8), axis=1, bitorder="little"))
        yield rows[a], b


class _Forest:
    """Union-find over the rows at hand."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _links(unit: np.ndarray, side: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the near pairs within each unit; rows are grouped by unit.

    A row of side 0 meets every row of its unit; the rows of side 1 do not meet each other.
    """
    forest, found = _Forest(len(unit)), []
    root = np.arange(len(unit))
    firsts = np.flatnonzero(side == 0)
    for a, b in near_pairs(prints[firsts], prints, radius):
        a = firsts[a]
        # Within a unit only, each pair once, and not what is joined already.
        fits = (unit[a] == unit[b]) & ((a < b) | (side[b] == 1)) & (root[a] != root[b])
        for x, y in zip(a[fits].tolist(), b[fits].tolist(), strict=True):
            if forest.join(x, y):
                found.append((x, y))
        if fits.any():
            root = np.fromiter(map(forest.find, range(len(unit))), np.int64, len(unit))
    at = np.array(found, np.int64).reshape(-1, 2)
    return prints[at[:, 0]], prints[at[:, 1]]


def near_links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``a, b``: links between distinct fingerprints (``print``) whose components are those of
    all pairs at ``radius`` bits or fewer."""
    ranges = radius + 2
    edges = [BITS * k // ranges for k in range(ranges + 1)]
    tables = list(combinations(range(ranges), 2))
    masks = [sum(((1 << (edges[r + 1] - edges[r])) - 1) << edges[r] for r in t) for t in tables]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.explode(
        F.array(*[F.struct(F.lit(t).alias("t"), F.col("print").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(signed)])
    )
    rows = prints.select("print", keys.alias("x")).select("x.t", "x.k", "print")
    sizes = rows.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    rows = rows.join(sizes, ["t", "k"]).withColumn("blocks", blocks)
    mine = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", mine)
    # The row goes to the unit of its block and of each other one; the lower block is side 0.
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = rows.select(
        F.xxhash64("t", "k", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "print",
    )
    # A unit holds two blocks at most; its parts may arrive in any order.
    dealt = units.repartition("unit").sortWithinPartitions("unit", "side", "print")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            unit, side, print_ = (np.concatenate([h[k] for h in held]) for k in range(3))
            starts = np.append(np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]), len(unit))
            # The last unit may go on in the next batch.
            ends = starts[1:] if last else starts[1:-1]
            begin = 0
            while begin < (ends[-1] if len(ends) else 0):
                # As many whole units as fit together, one at least.
                fit = ends[(ends > begin) & (ends <= begin + TOGETHER)]
                end = int(fit[-1]) if len(fit) else int(ends[ends > begin][0])
                a, b = _links(unit[begin:end], side[begin:end], print_[begin:end], radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
                begin = end
            held, size = ([(unit[begin:], side[begin:], print_[begin:])], len(unit) - begin) if begin < len(unit) else ([], 0)

        for batch in batches:
            unit, side, print_ = (batch.column(k).to_numpy() for k in range(3))
            if batch.num_rows:
                held.append((unit, side, print_.view(np.uint64)))
                size += batch.num_rows
                yield from flush(False)
        if held:
            yield from flush(True)

    return dealt.mapInArrow(run, "a long, b long")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Every row's ``key``, ``print`` and ``component``: the smallest key that can be reached over
    fingerprints at ``radius`` bits or fewer, its own included.

    NULL and empty texts have fingerprint 0 and are linked like any other. A NULL key takes no
    part in the smallest key; a component of such rows alone has NULL. Repeated rows are kept.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    prints = stored(fingerprints(rows, "text", shingle), "prints")
    least = prints.groupBy("print").agg(F.min("key").alias("least"))
    found = components(near_links(least.select("print"), radius))
    rooted = least.join(found, least["print"] == found["node"], "left")
    rooted = stored(rooted.select("print", "least", F.coalesce("root", "print").alias("root")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return prints.join(rooted.join(smallest, "root").select("print", "component"), "print").select("key", "print", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that of the smallest key, with the columns it came with.

    Of rows that share this key the one whose text sorts first stays. Rows whose key is NULL
    cannot be named and stay.

    Texts do not move: bits of the hashes of the keys that may stay, and of those that may go, tell
    every row its fate where it lies. Only rows that have both bits are joined with their key's.
    """
    found = classes(docs.filter(F.col(key).isNotNull()), key, text)
    link, n = free_name(docs.columns, "_kept"), free_name(docs.columns, "_n")
    # In how many rows of a key it is the smallest of its component: all rows of a key with one stay.
    least = F.count(F.when(F.col("key") == F.col("component"), 1))
    keys = stored(found.groupBy(F.col("key").alias(link)).agg(least.alias(n)), "kept")
    rows, stays = marked(docs, [F.col(key)], keys.filter(F.col(n) > 0).select(link))
    rows, goes = marked(rows, [F.col(key)], keys.filter(F.col(n) != 1).select(link))
    sure = rows.filter(F.col(key).isNull() | ~F.col(goes)).select(*docs.columns)
    unsure = rows.filter(F.col(key).isNotNull() & F.col(stays) & F.col(goes)).select(*docs.columns)
    chosen = lambda k: unsure.join(keys.filter(k).select(link).hint("merge"), F.col(key) == F.col(link)).select(*docs.columns)
    rank = free_name(docs.columns, "_rank")
    order = Window.partitionBy(key).orderBy(text)
    repeated = chosen(F.col(n) > 1).withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1)
    return sure.unionByName(chosen(F.col(n) == 1)).unionByName(repeated.select(*docs.columns))
