"""Substring dedup: word passages that stand earlier in the corpus are cut out, by suffix automata.

Texts become chunks of documents. Every window of ``span`` words has an anchor, the smallest hash
among its shorter word runs, so equal windows have equal anchors wherever they stand; a stretch of
windows whose anchor stands at one place is a piece. Anchors are counted over the whole corpus (each chunk sends
its different ones and gets a byte for each back), and the pieces whose anchor occurs once need
nothing more. The others are dealt by anchor into reference shards of bounded size. A shard's
suffix automaton reads its pieces in corpus order: the matching statistic at a word is the length
of the longest passage ending there that the automaton has read before, and windows where it
reaches ``span`` stand earlier. Their words, joined to maximal spans, are removed.

Sending each shard's automaton to all documents would cost shards times documents, so a shard
meets only the pieces that hold its anchors; every equal window does, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetide.llm.shared import parts_for, slices, stored

SPAN = 20
# Words in the runs whose smallest hash is a window's anchor; fewer if the span is short.
ANCHOR = 8
CHUNK_BYTES = 4 << 20
# Windows in a piece at most: one bit of a mask each.
PIECE = 64
# An anchor found more often is dealt window by window.
HOT = 4096
# Words of one suffix automaton, about, and of the anchors and pieces of one part.
SHARD_WORDS = 1 << 14
COUNT_WORDS = 4 << 20
PART_WORDS = 1 << 20
BLOCK = 1 << 20
# Words of more bytes are hashed on their own.
LONG = 1 << 16

_MULTIPLIER = 0x9E3779B97F4A7C15
_DOCS = np.dtype([("valid", "u1"), ("key", "<i8"), ("tie", "<u8")])
_PIECES = np.dtype(
    [("anchor", "<u8"), ("valid", "u1"), ("key", "<i8"), ("tie", "<u8"), ("chunk", "<i8"), ("doc", "<u4"),
     ("start", "<i8"), ("n", "u1"), ("size", "<i8")]
)
_CUTS = np.dtype([("doc", "<u4"), ("start", "<i8"), ("n", "u1"), ("mask", "<u8")])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 and so on, modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_MULTIPLIER, BLOCK + LONG)
_DOWN = _powers(pow(_MULTIPLIER, -1, 1 << 64), BLOCK + LONG)


def word_hashes(body: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each word of a byte array, the same for equal words."""
    out = np.zeros(len(starts), np.uint64)
    long = np.flatnonzero(stops - starts > LONG)
    for k in long.tolist():
        out[k] = xxhash.xxh3_64_intdigest(body[starts[k] : stops[k]])
    short = np.delete(np.arange(len(starts)), long) if len(long) else slice(None)
    begin, end = starts[short], stops[short]
    hashes = np.empty(len(begin), np.uint64)
    a = 0
    while a < len(begin):
        low = int(begin[a])
        b = max(a + 1, int(np.searchsorted(begin, low + BLOCK)))
        piece = body[low : int(end[b - 1])].astype(np.uint64)
        piece += np.uint64(1)
        piece *= _UP[: len(piece)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(piece)])
        first = begin[a:b] - low
        hashes[a:b] = (sums[end[a:b] - low] - sums[first]) * _DOWN[first]
        a = b
    out[short] = _mixed(hashes)
    return out


class Chunk:
    """Some documents: their order keys, and their words, one space between, one line each."""

    def __init__(self, body: bytes, span: int):
        raw = zstandard.ZstdDecompressor().decompress(body)
        n = int.from_bytes(raw[:8], "little")
        self.docs = np.frombuffer(raw, _DOCS, n, 8)
        self.text = raw[8 + n * _DOCS.itemsize :]
        self.span = span
        flat = np.frombuffer(self.text, np.uint8)
        inside = np.zeros(len(flat) + 2, np.int8)
        inside[1:-1] = (flat != 10) & (flat != 32)
        edges = np.flatnonzero(np.diff(inside))
        self.starts, self.stops = edges[::2], edges[1::2]
        lines = np.flatnonzero(flat == 10)
        self.doc = np.searchsorted(lines, self.starts)
        self.sizes = np.bincount(self.doc, minlength=n)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.flat = flat

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, first window (numbered by its first word) and number of windows of every piece."""
        span, gram = self.span, min(ANCHOR, self.span)
        windows = len(self.starts) - span + 1
        empty = np.zeros(0, np.int64)
        if windows <= 0:
            return empty.astype(np.uint64), empty, empty
        words = word_hashes(self.flat, self.starts, self.stops)
        n = len(words) - gram + 1
        least = words[:n].copy()
        for k in range(1, gram):
            least *= np.uint64(_MULTIPLIER)
            least += words[k : n + k]
        least = _mixed(least)
        # The least of span - gram + 1 neighbours and the place of the first such, by doubling.
        place = np.arange(n)
        wide, want = 1, span - gram + 1
        while wide < want:
            step = min(wide, want - wide)
            right = least[step:] < least[:-step]
            place = np.where(right, place[step:], place[:-step])
            least = np.minimum(least[:-step], least[step:])
            wide += step
        at = np.flatnonzero(self.doc[:windows] == self.doc[span - 1 :])
        if not len(at):
            return empty.astype(np.uint64), empty, empty
        anchor, place = least[at], place[at]
        # Equal windows of one document have their anchors at different places.
        new = np.ones(len(at), bool)
        new[1:] = place[1:] != place[:-1]
        begin = np.flatnonzero(new)
        new |= (np.arange(len(at)) - begin[np.cumsum(new) - 1]) % PIECE == 0
        begin = np.flatnonzero(new)
        return anchor[begin], at[begin], np.diff(np.append(begin, len(at)))

    def words(self, start: int, n: int) -> bytes:
        return self.text[self.starts[start] : self.stops[start + n - 1]]


def chunks(df: DataFrame, key: str, text: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``chunk, n_words, body``: the documents in compressed chunks, in key order within one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def packed() -> pa.RecordBatch:
            held.sort()
            docs = np.array([h[:3] for h in held], _DOCS)
            body = b"\n".join([h[3] for h in held])
            raw = len(held).to_bytes(8, "little") + docs.tobytes() + body
            n = sum(h[4] for h in held)
            arrays = [pa.array([number]), pa.array([n]), pa.array([zstandard.ZstdCompressor(3).compress(raw)], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["chunk", "n_words", "body"])

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for name, body in zip(batch.column(0).to_pylist(), texts, strict=True):
                words = (body.as_py() or b"").split()
                line = b" ".join(words)
                tie = xxhash.xxh3_64_intdigest(line)
                held.append((0, 0, tie, line, len(words)) if name is None else (1, name, tie, line, len(words)))
                size += len(line) + 32
                if size >= chunk_bytes:
                    yield packed()
                    held, size, number = [], 0, number + 1
        if held:
            yield packed()

    return df.select(F.col(key).cast("long"), text).mapInArrow(run, "chunk long, n_words long, body binary")


def _own_anchors(chunk: Chunk, parts: int) -> tuple[np.ndarray, ...]:
    """A chunk's different anchors by part, their counts and parts, and the pieces with the place
    of each one's anchor among them."""
    anchor, start, n = chunk.pieces()
    own, place, counts = np.unique(anchor, return_inverse=True, return_counts=True)
    part = (_mixed(own) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return own[order], counts[order], part[order], rank[place], start, n


def _groups(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, begin and end of each run of equal values."""
    edges = np.flatnonzero(np.diff(values)) + 1
    for begin, end in zip([0, *edges.tolist()] if len(values) else [], [*edges.tolist(), len(values)], strict=False):
        yield int(values[begin]), begin, end


def anchor_codes(made: DataFrame, parts: int, span: int, hot: int) -> DataFrame:
    """``chunk, part, codes, n``: for each of a chunk's anchors in a part 0 if the corpus has it
    once, 1 if more often, 2 if more than ``hot`` times; ``n`` pieces have an anchor that repeats.

    A chunk sends an anchor once, so no anchor has more rows than there are chunks.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                own, counts, part, *_ = _own_anchors(Chunk(body.as_py(), span), parts)
                rows = [
                    (p, own[b:e].tobytes(), np.minimum(counts[b:e], 65535).astype("<u2").tobytes())
                    for p, b, e in _groups(part)
                ]
                if rows:
                    part_, own_, counts_ = zip(*rows, strict=True)
                    arrays = [pa.array(part_), pa.array([number] * len(rows)), pa.array(own_, pa.binary()), pa.array(counts_, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, ["part", "chunk", "own", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(part: int, held: list[tuple]) -> pa.RecordBatch:
            sizes = [len(h[2]) // 2 for h in held]
            own = np.frombuffer(b"".join(h[1] for h in held), "<u8")
            counts = np.frombuffer(b"".join(h[2] for h in held), "<u2").astype(np.int64)
            _, place = np.unique(own, return_inverse=True)
            total = np.bincount(place, counts)[place]
            codes = ((total > 1).astype(np.uint8) + (total > hot)).astype(np.uint8)
            edges = np.cumsum([0, *sizes])
            pieces = np.append(0, np.cumsum(np.where(codes > 0, counts, 0)))[edges]
            body = [codes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            arrays = [pa.array([h[0] for h in held]), pa.array([part] * len(held)), pa.array(body, pa.binary()), pa.array(np.diff(pieces))]
            return pa.RecordBatch.from_arrays(arrays, ["chunk", "part", "codes", "n"])

        now, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "chunk", "own", "counts")]
            for part, *row in zip(*columns, strict=True):
                if part != now and held:
                    yield told(now, held)
                    held = []
                now = part
                held.append(row)
        if held:
            yield told(now, held)

    sent = made.mapInArrow(send, "part long, chunk long, own binary, counts binary")
    dealt = sent.repartition(parts, "part").sortWithinPartitions("part", "chunk")
    return dealt.mapInArrow(count, "chunk long, part long, codes binary, n long")


class SuffixAutomaton:
    """All passages of the texts read so far; each state's longest one has ``length`` words."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _clone(self, state: int, length: int, before: int, word: int) -> int:
        """The part of a state with passages up to ``length`` becomes a state of its own."""
        made = len(self.length)
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        self.link[state] = made
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = made
            before = self.link[before]
        return made

    def _extend(self, last: int, word: int) -> int:
        """The state of the whole text so far, one word longer."""
        steps, link, length = self.next, self.link, self.length
        known = steps[last].get(word)
        if known is not None:
            if length[known] == length[last] + 1:
                return known
            return self._clone(known, length[last] + 1, last, word)
        made = len(length)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        while last >= 0 and word not in steps[last]:
            steps[last][word] = made
            last = link[last]
        if last >= 0:
            state = steps[last][word]
            if length[state] != length[last] + 1:
                state = self._clone(state, length[last] + 1, last, word)
            link[made] = state
        return made

    def read(self, words: list[int]) -> list[int]:
        """Add a text; for each of its words the length of the longest passage ending there that
        begins earlier, in a text read before or in this one."""
        steps, link, length = self.next, self.link, self.length
        last = state = matched = 0
        found = []
        for word in words:
            while state and word not in steps[state]:
                state = link[state]
                matched = length[state]
            after = steps[state].get(word)
            if after is None:
                matched = 0
            else:
                state, matched = after, matched + 1
            found.append(matched)
            last = self._extend(last, word)
            # The passage may have moved to a state split off from its own.
            while state and matched <= length[link[state]]:
                state = link[state]
        return found


def _numbered(names: dict[bytes, int], words: list[bytes]) -> list[int]:
    return [names.setdefault(w, len(names)) for w in words]


def _emit(parts: np.ndarray, records: np.ndarray, bodies: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Pieces by part: one row for each part, compressed."""
    order = np.argsort(parts, kind="stable")
    rows: list[tuple] = []
    for part, begin, end in _groups(parts[order]):
        mine = order[begin:end]
        raw = (end - begin).to_bytes(8, "little") + records[mine].tobytes() + b"".join([bodies[k] for k in mine.tolist()])
        rows.append((part, zstandard.ZstdCompressor(1).compress(raw)))
    if rows:
        part_, body = zip(*rows, strict=True)
        arrays = [pa.array(part_, pa.int64()), pa.nulls(len(rows), pa.int64()), pa.array(body, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "chunk", "body"])


def matched_pieces(made: DataFrame, codes: DataFrame, parts: int, out_parts: int, span: int) -> DataFrame:
    """``part, chunk, body``: the pieces whose anchor repeats, packed by part (``chunk`` NULL), and
    what a chunk has settled itself (``chunk`` set): pieces equal to an earlier one of its own.

    Pieces of hot anchors go window by window, dealt by the window's words, so an anchor never
    brings more than ``HOT`` pieces together, and equal windows come once from each chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body, told in zip(
                batch.column("chunk").to_pylist(), batch.column("body"), batch.column("told").to_pylist(), strict=True
            ):
                chunk = Chunk(body.as_py(), span)
                own, _, _, place, start, n = _own_anchors(chunk, parts)
                code = np.frombuffer(b"".join(t["codes"] for t in sorted(told or [], key=lambda t: t["part"])), np.uint8)
                code = code[place] if len(place) else np.zeros(0, np.uint8)
                seen: set[bytes] = set()
                kept: list[tuple] = []
                bodies: list[bytes] = []
                settled: list[tuple] = []
                chosen = np.flatnonzero(code)
                docs, firsts = chunk.doc, chunk.first
                for k in chosen.tolist():
                    at, count = int(start[k]), int(n[k])
                    doc = int(docs[at])
                    inside = at - int(firsts[doc])
                    words = chunk.words(at, count + span - 1)
                    if words in seen:
                        settled.append((doc, inside, count, (1 << count) - 1))
                        continue
                    seen.add(words)
                    if code[k] == 1:
                        kept.append((int(own[place[k]]), doc, inside, count))
                        bodies.append(words)
                        continue
                    mask = 0
                    for j in range(count):
                        window = chunk.words(at + j, span)
                        # The piece itself is its window if it has one only.
                        if window in seen and count > 1:
                            mask |= 1 << j
                        else:
                            seen.add(window)
                            kept.append((xxhash.xxh3_64_intdigest(window), doc, inside + j, 1))
                            bodies.append(window)
                    if mask:
                        settled.append((doc, inside, count, mask))
                if settled:
                    cuts = np.array(settled, _CUTS)
                    part = number % out_parts
                    arrays = [pa.array([part]), pa.array([number]), pa.array([cuts.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, ["part", "chunk", "body"])
                if kept:
                    records = np.zeros(len(kept), _PIECES)
                    anchor, doc_, inside_, count_ = zip(*kept, strict=True)
                    doc = np.array(doc_)
                    records["anchor"], records["doc"], records["start"], records["n"] = anchor, doc, inside_, count_
                    for c in ("valid", "key", "tie"):
                        records[c] = chunk.docs[c][doc]
                    records["chunk"] = number
                    records["size"] = [len(b) for b in bodies]
                    part = _mixed(records["anchor"] ^ np.uint64(_MULTIPLIER)) % np.uint64(out_parts)
                    yield from _emit(part.astype(np.int64), records, bodies)

    told = codes.groupBy("chunk").agg(F.collect_list(F.struct("part", "codes")).alias("told"))
    return made.join(told, "chunk").select("chunk", "body", "told").mapInArrow(run, "part long, chunk long, body binary")


def cuts(pieces: DataFrame, parts: int, span: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``chunk, cuts``: the pieces' windows that stand earlier, by suffix automata."""

    def judged(held: list[bytes]) -> dict[int, list[np.ndarray]]:
        records, texts = [], []
        for body in held:
            raw = zstandard.ZstdDecompressor().decompress(body)
            n = int.from_bytes(raw[:8], "little")
            record = np.frombuffer(raw, _PIECES, n, 8)
            records.append(record)
            edges = np.cumsum(np.append(0, record["size"])) + 8 + n * _PIECES.itemsize
            texts += [raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        record = np.concatenate(records)
        words = int(record["n"].sum()) + len(record) * (span - 1)
        shards = parts_for(words, shard_words)
        shard = _mixed(record["anchor"] + np.uint64(_MULTIPLIER)) % np.uint64(shards)
        # Corpus order within a shard: NULL keys first, then keys; equal keys by their whole text.
        order = np.lexsort([record[c] for c in ("start", "doc", "chunk", "tie", "key", "valid")] + [shard])
        masks = np.zeros(len(record), np.uint64)
        sizes = record["n"].tolist()
        now = -1
        for k, s in zip(order.tolist(), shard[order].tolist(), strict=True):
            if s != now:
                now, automaton = s, SuffixAutomaton()
                names: dict[bytes, int] = {}
                seen: set[bytes] = set()
            # A piece read before has its windows earlier without reading it again.
            if texts[k] in seen:
                masks[k] = (1 << sizes[k]) - 1
                continue
            seen.add(texts[k])
            found = automaton.read(_numbered(names, texts[k].split(b" ")))
            mask = 0
            for j, length in enumerate(found[span - 1 :]):
                if length >= span:
                    mask |= 1 << j
            masks[k] = mask
        hit = np.flatnonzero(masks)
        out = np.zeros(len(hit), _CUTS)
        for c in ("doc", "start", "n"):
            out[c] = record[c][hit]
        out["mask"] = masks[hit]
        chunk = record["chunk"][hit]
        order = np.argsort(chunk, kind="stable")
        return {c: [out[order[b:e]]] for c, b, e in _groups(chunk[order])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: list[bytes], settled: list[tuple]) -> Iterator[pa.RecordBatch]:
            found = [(c, x.tobytes()) for c, xs in (judged(held) if held else {}).items() for x in xs] + settled
            if found:
                number, body = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(body, pa.binary())], ["chunk", "cuts"])

        now, held, settled = None, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "chunk", "body")]
            for part, number, body in zip(*columns, strict=True):
                if part != now:
                    yield from rows(held, settled)
                    now, held, settled = part, [], []
                if number is None:
                    held.append(body)
                else:
                    settled.append((number, body))
        yield from rows(held, settled)

    dealt = pieces.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "chunk long, cuts binary")


def without_repeats(
    df: DataFrame, span: int = SPAN, key: str = "doc_id", text: str = "text", hot: int = HOT, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """``key, n_words, n_removed, kept, spans``: texts without the words of any window of ``span``
    words that starts earlier too (at a smaller key, or earlier in the same document).

    Words are runs of other characters than ASCII white space; ``kept`` holds the rest, one space
    between. ``spans`` are the maximal removed stretches as ``begin, end`` word numbers. NULL text
    has no words; texts of fewer words than ``span`` stay whole. A NULL key stays NULL and counts as
    the smallest; rows that repeat a key are ordered by a hash of their words, and one of fully
    equal rows stays. Other columns are left out. Windows are compared word by word; hashes only
    choose which are compared.
    """
    made = stored(chunks(df, key, text, chunk_bytes), "chunks")
    total = made.agg(F.sum("n_words")).first()[0] or 0
    parts = parts_for(total, COUNT_WORDS)
    codes = stored(anchor_codes(made, parts, span, hot), "codes")
    repeated = codes.agg(F.sum("n")).first()[0] or 0
    out_parts = parts_for(repeated * (span + span // 2), PART_WORDS)
    pieces = matched_pieces(made, codes, parts, out_parts, span)
    found = cuts(pieces, out_parts, span).groupBy("chunk").agg(F.collect_list("cuts").alias("cuts"))
    joined = made.join(found, "chunk", "left").select("body", "cuts")
    schema = "key long, n_words long, n_removed long, kept string, spans array<struct<begin:long,end:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, cut in zip(batch.column("body"), batch.column("cuts").to_pylist(), strict=True):
                yield _rest(Chunk(body.as_py(), span), b"".join(cut or []))

    return joined.mapInArrow(run, schema).withColumnRenamed("key", key)


def _rest(chunk: Chunk, cut: bytes) -> pa.RecordBatch:
    """What the cuts leave of a chunk's documents."""
    found = np.frombuffer(cut, _CUTS)
    bits = np.unpackbits(np.ascontiguousarray(found["mask"]).view(np.uint8).reshape(len(found), 8), axis=1, bitorder="little")
    which, bit = np.nonzero(bits)
    begin = chunk.first[found["doc"][which]] + found["start"][which] + bit
    n = len(chunk.starts)
    change = np.bincount(begin, minlength=n + 1) - np.bincount(begin + chunk.span, minlength=n + 1)
    gone = np.cumsum(change[:n]) > 0
    removed = np.add.reduceat(np.append(gone, False).astype(np.int64), np.minimum(chunk.first, n)) if len(chunk.first) else gone
    removed = np.where(chunk.sizes > 0, removed, 0)
    lines = chunk.text.split(b"\n")
    for doc in np.flatnonzero(removed).tolist():
        a = int(chunk.first[doc])
        keep = ~gone[a : a + int(chunk.sizes[doc])]
        lines[doc] = b" ".join(compress(lines[doc].split(b" "), keep.tolist())) if keep.any() else b""
    # Stretches of removed words, cut at the documents' edges.
    new = np.zeros(n + 1, bool)
    new[chunk.first[chunk.sizes > 0]] = True
    new[n] = True
    before = np.append(False, gone[:-1]) if n else gone
    opens = np.flatnonzero(gone & (~before | new[:n]))
    after = np.append(gone[1:], False) if n else gone
    closes = np.flatnonzero(gone & (~after | new[1:])) + 1
    doc = chunk.doc[opens]
    offsets = np.append(0, np.cumsum(np.bincount(doc, minlength=len(chunk.sizes))))
    pairs = pa.StructArray.from_arrays(
        [pa.array(opens - chunk.first[doc], pa.int64()), pa.array(closes - chunk.first[doc], pa.int64())], ["begin", "end"]
    )
    arrays = [
        pa.array(chunk.docs["key"], pa.int64(), mask=chunk.docs["valid"] == 0),
        pa.array(chunk.sizes, pa.int64()),
        pa.array(removed, pa.int64()),
        pa.array(lines, pa.binary()).cast(pa.string()),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["key", "n_words", "n_removed", "kept", "spans"])


SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS passage
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)
), repeats AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS i FROM repeats
), each AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
), kept AS (
  SELECT doc_id, count(g.i) AS n_removed, string_agg(CASE WHEN g.i IS NULL THEN word END, ' ' ORDER BY e.i) AS kept
  FROM each AS e LEFT JOIN gone AS g USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words AS w LEFT JOIN kept AS k ON k.doc_id = w.doc_id
"""
