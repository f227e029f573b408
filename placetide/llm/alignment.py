"""Alignment of two tokenizers: which of their tokens end together, and how often id pairs do.

A text is tokenized twice, by a byte-level vocabulary (with a space before the text) and by a piece
vocabulary (which adds the space itself). Each id list gets a dictionary from cumulative byte ends
to token numbers; the ends in both dictionaries cut the lists into groups, and the tokens that end
with a group are linked. Both vocabularies start a token at a space between words, so a text's
alignment is that of its words. A task aligns a word once, thousands of new ones in one run.

Pairs are counted over the corpus by chunks: a chunk sends its different pairs with their counts and
gets the totals of those pairs back, so a frequent pair is one row from each chunk.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import accumulate, chain, compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetide.llm.encoding import _BLANK, byte_alphabet, gather
from placetide.llm.shared import slices, stored

CHUNK_BYTES = 4 << 20
# Aligned words that a task remembers, and words aligned in one run.
REMEMBERED = 400_000
LEARNED = 8192
SPACE_MARK = "\u2581"

_blank = _BLANK.replace("\\x{", "{").replace("{85}", "\\x85").replace("{a0}", "\\xa0")
_blank = re.sub(r"\{([0-9a-f]{4})\}", r"\\u\1", _blank)
# A space that begins a word for either vocabulary: none before it, no white space behind it.
_CUT = re.compile(f"(?<! ) (?=[^{_blank[1:-1]}])")
# Texts where every space is such a cut.
_UNEVEN = re.compile(f"^{_blank}| {_blank}| $")


class Aligner:
    """Alignments of the words of a task, numbered in the order of their first use."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_path)
        self.first.no_truncation()
        self.first.no_padding()
        # Special tokens' strings in a text are plain text.
        self.first.encode_special_tokens = True
        back = {c: b for b, c in byte_alphabet().items()}
        vocabulary = self.first.get_vocab(with_added_tokens=True)
        self.first_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.first_bytes[number] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.second_bytes = [
            bytes([int(piece[3:5], 16)]) if self.second.is_byte(k) else piece.replace(SPACE_MARK, " ").encode()
            for k, piece in ((k, self.second.id_to_piece(k)) for k in range(self.second.get_piece_size()))
        ]
        self.digits = [str(k) for k in range(max(len(self.first_bytes), len(self.second_bytes)))]
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.groups: list[str] = []
        # Columns: first tokens, second tokens, groups, links, whether the bytes agree.
        self.sizes = np.zeros((0, 5), np.int64)
        # Linked pairs, both ids in one number.
        self.links = np.zeros(0, np.int64)
        self.begins = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def make_room(self, remembered: int) -> None:
        """Forget the words met once; all of them if too many were met more often."""
        often = self.uses > 1
        if 2 * int(often.sum()) > remembered:
            self.forget()
            return
        mask = often.tolist()
        self.numbers = {w: k for k, w in enumerate(compress(self.numbers, mask))}
        self.groups = list(compress(self.groups, mask))
        self.links = gather(self.links, self.begins[often], self.sizes[often, 3])
        self.sizes = self.sizes[often]
        self.begins = np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3]
        self.uses = np.ones(len(self.groups), np.int64)

    def learn(self, words: list[str]) -> None:
        """Align new words; they have their numbers already."""
        made = [self._learned(words[k : k + LEARNED]) for k in range(0, len(words), LEARNED)]
        for groups, _, _ in made:
            self.groups += groups
        self.sizes = np.concatenate([self.sizes, *(m[1] for m in made)])
        self.links = np.concatenate([self.links, *(m[2] for m in made)])
        self.begins = np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3]
        self.uses = np.append(self.uses, np.zeros(len(words), np.int64))

    def _learned(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Groups, sizes and linked pairs of words that each follow a space, all words in one run."""
        a = [e.ids for e in self.first.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
        b = self.second.encode(words, num_threads=1)
        sides = ((a, self.first_bytes), (b, self.second_bytes))
        whole = [b" " + w.encode() for w in words]
        good = np.ones(len(words), np.int64)
        for ids, spelt in sides:
            said = [b"".join(map(spelt.__getitem__, x)) for x in ids]
            if said != whole:
                good &= np.fromiter((x == y for x, y in zip(said, whole, strict=True)), np.int64, len(words))
        for ids, _ in sides:
            for k in np.flatnonzero(good == 0).tolist():
                ids[k] = []
        counts = [np.fromiter(map(len, ids), np.int64, len(ids)) for ids, _ in sides]
        flat = [list(chain.from_iterable(ids)) for ids, _ in sides]
        ends = [list(accumulate(map(len, map(spelt.__getitem__, x)))) for x, (_, spelt) in zip(flat, sides, strict=True)]
        # Where each list's last token ends that ends there; common ends cut both lists.
        places = [dict(zip(e, range(1, len(e) + 1), strict=True)) for e in ends]
        common = sorted(places[0].keys() & places[1].keys())
        cuts = [[place[end] for end in common] for place in places]
        digits = self.digits
        said_a, said_b = (list(map(digits.__getitem__, x)) for x in flat)
        groups = []
        from_a = from_b = 0
        for to_a, to_b in zip(*cuts, strict=True):
            left = said_a[from_a] if to_a - from_a == 1 else ",".join(said_a[from_a:to_a])
            groups.append(f"{left}|{said_b[from_b] if to_b - from_b == 1 else ','.join(said_b[from_b:to_b])}")
            from_a, from_b = to_a, to_b
        # The tokens that end with a group: usually one of either list, more if some have no bytes.
        first = [np.searchsorted(np.array(e, np.int64), common) for e in ends]
        ended = [np.array(c, np.int64) - f for c, f in zip(cuts, first, strict=True)]
        times = ended[0] * ended[1]
        group = np.repeat(np.arange(len(common)), times)
        k = np.arange(len(group)) - (np.cumsum(times) - times)[group]
        first_id = np.array(flat[0], np.int64)[first[0][group] + k // ended[1][group]]
        second_id = np.array(flat[1], np.int64)[first[1][group] + k % ended[1][group]]
        # Every word ends at a common end.
        word_ends = np.cumsum(good * np.fromiter(map(len, whole), np.int64, len(whole)))
        word = np.searchsorted(word_ends, common)
        n_groups = np.bincount(word, minlength=len(words))
        n_links = np.bincount(word, times, minlength=len(words)).astype(np.int64)
        cut = np.cumsum(n_groups)
        joined = [";".join(groups[x:y]) for x, y in zip((cut - n_groups).tolist(), cut.tolist(), strict=True)]
        return joined, np.stack([*counts, n_groups, n_links, good], axis=1), first_id << 32 | second_id

    def words(self, text: str) -> list[str]:
        """The words of a text, without the space before each."""
        if not _UNEVEN.search(text):
            return text.split(" ")
        parts = _CUT.split(" " + text)
        # The first part holds the added space unless a cut stands there.
        return parts[1:] if parts[0] == "" else [parts[0][1:], *parts[1:]]


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(byte_path: str, piece_path: str) -> Aligner:
    if (byte_path, piece_path) not in _aligners:
        _aligners[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _aligners[byte_path, piece_path]


def _chunk(aligner: Aligner, names: pa.Array, texts: list[str | None], number: int, keep_groups: bool) -> pa.RecordBatch:
    """One row: the documents' sizes and groups, and their pairs by number in the chunk."""
    known, fresh = aligner.numbers, []
    used: list[np.ndarray] = []
    for text in texts:
        words = aligner.words(text) if text else []
        get = known.get
        numbers = [get(w, -1) for w in words]
        if -1 in numbers:
            for k, n in enumerate(numbers):
                if n < 0:
                    n = known.get(words[k])
                    if n is None:
                        n = known[words[k]] = len(known)
                        fresh.append(words[k])
                    numbers[k] = n
        used.append(np.array(numbers, np.int64))
    if fresh:
        aligner.learn(fresh)
    lengths = np.array([len(u) for u in used])
    flat = np.concatenate(used) if used else np.zeros(0, np.int64)
    aligner.uses += np.bincount(flat, minlength=len(aligner.uses))
    ends = np.cumsum(lengths)
    each = np.empty((len(used), 5), np.int64)
    for column in range(5):
        sums = np.append(0, np.cumsum(aligner.sizes[flat, column]))
        each[:, column] = sums[ends] - sums[ends - lengths]
    # A text whose bytes come out otherwise has no tokens.
    good = (each[:, 4] == lengths) & (lengths > 0)
    each[~good] = 0
    groups, digests = [], []
    for k, u in enumerate(used):
        joined = ";".join([aligner.groups[n] for n in u.tolist()]) if good[k] else ""
        digests.append(hashlib.sha256(joined.encode()).hexdigest() if good[k] else "")
        groups.append(joined if keep_groups else None)
    flat = flat[np.repeat(good, lengths)]
    link = gather(aligner.links, aligner.begins[flat], aligner.sizes[flat, 3]) if len(flat) else np.zeros(0, np.int64)
    own, place = np.unique(link, return_inverse=True)
    doc = np.repeat(np.arange(len(used)), each[:, 3])
    width = max(len(own), 1)
    mixed, count = np.unique(doc * width + place, return_counts=True)
    doc, place = np.divmod(mixed, width)
    totals = np.bincount(place, count, minlength=len(own)).astype(np.int64)

    def listed(array: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array)

    columns = [
        pa.array([number]),
        listed(names),
        pa.array([each[:, :4].astype("<i8").tobytes()]),
        listed(pa.array(digests, pa.string())),
        listed(pa.array(groups, pa.string())),
        pa.array([np.bincount(doc, minlength=len(used)).astype("<i8").tobytes()]),
        pa.array([place.astype("<u4").tobytes()]),
        pa.array([count.astype("<u4").tobytes()]),
        listed(pa.array(own >> 32, pa.int32())),
        listed(pa.array(own & 0xFFFFFFFF, pa.int32())),
        listed(pa.array(totals, pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _CHUNKS.split(", ")])


_CHUNKS = (
    "chunk long, names array<bigint>, sizes binary, digests array<string>, groups array<string>, "
    "links binary, places binary, counts binary, a array<int>, b array<int>, n array<bigint>"
)


def aligned_chunks(
    df: DataFrame, byte_path: str, piece_path: str, key: str, text: str, keep_groups: bool, chunk_bytes: int, remembered: int
) -> DataFrame:
    """Both tokenizers' alignments of all texts, some texts in a row; see ``_CHUNKS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        aligner = _aligner(byte_path, piece_path)
        for piece in slices(batches, text, chunk_bytes):
            if len(aligner.numbers) > remembered:
                aligner.make_room(remembered)
            yield _chunk(aligner, piece.column(0), piece.column(1).to_pylist(), number, keep_groups)
            number += 1

    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, _CHUNKS)


def pair_counts(made: DataFrame) -> DataFrame:
    """``a, b, n``: how many links of the corpus hold each id pair."""
    each = made.select("chunk", F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("chunk", "p.*")
    return each.groupBy("a", "b").agg(F.sum("n").alias("n"))


def align(
    df: DataFrame,
    byte_path: str,
    piece_path: str,
    key: str = "doc_id",
    text: str = "text",
    keep_groups: bool = True,
    chunk_bytes: int = CHUNK_BYTES,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups`` for every row.

    ``groups`` are both id lists cut where tokens of both end, as ``a1,a2|b1;a3|b2,b3`` (NULL unless
    ``keep_groups``). A link is a pair of tokens that end together; its count says how many links
    of the corpus hold that id pair, ``count_sum`` adds the counts of a text's links, and ``n_best``
    counts those whose count is the highest of all pairs with the same second id. A text that is
    NULL or empty, or whose tokens do not spell it out, has no tokens: zeros and empty strings. A
    NULL key stays NULL, rows that repeat a key are texts of their own, other columns are left out.
    """
    made = stored(aligned_chunks(df, byte_path, piece_path, key, text, keep_groups, chunk_bytes, remembered), "aligned")
    counts = stored(pair_counts(made), "pairs")
    # One row for each id of the second vocabulary.
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    judged = counts.join(best, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    own = made.select("chunk", F.posexplode(F.arrays_zip("a", "b")).alias("pos", "p")).select("chunk", "pos", "p.*")
    back = own.join(judged, ["a", "b"]).groupBy("chunk").agg(F.collect_list(F.struct("pos", "n", "best")).alias("back"))
    columns = ["names", "sizes", "digests", "groups", "links", "places", "counts", "back"]
    joined = made.join(back, "chunk", "left").select(*columns)
    schema = (
        "key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string, groups string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                names, sizes, digests, groups, links, places, count, back = (batch.column(c)[row] for c in columns)
                size = np.frombuffer(sizes.as_py(), "<i8").reshape(-1, 4)
                total, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if back.is_valid:
                    pos, n, good = back.values.flatten()
                    order = np.argsort(pos.to_numpy())
                    total = n.to_numpy()[order]
                    best = good.to_numpy(zero_copy_only=False)[order].astype(np.int64)
                place = np.frombuffer(places.as_py(), "<u4")
                times = np.frombuffer(count.as_py(), "<u4").astype(np.int64)
                ends = np.append(0, np.cumsum(np.frombuffer(links.as_py(), "<i8")))
                sums = [np.append(0, np.cumsum(times * x[place])) for x in (best, total)]
                n_best, count_sum = (s[ends[1:]] - s[ends[:-1]] for s in sums)
                arrays = [names.values, *(pa.array(size[:, k]) for k in range(4)), pa.array(n_best), pa.array(count_sum)]
                arrays += [digests.values, groups.values]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])

    return joined.mapInArrow(run, schema).withColumnRenamed("key", key)
