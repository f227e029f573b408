"""Byte-level BPE by batched numpy merge rounds.

Texts are cut into words by the published pattern. The symbols of many different words stand in
one flat array; in each round the rank of every neighbouring pair is found by binary search over
the sorted pair keys, each word's lowest-ranked pair is merged wherever it stands, and words
without a pair to merge are done. Words met before keep their ids.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetide.llm.encoding import TextEncoder, _Numbers, byte_alphabet, gather
from placetide.llm.shared import free_name, slices

# The published pattern that cuts text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.iinfo(np.int64).max
STEP = 2 << 20
# Different pieces remembered by one task at most.
REMEMBERED = 300_000
# A character that no class of the pattern names: it stands for unassigned ones.
_STAND_IN = "￿"


class BytePairs:
    """Vocabulary, merges and special tokens of a byte-level tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        back = {c: b for b, c in byte_alphabet().items()}
        vocab = data["model"]["vocab"]
        self.size = max([*vocab.values(), *(t["id"] for t in data["added_tokens"])]) + 1
        texts = [b""] * self.size
        for token, number in vocab.items():
            texts[number] = bytes(back[c] for c in token)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        for content, number in self.special.items():
            texts[number] = content.encode()
        # Bytes of every token, one after the other, for decoding.
        self.lengths = np.fromiter(map(len, texts), np.int64, self.size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.of_byte = np.array([vocab[c] for _, c in sorted(byte_alphabet().items())], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.words = regex.compile(PATTERN)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs by binary search; NO_RANK where there is no merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        if len(symbols):
            rank = np.full(len(symbols), NO_RANK)
            rank[:-1] = np.where(word[:-1] == word[1:], self._rank(symbols[:-1], symbols[1:]), NO_RANK)
        while len(symbols):
            begins = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, begins)
            counts = np.diff(np.append(begins, len(symbols)))
            each = np.repeat(lowest, counts)
            over = each == NO_RANK
            if over.any():
                done.append((word[over], symbols[over]))
                symbols, word, rank, each = symbols[~over], word[~over], rank[~over], each[~over]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == each)
            # In a run of overlapping pairs every second one merges, from the left.
            heads = np.r_[True, at[1:] != at[:-1] + 1]
            run = np.maximum.accumulate(np.where(heads, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            # Only pairs with a merged symbol have new ranks.
            changed = np.zeros(len(symbols) + 1, bool)
            changed[moved[at]] = True
            changed[moved[at] - 1] = True  # -1 is the spare place at the end
            fresh = np.flatnonzero(changed[:-1])
            inner = fresh[fresh + 1 < len(symbols)]
            same = word[inner] == word[inner + 1]
            rank[fresh] = NO_RANK
            inner = inner[same]
            rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        word, symbols = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))

    def cut(self, text: str) -> list[str]:
        """The words of a text, by the pattern.

        The library knows the characters of an earlier Unicode version than the pattern's
        engine; later ones count as neither letter, digit nor space there.
        """
        if text.isascii() or max(text) < "԰":
            return self.words.findall(text)
        plain = "".join(c if c.isascii() or unicodedata.category(c) != "Cn" else _STAND_IN for c in text)
        return [text[m.start() : m.end()] for m in self.words.finditer(plain)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        return gather(self.bytes, self.starts[ids], self.lengths[ids]).tobytes()


class PairEncoder(TextEncoder):
    """Texts to ids like :class:`TextEncoder`, with the words merged here, not by the library."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.pairs = BytePairs(path)
        self.special = list(self.pairs.special)
        self.remembered = remembered
        self.words_only = False
        self.tails = {}
        self._forget()

    def _forget(self) -> None:
        super()._forget()
        self.words = _Numbers()
        self.word_ids = np.zeros(0, np.int64)
        self.word_sizes = np.zeros(0, np.int64)

    def _make_room(self) -> None:
        super()._make_room()
        # The pieces kept have their ids; words of new ones are numbered anew.
        self.words = _Numbers()
        self.word_ids = np.zeros(0, np.int64)
        self.word_sizes = np.zeros(0, np.int64)

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        known = len(self.words)
        index = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        if len(self.words) > known:
            new = [w.encode() for w in islice(self.words, known, None)]
            ids, sizes = self.pairs.merge(new)
            self.word_ids = np.concatenate([self.word_ids, ids])
            self.word_sizes = np.concatenate([self.word_sizes, sizes])
        starts = np.cumsum(self.word_sizes) - self.word_sizes
        return gather(self.word_ids, starts[index], self.word_sizes[index]), self.word_sizes[index]

    def _whole(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts; special tokens in them are single ids and split the text."""
        import regex

        ordered = sorted(self.special, key=len, reverse=True)
        split = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        out: list[list[int]] = []
        for text in texts:
            ids: list[int] = []
            for part in split.split(text) if split else [text]:
                number = self.pairs.special.get(part)
                ids.extend(self._merged(self.pairs.cut(part))[0].tolist() if number is None else [number])
            out.append(ids)
        return out

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words: list[str] = []
        counts: list[int] = []
        for piece in pieces:
            if piece.isalpha():  # one word by the pattern, with the space before it
                words.append(" " + piece)
                counts.append(1)
            else:
                cut = self.pairs.cut(piece if piece[:1] == "\n" else " " + piece)
                words.extend(cut)
                counts.append(len(cut))
        flat, sizes = self._merged(words)
        if not counts:
            return flat, sizes
        ends = np.cumsum(counts)
        return flat, np.add.reduceat(sizes, ends - counts)


_encoders: dict[str, PairEncoder] = {}


def _encoder(path: str) -> PairEncoder:
    if path not in _encoders:
        _encoders[path] = PairEncoder(path)
    return _encoders[path]


def round_trip(df: DataFrame, path: str, text: str = "text", keep_ids: bool = True) -> DataFrame:
    """Every row with ``ids`` (little-endian 32 bits) and ``decoded`` in place of ``text``.

    NULL text counts as empty. Without ``keep_ids`` the row has ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256`` instead. Extra columns stay; a taken name gets a leading underscore.
    """
    keep = [c for c in df.columns if c != text]
    wanted = ["ids", "decoded"] if keep_ids else ["n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = [T.BinaryType(), T.StringType()] if keep_ids else [T.LongType(), T.StringType(), T.StringType()]
    names: list[str] = []
    for name in wanted:
        names.append(free_name([*keep, *names], name))
    fields = [T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]
    schema = T.StructType([df.schema[c] for c in keep] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(path)
        for piece in slices(batches, text, STEP):
            flat, sizes = coder.encode(piece.column(text))
            rows = []
            at = 0
            for size in sizes.tolist():
                ids = flat[at : at + size]
                at += size
                body = ids.astype("<u4").tobytes()
                decoded = coder.pairs.decode(ids).decode("utf-8", "replace")
                if keep_ids:
                    rows.append((body, decoded))
                else:
                    digest = hashlib.sha256(decoded.encode()).hexdigest()
                    rows.append((size, hashlib.sha256(body).hexdigest(), digest))
            types = [pa.binary(), pa.string()] if keep_ids else [pa.int64(), pa.string(), pa.string()]
            added = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), *added], [*keep, *names])

    return df.select(*keep, F.col(text)).mapInArrow(run, schema)
