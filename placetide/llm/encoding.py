"""Token ids of whole texts by the ``tokenizers`` library, with repeated words encoded once.

Both supported kinds of tokenizer never merge across the start of a word, so the ids of a text
are the ids of its pieces, cut before single spaces and line feeds, one after the other. Pieces
recur, so each task keeps the ids of those it has met and sends only new ones to the library.
Texts where a cut could change the ids go to the library whole.
Arrow's kernels cut the texts and number the pieces of a batch; Python sees different ones only.
"""

from __future__ import annotations

import json
import os
import string
from itertools import chain, compress, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words remembered by one task at most; beyond it those met only once are forgotten.
REMEMBERED = 600_000
# All white space there is, and the runs of it that a byte-level pattern splits by their length
# or that stand at an end.
_BLANK = "[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_RUNS = f"{_BLANK}{{3}}|{_BLANK}{{2}}\\z|^{_BLANK}"
# A run of these behind a word is a unit of its own for either pattern.
_MARKS = string.punctuation
# Different runs of marks remembered at a time.
TAILS = 10_000
# Letters below this one (Latin-1) lower-case one by one and are composed already.
_PLAIN_LETTERS = "\u0100"
# How byte-level vocabularies of this kind cut a text without ``_RUNS`` into units: white space
# that stands before no word of its line is a unit by the character, so none looks ahead.
UNITS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
# Both libraries agree on what is a letter below these.
_UNSETTLED = "[\\x{250}-\\x{10ffff}]"


class _Numbers(dict):
    """Numbers keys in the order of their first use."""

    def __missing__(self, key):
        number = len(self)
        self[key] = number
        return number


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte.

    Printable Latin-1 characters stand for themselves, the others take the code points from
    256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


def ranked_encoder(path: str):
    """A second encoder of the same ids, or None: for byte-level vocabularies that cut texts by
    the published pattern (``UNITS``) and number their tokens in the order of the merges that make
    them."""
    kind = json.loads(Path(path).read_text())
    cut, model = kind.get("pre_tokenizer") or {}, kind["model"]
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    if not plain or kind.get("normalizer") or model.get("type") != "BPE" or model.get("ignore_merges"):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocabulary, back = model["vocab"], {c: b for b, c in byte_alphabet().items()}
    made = [vocabulary.get("".join(m)) for m in merges]
    ordered = None not in made and made == list(range(256, 256 + len(made)))
    if not ordered or any(vocabulary.get(c, 256) >= 256 for c in back):
        return None
    import tiktoken

    ranks = {bytes(back[c] for c in token): number for token, number in vocabulary.items() if number < 256 + len(made)}
    return tiktoken.Encoding(Path(path).name, pat_str=UNITS, mergeable_ranks=ranks, special_tokens={})


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Stretches of an array, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class TextEncoder:
    """Ids of texts by a tokenizer file, as ``encode(text, add_special_tokens=False)`` gives them."""

    ranked = None

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.remembered = remembered
        # A normalizer that drops white space: words carry no space and may be cut at any.
        self.words_only = self.tokenizer.normalizer is not None
        self.alphabet = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})
        self.ranked = None if self.words_only else ranked_encoder(path)
        if self.ranked:
            size = self.ranked.max_token_value + 1
            self.widths = np.fromiter((len(self.ranked.decode_single_token_bytes(k)) for k in range(size)), np.int64, size)
        self.tails: dict[str, list[int]] = {}
        self.line = self._whole(["\n"])[0]
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.flat = np.zeros(0, np.uint32)
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _make_room(self) -> None:
        """Forget the words met once; all of them if too many were met more often."""
        often = self.uses > 1
        if 2 * int(often.sum()) > self.remembered:
            self._forget()
            return
        kept = _Numbers()
        for word in compress(self.numbers, often.tolist()):
            kept[word] = len(kept)
        self.numbers = kept
        self.flat = gather(self.flat, self.starts[often], self.lengths[often])
        self.lengths = self.lengths[often]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.uses = np.ones(len(kept), np.int64)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _tail(self, piece: str) -> tuple[str, list[int]]:
        """A piece without the marks at its end, and the ids of those; no ids if there are none or
        the piece must stay whole."""
        body = piece.rstrip(_MARKS)
        if len(body) == len(piece) or any(s in piece for s in self.special):
            return piece, []
        marks = piece[len(body) :]
        ids = self.tails.get(marks)
        if ids is None:
            if len(self.tails) >= TAILS:
                self.tails.clear()
            ids = self.tails[marks] = self._whole([marks])[0]
        return body, ids

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and how many each has; one that starts with a line feed has no space
        before it.

        A word of plain letters is one unit of the library's model, and so are the marks behind
        it; every other piece takes the library's whole way.
        """
        out: list[list[int]] = []
        rest = []
        model, words_only, alphabet = self.tokenizer.model.tokenize, self.words_only, self.alphabet
        space, line = "" if words_only else self.alphabet[ord(" ")], self.line
        for k, piece in enumerate(pieces):
            after_line = piece[:1] == "\n"
            word, tail = self._tail(piece[1:] if after_line else piece)
            if not word.isalpha() or words_only and not word.isascii() and max(word) >= _PLAIN_LETTERS:
                rest.append(k)
                out.append([])
                continue
            if words_only:
                word = word.lower()
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(alphabet)
            if after_line:
                out.append(line + [t.id for t in model(word)] + tail)
            else:
                out.append([t.id for t in model(space + word)] + tail)
        whole = [pieces[k] if words_only or pieces[k][:1] == "\n" else " " + pieces[k] for k in rest]
        for k, ids in zip(rest, self._whole(whole), strict=True):
            out[k] = ids
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.uint32, int(sizes.sum())), sizes

    def _ranked_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces by the second encoder, one after the other, and how many each has.

        No unit goes on behind a space or a line feed before it, so the pieces are encoded as one
        text, and the bytes of the ids tell where each ends.
        """
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(pieces)], pieces), " ")[0].as_py()
        ids = np.array(self.ranked.encode_ordinary((" " + joined).replace(" \n", "\n")), np.uint32)
        spaced = pc.invert(pc.starts_with(pieces, "\n")).to_numpy(zero_copy_only=False).astype(bool)
        ends = np.cumsum(pc.binary_length(pieces).to_numpy() + spaced)
        last = np.searchsorted(np.cumsum(self.widths[ids]), ends, side="right")
        return ids, np.diff(last, prepend=0)

    def _learn_whole(self, new: list[str]) -> None:
        """Add the ids of new pieces by the library's whole way."""
        out = self._whole([p if p[:1] == "\n" else " " + p for p in new])
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        ids = np.fromiter(chain.from_iterable(out), np.uint32, int(sizes.sum()))
        self.flat, self.lengths = np.concatenate([self.flat, ids]), np.concatenate([self.lengths, sizes])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])

    def _learn(self, new: list[str]) -> None:
        """Add the ids of new pieces. One that is a known or new piece and marks behind its last
        letter or digit, or that only differs in case where that is dropped, has that one's."""
        known, get = len(self.lengths), self.numbers.get
        direct, derived, bodies, tails = [], [], [], []
        for k, piece in enumerate(new):
            body, tail = self._tail(piece)
            # Lower-casing other letters can leave one that is no letter at the end.
            plain = not self.words_only or body.isascii() or max(body) < _PLAIN_LETTERS
            if self.words_only and plain and body.isalpha():
                body = body.lower()
            if plain and body != piece and body[-1:].isalnum():
                number = get(body)
                if number is not None:
                    derived.append(k)
                    bodies.append(number)
                    tails.append(tail)
                    continue
            direct.append(k)
        ids, sizes = self._pieces([new[k] for k in direct])
        flat = np.concatenate([self.flat, ids.astype(np.uint32, copy=False)])
        starts = np.concatenate([self.starts, np.zeros(len(new), np.int64)])
        lengths = np.concatenate([self.lengths, np.zeros(len(new), np.int64)])
        at = known + np.array(direct, np.int64)
        lengths[at] = sizes
        starts[at] = len(self.flat) + np.cumsum(sizes) - sizes
        if derived:
            # No body is derived itself: it ends in no mark, and its case is lower.
            body = np.array(bodies)
            behind = np.fromiter(map(len, tails), np.int64, len(tails))
            sizes = lengths[body] + behind
            ends = np.cumsum(sizes)
            more = np.empty(int(ends[-1]), np.uint32)
            last = np.arange(len(more)) >= np.repeat(ends - behind, sizes)
            more[last] = np.fromiter(chain.from_iterable(tails), np.uint32, int(behind.sum()))
            more[~last] = gather(flat, starts[body], lengths[body])
            at = known + np.array(derived, np.int64)
            lengths[at] = sizes
            starts[at] = len(flat) + ends - sizes
            flat = np.concatenate([flat, more])
        self.flat, self.starts, self.lengths = flat, starts, lengths
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])

    def _numbered(self, pieces: pa.Array, uses: np.ndarray) -> np.ndarray:
        """The numbers of different pieces met ``uses`` times; new ones are learnt."""
        known = len(self.numbers)
        used = pieces.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.numbers.__getitem__, used), np.int64, len(used))
        if len(self.numbers) > known:
            learn = self._learn_whole if self.ranked else self._learn
            learn(list(islice(self.numbers, known, None)))
        self.uses[numbers] += uses
        return numbers

    def _stretches(self, pieces: pa.Array, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, and where in it those of each of the different pieces begin and how many
        they are."""
        if not self.ranked:
            numbers = self._numbered(pieces, uses)
            return self.flat, self.starts[numbers], self.lengths[numbers]
        # The second encoder is as fast as looking pieces up, so only the others are remembered.
        mask = pc.match_substring_regex(pieces, _UNSETTLED)
        other = mask.to_numpy(zero_copy_only=False).astype(bool)
        flat, sizes = self._ranked_ids(pieces.filter(pc.invert(mask)))
        starts, lengths = (np.zeros(len(pieces), np.int64) for _ in range(2))
        starts[~other], lengths[~other] = np.cumsum(sizes) - sizes, sizes
        if other.any():
            numbers = self._numbered(pieces.filter(mask), uses[other])
            starts[other], lengths[other] = len(flat) + self.starts[numbers], self.lengths[numbers]
            flat = np.concatenate([flat, self.flat])
        return flat, starts, lengths

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has; NULL counts as empty."""
        if len(self.numbers) > self.remembered:
            self._make_room()
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if self.words_only:
            odd = np.zeros(len(column), bool)
            column = pc.replace_substring(column, "\n", " ")
        else:
            odd = pc.match_substring_regex(column, _RUNS).to_numpy(zero_copy_only=False).astype(bool)
            for token in self.special:
                odd |= pc.match_substring(column, token).to_numpy(zero_copy_only=False).astype(bool)
        whole = column.filter(pa.array(odd)).to_pylist() if odd.any() else []
        if not self.words_only:
            # What stands before the first word of a text and of each line is a line feed.
            column = pc.binary_join_element_wise("\n", pc.replace_substring(column, "\n", " \n"), "")
        if whole:
            column = pc.if_else(pa.array(odd), "\n" if not self.words_only else "", column)
        lists = pc.split_pattern(column, " ")
        pieces = lists.flatten().dictionary_encode()
        index = pieces.indices.to_numpy()
        known, starts, lengths = self._stretches(pieces.dictionary, np.bincount(index, minlength=len(pieces.dictionary)))
        lengths = lengths[index]
        sums = np.append(0, np.cumsum(lengths))
        flat = gather(known, starts[index], lengths)
        # Ids of each text: those of its pieces, without the line feed set before the first.
        last = np.cumsum(pc.list_value_length(lists).to_numpy())
        begins = sums[np.append(0, last[:-1])] if len(last) else last
        sizes = sums[last] - begins
        if not self.words_only:
            keep = np.ones(len(flat), bool)
            keep[begins] = False
            flat = flat[keep]
            sizes = sizes - 1
        if whole:
            encoded = self._whole(whole)
            more = [len(e) for e in encoded]
            flat = np.insert(flat, np.repeat(np.cumsum(sizes)[odd], more), list(chain.from_iterable(encoded)))
            sizes[odd] = more
        return flat, sizes


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> TextEncoder:
    """The task process's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path, remembered)
    return _encoders[path]
