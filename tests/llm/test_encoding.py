import json
from pathlib import Path

import numpy as np
import pytest
from helpers import BYTE, WORD, library, odd_texts

from placetide.llm.bpe import BytePairs, PairEncoder
from placetide.llm.encoding import TextEncoder, ranked_encoder

LONG = ["", "a" * 3000, "ab" * 2000, " " * 500, "\n" * 7, "中文" * 800, "the\n    def x():\n\t\treturn 1\n" * 50]


@pytest.mark.parametrize(("kind", "path"), [(TextEncoder, BYTE), (TextEncoder, WORD), (PairEncoder, BYTE)])
def test_ids_equal_the_library_s(kind, path):
    coder, expected = kind(path, remembered=500), library(path)
    texts = odd_texts(4000) + LONG
    for k in range(0, len(texts), 300):
        part = texts[k : k + 300]
        flat, sizes = coder.encode(part)
        at = 0
        for text, size in zip(part, sizes.tolist(), strict=True):
            assert flat[at : at + size].tolist() == expected(text), repr(text)
            at += size
        assert at == len(flat)


def test_no_texts():
    flat, sizes = TextEncoder(BYTE).encode([])
    assert len(flat) == 0 and len(sizes) == 0
    flat, sizes = PairEncoder(BYTE).encode(["", ""])
    assert sizes.tolist() == [0, 0]


def test_decoding_gives_the_bytes_back():
    pairs, coder = BytePairs(BYTE), PairEncoder(BYTE)
    for text in odd_texts(500, seed=9) + LONG:
        ids, _ = coder.encode([text])
        assert pairs.decode(ids).decode() == text


def test_merge_rounds_take_the_leftmost_of_overlapping_pairs():
    pairs = BytePairs(BYTE)
    expected = library(BYTE)
    for n in range(1, 40):
        ids, sizes = pairs.merge([b"a" * n, b"", b"o" * n])
        assert sizes[1] == 0
        assert ids.tolist() == expected("a" * n) + expected("o" * n)
    assert pairs.merge([])[0].dtype == np.int64


def test_second_encoder_takes_only_vocabularies_in_merge_order(tmp_path):
    assert ranked_encoder(BYTE) is not None and ranked_encoder(WORD) is None
    kind = json.loads(Path(BYTE).read_text())
    vocabulary = kind["model"]["vocab"]
    a, b = (t for t, n in vocabulary.items() if n in (300, 301))
    vocabulary[a], vocabulary[b] = vocabulary[b], vocabulary[a]
    other = tmp_path / "other.json"
    other.write_text(json.dumps(kind))
    assert ranked_encoder(str(other)) is None
    letters = "".join(chr(c) for c in range(0x21, 0x250))
    texts = [f"{letters[k]} {letters[k : k + 3]}'s {letters[k]}1" for k in range(len(letters) - 3)]
    expected = library(BYTE)
    flat, sizes = TextEncoder(BYTE).encode(texts)
    assert flat.tolist() == [i for t in texts for i in expected(t)] and len(sizes) == len(texts)


class Counted:
    """A second encoder that counts its calls."""

    def __init__(self, coder):
        self.coder, self.calls = coder, 0

    def encode_ordinary(self, text):
        self.calls += 1
        return self.coder.encode_ordinary(text)


def test_second_encoder_takes_all_pieces_in_one_call():
    coder, expected = TextEncoder(BYTE), library(BYTE)
    coder.ranked = Counted(coder.ranked)
    texts = [" ".join(f"word{k}x{j}, naïve" for j in range(40)) + f"\nline{k} “quoted” слово" for k in range(30)]
    for _ in range(2):
        flat, sizes = coder.encode(texts)
        assert flat.tolist() == [i for t in texts for i in expected(t)] and len(sizes) == len(texts)
    assert coder.ranked.calls == 2
    # Pieces that it does not take are remembered.
    assert set(coder.numbers) == {"“quoted”", "слово"} and coder.uses.tolist() == [60, 60]


def test_white_space_at_borders_of_pieces():
    blanks = [" ", "\n", "\t", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u2028", "\u3000"]
    ends = ["a", "1", "!", "'s", "é", "中", ""]
    texts = [f"{a}{x}{y}{b}{x}" for x in blanks for y in [*blanks, ""] for a in ends for b in ends]
    expected = library(BYTE)
    # All in one call, so that pieces of different texts lie side by side.
    flat, sizes = TextEncoder(BYTE).encode(texts)
    wanted = [expected(t) for t in texts]
    assert sizes.tolist() == [len(w) for w in wanted] and flat.tolist() == [i for w in wanted for i in w]
