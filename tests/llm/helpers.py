"""Small inputs and plain re-computations for the tests of this folder."""

import random

import public_tokenizers
from tokenizers import Tokenizer

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
SPACES = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def split_words(text):
    """Runs of other characters than ASCII white space."""
    out, word = [], ""
    for c in text or "":
        if c in SPACES:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return [*out, word] if word else out


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts(n, seed=3):
    """Texts of pieces on which tokenizers tend to differ."""
    pieces = [
        "a", "B", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "é", "É", "Σ", "ς", "ß", "İ", "é", " ̈x",
        "1", "²", "\x1c", " ", "　", "中", "😀", "<|endoftext|>", "<|startoftext|>", "the", "!!", "###",
        "क़", "\r\n", "_", "\xa0", "ﬁ", "\x85", "ǅ", "aaaaaaa", "՘", "\U00010940",
    ]
    rng = random.Random(seed)
    return ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(n)]


def docs(spark, rows):
    """A documents table of (doc_id, text) or whole rows."""
    full = [(*r, *(None,) * (5 - len(r))) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
