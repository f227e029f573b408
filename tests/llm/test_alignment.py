"""Alignment of two tokenizers against the libraries on whole texts."""

import hashlib
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from helpers import BYTE, docs, odd_texts, plan
from tokenizers import Tokenizer

from placetide.llm import alignment
from placetide.llm.encoding import byte_alphabet

PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    first = Tokenizer.from_file(BYTE)
    first.encode_special_tokens = True
    back = {c: b for b, c in byte_alphabet().items()}
    second = sentencepiece.SentencePieceProcessor(model_file=PIECE)

    def tokens(text):
        if not text:
            return [], []
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        a = [(i, bytes(back[c] for c in first.id_to_token(i))) for i in a]
        b = [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("\u2581", " ").encode()) for i, p in ((i, second.id_to_piece(i)) for i in b)]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    return tokens


def brute(texts, tokens):
    made, links = [], []
    for text in texts:
        a, b = tokens(text)
        ends_a, ends_b = list(accumulate(len(x) for _, x in a)), list(accumulate(len(x) for _, x in b))
        groups, i, j, own = [], 0, 0, []
        for k, end in enumerate(ends_a):
            if end in set(ends_b):
                m = ends_b.index(end)
                groups.append(",".join(str(x) for x, _ in a[i : k + 1]) + "|" + ",".join(str(x) for x, _ in b[j : m + 1]))
                own.append((a[k][0], b[m][0]))
                i, j = k + 1, m + 1
        made.append((len(a), len(b), ";".join(groups), len(groups)))
        links.append(own)
    count = Counter(p for own in links for p in own)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [
        (n_a, n_b, n, len(own), sum(count[p] == most[p[1]] for p in own), sum(count[p] for p in own),
         hashlib.sha256(g.encode()).hexdigest() if n_a else "", g)
        for (n_a, n_b, g, n), own in zip(made, links, strict=True)
    ]


def same(spark, texts, tokens, **options):
    got = alignment.align(docs(spark, list(enumerate(texts))).repartition(3), BYTE, PIECE, **options)
    assert [tuple(r)[1:] for r in got.orderBy("doc_id").collect()] == brute(texts, tokens)


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 40, "remembered": 5}])
def test_odd_texts(spark, both, options):
    mark = "\u2581"
    texts = [None, "", " ", "  ", "a", " a", "a ", "\n a", "a  b   c", " \n b", f"a{mark}b", mark, "<s> </s> <unk> <0x41> <|endoftext|>", "a\r\n b", "\x00 \x1c b"]
    same(spark, texts + odd_texts(300, 11), both, **options)


def test_documents(spark, both, data_dir):
    rows = spark.read.parquet(f"{data_dir}/documents.parquet").orderBy("doc_id").select("text").limit(150).collect()
    same(spark, [r[0] for r in rows], both)


def test_very_long_text(spark, both):
    same(spark, ["x" * 30_000 + " " + "word " * 20_000 + "  " * 500, "word"], both)


def test_keys_and_other_columns(spark, both):
    rows = spark.createDataFrame([(None, "a b", 1, "x"), (3, "a b", 2, "y"), (3, None, 3, "z")], "id long, body string, n_a int, groups string")
    got = alignment.align(rows, BYTE, PIECE, "id", "body", keep_groups=False).collect()
    assert sorted((r["id"] is None, r["n_a"], r["count_sum"], r["groups"]) for r in got) == [(False, 0, 0, None), (False, 2, 4, None), (True, 2, 4, None)]
    assert alignment.align(docs(spark, []), BYTE, PIECE).count() == 0


def test_plan_has_no_cross_join(spark):
    text = plan(alignment.align(docs(spark, [(1, "a b")]), BYTE, PIECE))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
