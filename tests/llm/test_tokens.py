"""Token counts and SentencePiece ids against the libraries."""

import random

import numpy as np
import sentencepiece
from awkward_rows import awkward, clashing  # noqa: F401
from conftest import TESTDATA
from tokenizers import Tokenizer

from cinetally.llm import pieces, token_counts

ODD = [
    "", " ", "   a", "a   b", " " * 15 + "x", " " * 31, " " * 45 + "z", "a\n\tb  c é 漢 😀\x00<s></s>", "\n\n", "\n a\n  b",
    "▁▁a▁", "a" * 300, "the" * 50, "﻿​", "é é", "<0x0A>", "\r\n", "\U0010ffff a", "1" * 500, "²." * 3 + "a.b²",
    "ΑΣ ΣΑΣ", "İstanbul", "a<|endoftext|>b <|startoftext|>", "don't 'S we'll", "1234 ①②", "ᄀ ᅡ", "a b\u0085c\x1cd",
]


def test_counts_are_those_of_the_library(spark, awkward):
    library = Tokenizer.from_file(token_counts.VOCABULARY)
    rows = [*enumerate(ODD), *((r.doc_id, r.text) for r in awkward.collect())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for frequent in (token_counts.FREQUENT, 3):
        got = token_counts.token_counts(df, frequent=frequent, limit=100).collect()
        assert [r.doc_id for r in got] == [i for i, _ in rows]
        for r, (_, text) in zip(got, rows, strict=True):
            n = len(library.encode(text or "", add_special_tokens=False).ids)
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((text or "").encode()), n, n > 100)
    assert token_counts.token_counts(df.limit(0)).isEmpty()


def test_documents_have_the_counts_of_the_library(spark):
    library = Tokenizer.from_file(token_counts.VOCABULARY)
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs).collect()}
    assert got == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}


def library_ids(texts):
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL).encode(texts)


def test_pieces_are_those_of_the_library(monkeypatch):
    with open(pieces.MODEL, "rb") as file:
        encoder = pieces.Encoder(file.read())
    random.seed(5)
    letters = "abcdeehilnorst   \n.,'ABTH▁ñéüß漢😀²03"
    vocabulary = list(encoder.vocabulary.id)
    texts = ODD + ["".join(random.choices(letters, k=random.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(random.choices(vocabulary, k=random.randint(1, 6))).replace("▁", " ") for _ in range(3000)]
    monkeypatch.setattr(pieces, "INDEXED", 1000)  # many index parts, edges across them
    got = [np.frombuffer(b, np.int32) for b in encoder.encode(texts)]
    assert [g.tolist() for g in got] == library_ids(texts)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert [encoder.decode(g) for g in got] == [library.decode(g.tolist()) for g in got]


def test_round_trip(spark, awkward):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    got = pieces.encode(docs.unionByName(awkward))
    rows = got.collect()
    texts = [r.text or "" for r in docs.unionByName(awkward).collect()]
    assert [r.pieces for r in rows] == library_ids(texts)
    assert [r.round_trip for r in rows] == ["▁" not in t for t in texts]
    assert [r.text for r in rows] == [t.replace("▁", " ") for t in texts]
    assert [r.n_pieces for r in rows] == [len(r.pieces) for r in rows]
    assert [r.text for r in pieces.decode(got).collect()] == [r.text for r in rows]
    assert pieces.encode(awkward.limit(0)).isEmpty() and pieces.decode(got.limit(0)).isEmpty()
