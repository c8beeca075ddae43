"""Scores of whole texts against a forward recursion in plain Python, with the classes' shares."""

import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from awkward_rows import awkward  # noqa: F401
from conftest import TESTDATA

from cinetally.llm import language_model

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [""]


def plain_scores(rows, model, symbols):
    c = Counter()
    for i, text in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1:
            c.update(tokens(text))
    first = {t: k for k, t in enumerate(sorted(c, key=lambda t: (-c[t], t))[:symbols])}
    kind = lambda t: zlib.crc32(t[-2:].encode()) % language_model.CLASSES
    weight = Counter()
    for t in c:
        if t not in first:
            weight[kind(t)] += c[t] + 0.5
    emit, move, states = model.emit.tolist(), model.move.tolist(), range(language_model.STATES)
    found = []
    for _, text in rows:
        total, state = 0.0, None
        for t in tokens(text):
            symbol = first.get(t)
            if symbol is None:
                symbol = len(first) + kind(t)
                total += math.log10((c[t] + 0.5) / (weight[kind(t)] + 0.5))
            before = model.start.tolist() if state is None else [sum(state[a] * move[a][b] for a in states) for b in states]
            state = [before[b] * emit[b][symbol] for b in states]
            total += math.log10(sum(state))
            state = [x / sum(state) for x in state]
        found.append(total)
    return found


def test_scores_are_the_forward_sum(spark, awkward, monkeypatch):
    fitted, train = [], language_model.train

    def kept(*args):
        fitted.append(train(*args))
        return fitted[-1]

    monkeypatch.setattr(language_model, "SYMBOLS", 10)
    monkeypatch.setattr(language_model, "train", kept)
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(r.score for r in language_model.score(docs).collect())
    assert got == pytest.approx(sorted(plain_scores(rows, fitted[0], 10)))


def test_rare_tokens_of_texts_are_forgotten():
    corpus = language_model.SimpleNamespace(frequent={b"": (0, 0.5, 0.0), b"a": (1, 0.25, 0.0)}, class_log=[1.0] * 256, first_class=2)
    encoder = language_model.Encoder(corpus)
    for _ in range(2):
        symbols, known, totals, inside, rare, times = (pa.array(x).to_pylist() for x in encoder.encode(["A b b", "", "c b\ta"]))
        assert [len(s) for s in symbols] == [4, 1, 4]
        assert symbols[1] == [0] and symbols[0][1] == symbols[0][2] == 2 + language_model.class_of("b")
        assert known == [2, 1, 2] and totals == [0.75, 0.5, 0.75] and inside == [-2.0, 0.0, -2.0]
        assert [dict(zip(r, t)) for r, t in zip(rare, times)] == [{"b": 2}, {}, {"c": 1, "b": 1}]
