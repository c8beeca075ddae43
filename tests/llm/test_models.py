"""The trained operators: held-out accuracy, degenerate labels, exact likelihoods."""

import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from awkward_rows import awkward, clashing  # noqa: F401
from conftest import TESTDATA

from cinetally.llm import language_model, quality, toxicity

SF = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels")}


@pytest.mark.parametrize(
    "module, label, folds, out, threshold, accuracy",
    [(toxicity, "toxic", 4, 2, 0.3, 0.9), (quality, "quality", 3, 1, 0.5, 0.95)],
)
def test_held_out_accuracy(tables, module, label, folds, out, threshold, accuracy):
    rows = module.score(tables["documents"], tables["labels"]).collect()
    assert len(rows) == tables["documents"].count()
    labels = {r.doc_id: r[label] for r in tables["labels"].collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    held = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean(held) >= accuracy


@pytest.mark.parametrize("module, label, folds, out", [(toxicity, "toxic", 4, 2), (quality, "quality", 3, 1)])
def test_held_out_labels_are_not_used(tables, module, label, folds, out):
    flipped = tables["labels"].selectExpr(
        "doc_id", f"case when crc32(cast(cast(doc_id as string) as binary)) % {folds} = {out} then 1 - {label} else {label} end as {label}"
    )
    one, two = (
        {r.doc_id: r.score for r in module.score(tables["documents"], labels).collect()}
        for labels in (tables["labels"], flipped)
    )
    assert one == pytest.approx(two, abs=1e-6)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_degenerate_labels(spark, awkward, module, label):
    for rows in ([], [(1, None), (None, 1)], [(1, 1), (3, 1), (4, 1)]):
        labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
        scores = [r.score for r in module.score(awkward, labels).collect()]
        assert len(scores) == awkward.count() and len(set(scores)) == 1 and 0 <= scores[0] <= 1
    labels = spark.createDataFrame([(i % 10, i % 2) for i in range(20)] + [(None, 1), (1, None)], f"doc_id long, {label} int")
    assert len(module.score(awkward, labels).collect()) == awkward.count()
    assert module.score(awkward.limit(0), labels).isEmpty()


def test_toxic_rows_go(spark, tables, clashing):
    kept = toxicity.keep_clean(tables["documents"], tables["labels"])
    assert kept.columns == tables["documents"].columns and kept.exceptAll(tables["documents"]).isEmpty()
    predicted = toxicity.score(tables["documents"], tables["labels"]).agg({"predicted": "sum"}).first()[0]
    assert kept.count() == tables["documents"].count() - predicted
    labels = spark.createDataFrame([(1, 0), (3, 0)], "doc_id long, toxic int")
    same = toxicity.keep_clean(clashing, labels)
    assert same.columns == clashing.columns and same.count() == clashing.count()


# Language model


def base_scores(rows):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) + [""] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    c = Counter(w for ws, h in zip(tokens, held) for w in ws if not h)
    n, v = sum(c.values()), len(c)
    return [
        (h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        for ws, h in zip(tokens, held)
    ]


@pytest.mark.parametrize("frequent", [language_model.FREQUENT, 20])
def test_base_scores(spark, awkward, monkeypatch, frequent):
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    monkeypatch.setattr(language_model, "SYMBOLS", 10)
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").unionByName(awkward)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((repr((r.held_out, r.n_tokens, r.n_known, r.train_tokens)), r.base_score) for r in language_model.score(docs).collect())
    expected = sorted((repr(e[:4]), e[4]) for e in base_scores(rows))
    assert [g[0] for g in got] == [e[0] for e in expected]
    assert [g[1] for g in got] == pytest.approx([e[1] for e in expected])


def test_nothing_to_learn_from(spark, awkward):
    assert language_model.score(awkward.limit(0)).isEmpty()
    held = spark.createDataFrame([(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    got = language_model.score(held).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in got} == {(3, 0, 0)}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)


def test_the_hidden_model_beats_the_base_on_held_out_texts(tables):
    rows = [r for r in language_model.score(tables["documents"]).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def small_model():
    model = language_model.Model(np.full(6, 1 / 6))
    random = np.random.default_rng(2)
    model.move = random.dirichlet(np.ones(language_model.STATES), language_model.STATES)
    model.start = random.dirichlet(np.ones(language_model.STATES))
    return model


def test_forward_is_the_sum_over_all_paths(monkeypatch):
    monkeypatch.setattr(language_model, "STATES", 3)
    model = small_model()
    sequences = [[0, 3, 5, 1], [2], [4, 4]]
    expected = []
    for s in sequences:
        total = 0.0
        for path in product(range(3), repeat=len(s)):
            p = model.start[path[0]] * model.emit[path[0], s[0]]
            for t in range(1, len(s)):
                p *= model.move[path[t - 1], path[t]] * model.emit[path[t], s[t]]
            total += p
        expected.append(math.log10(total))
    lengths, values = np.array([len(s) for s in sequences]), np.concatenate(sequences)
    assert language_model.forward(model, lengths, values) == pytest.approx(expected)
    monkeypatch.setattr(language_model, "SIDE_BY_SIDE", 1)
    assert language_model.forward(model, lengths, values) == pytest.approx(expected)


def test_expected_counts_add_up_and_raise_the_likelihood():
    random = np.random.default_rng(0)
    lengths = random.integers(1, 40, 50)
    values = np.concatenate([(np.arange(n) // 5 + random.integers(0, 2)) % 6 for n in lengths])
    model = small_model()
    before = language_model.forward(model, lengths, values).sum()
    for _ in range(3):
        counts = language_model.expected_counts(model, lengths, values)
        size = model.emit.shape[1]
        assert counts[:size].sum(axis=1) == pytest.approx(np.bincount(values, minlength=size))
        assert counts[size:-1].sum() == pytest.approx((lengths - 1).sum()) and counts[-1].sum() == pytest.approx(50)
        model.fitted(counts, np.full(size, 1e-6))
        after = language_model.forward(model, lengths, values).sum()
        assert after > before - 0.5
        before = after
