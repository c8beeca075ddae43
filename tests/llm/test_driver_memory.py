"""The voters' space without all products of the voters."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinetally.llm import quality


def test_singular_vectors_without_all_products(monkeypatch):
    random = np.random.default_rng(3)
    share = 1 / np.arange(1, 1025)
    rows = np.stack([np.bincount(random.choice(1024, 60, p=share / share.sum()), minlength=1024) for _ in range(2500)]).astype(np.float32)
    rows = quality._unit(rows)
    expected = np.linalg.svd(rows.astype(np.float64), full_matrices=False)[2][:16].T
    largest, eigh = [], np.linalg.eigh
    monkeypatch.setattr(np.linalg, "eigh", lambda m: largest.append(len(m)) or eigh(m))
    tracemalloc.start()
    found = quality.leading(lambda: (rows[s : s + 256] for s in range(0, len(rows), 256)), 1024, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.linalg.svd(expected.T @ found)[1].min() > 1 - 1e-6
    assert max(largest) <= 1024 // 2 and peak < 20e6  # all products of the rows take 25 MB, and several times that to solve


def test_fewer_dimensions_than_wanted():
    rows = quality._unit(np.random.default_rng(5).random((3, 400)).astype(np.float32))[np.arange(1200) % 3]
    found = quality.leading(lambda: [rows], 400, 16)
    assert found.shape == (400, 3) and np.abs(found @ (found.T @ rows.T) - rows.T).max() < 1e-6


def test_many_voters_score_like_few_at_once(spark, monkeypatch):
    rows = [(i, f"good fine {'calm ' * (i % 5)}{i % 37}" if i % 2 else f"bad poor {'loud ' * (i % 7)}{i % 41}") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    monkeypatch.setattr(quality, "TOPICS", 8)
    expected = {r.doc_id: r.score for r in quality.score(docs, labels).collect()}
    monkeypatch.setattr(quality, "ALL_PRODUCTS", 20)
    found = {r.doc_id: r.score for r in quality.score(docs, labels).collect()}
    assert found == pytest.approx(expected, abs=1e-3)
