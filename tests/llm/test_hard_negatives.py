"""Hard negatives against a plain loop over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinetally.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, least=80):
    used = [
        (i, r[0], r[2], [math.floor(256 * x) for x in r[1]])
        for i, r in enumerate(rows)
        if r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    def first(found):
        return sorted(found, key=lambda f: (-f[1], f[0] is None, f[0] or 0))[:k]

    out = []
    for n, anchor_id, label, vector in used:
        if anchor_id is None or anchor_id % 100:
            continue
        scored = [(m, i, other, score(vector, v)) for m, i, other, v in used if m != n]
        for positive, high in first([(i, s) for _, i, other, s in scored if other == label]):
            good = first([(i, s) for _, i, other, s in scored if other != label and least * high <= 100 * s <= 100 * high])
            out += [(anchor_id, positive, rank, i, high, s) for rank, (i, s) in enumerate(good, 1)]
    return sorted(out, key=repr)


def mined(df, **options):
    return sorted(map(tuple, hn.mine(df, F.col("vec_id") % 100 == 0, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 24))
    out = []
    for i in range(900):
        v = centres[rng.integers(6)] + 0.4 * rng.standard_normal(24)
        # Coarse steps make many ties.
        out.append((int(i), [float(x) for x in np.round(v, 1)], int(rng.integers(4))))
    out += [(1000 + i, out[i][1], out[i][2]) for i in range(0, 300, 3)]
    out += [(100, None, 1), (200, [1.0] * 24, None), (300, [float("nan")] * 24, 2), (400, [float("inf")] + [0.0] * 23, 1),
            (500, [None] + [0.5] * 23, 1), (None, out[0][1], out[0][2]), (100, out[100][1], out[100][2]), (600, [0.0] * 24, 3), (700, [], 2), (800, [1.0, -2.0], 0)]
    return out


def test_all_pairs_agree(spark, rows):
    expected = brute(rows)
    assert len(expected) > 100
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(4)) == expected


@pytest.mark.parametrize("options", [{"positives": 2, "negatives": 2}, {"least_percent": 95}])
def test_other_parameters(spark, rows, options):
    got = mined(spark.createDataFrame(rows, SCHEMA), **options)
    assert got == brute(rows, options.get("positives", 5), options.get("least_percent", 80))


def test_chunks_and_blocks_make_no_difference(spark, rows, monkeypatch):
    monkeypatch.setattr(hn, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(hn, "BLOCK", 4)
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_intervals_hold_the_product():
    rng = np.random.default_rng(5)
    for dims in (1, 3, 64, 100):
        vectors = np.floor(256 * rng.standard_normal((400, dims)))
        vectors[0] = 0
        for anchor in (vectors[0], vectors[1], vectors[2]):
            low, high = hn.intervals(anchor, *hn.encode(vectors))
            exact = vectors @ anchor
            assert (low <= exact).all() and (exact <= high).all()


def test_vectors_of_other_clusters_are_not_scored(monkeypatch):
    rng = np.random.default_rng(6)
    centres = 200 * rng.standard_normal((10, 64))
    kind = rng.integers(10, size=5000)
    vectors = np.floor(centres[kind] + 20 * rng.standard_normal((5000, 64)))
    codes, align, norm = hn.encode(vectors)
    held = hn._Vectors([
        {"node": i, "id": i, "label": str(kind[i]), "vector": vectors[i].tobytes(), "code": codes[i].tobytes(), "align": align[i], "norm": norm[i]}
        for i in range(5000)
    ])
    scored, products = [], hn.products
    monkeypatch.setattr(hn, "products", lambda anchor, v, norm: scored.append(len(v)) or products(anchor, v, norm))
    exact = sorted(((int(s), -i) for i, s in enumerate(vectors @ vectors[0])), reverse=True)
    low, high = hn.intervals(vectors[0], codes, align, norm)
    found = held.best(vectors[0], low, high, np.ones(5000, bool), 5)
    assert [f[:2] for f in found] == [(s, -i) for s, i in exact[:5]] and sum(scored) < 1200
    scored.clear()
    least, most = exact[300][0], exact[100][0]
    found = held.best(vectors[0], low, high, np.ones(5000, bool), 5, least, most)
    assert [f[0] for f in found] == [s for s, _ in exact if s <= most][:5] and sum(scored) < 1200


def test_very_large_components_are_scored_exactly(spark):
    rows = [(0, [1.0e6, 1.0], 1), (1, [1.0e6, 0.25], 1), (2, [0.9e6, 1.5], 2), (3, [1.0e6, 0.2], 2)]
    assert mined(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")) == brute(rows)


def test_tables_without_anything_to_mine(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df.limit(0)) == [] and mined(df.filter("vec_id % 100 != 0")) == [] and mined(df.filter("vec_id = 0")) == []
    assert mined(df.withColumn("label", F.lit(1))) == []


def test_clashing_names(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    more = df.select("*", *(F.lit("x").alias(n) for n in ("id", "node", "vector", "is_anchor", "wanted", "chunk", "block", "score", "rank", "anchor_id", "a.b")))
    assert mined(more) == mined(df)
