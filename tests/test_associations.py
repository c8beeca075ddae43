"""Associations of columns and quantiles in their own type, against plain Python."""

import math
import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest

from cinetally.operators import associations, quantiles
from cinetally.sources.scratch import Scratch


@pytest.fixture(scope="module")
def rows():
    random.seed(7)
    out = []
    for _ in range(3000):
        kind = random.choice(["a", "b", "c", None, "x" * 200 + random.choice("yz")])
        x = random.gauss({"a": 1, "b": 2}.get(kind, 0), 1)
        out.append((kind, random.choice(["p", "q"]) if kind != "a" else "p", x, 3 * x + random.random(), random.choice([1, 2, None]), float("nan") if random.random() < 0.1 else x * x))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "kind string, `o.k` string, x double, `y z` double, i int, q double")


def test_correlations(df, rows):
    found = {(r.column_a, r.column_b): (r.n, r.correlation) for r in associations.correlations(df, digits=None).collect()}
    names = {"x": 2, "y z": 3, "i": 4, "q": 5}
    assert len(found) == 6
    for (a, b), (n, r) in found.items():
        both = [(row[names[a]], row[names[b]]) for row in rows if not any(v is None or v != v for v in (row[names[a]], row[names[b]]))]
        assert n == len(both) and math.isclose(r, np.corrcoef(np.array(both, float).T)[0, 1], abs_tol=1e-9)


def test_many_pairs_take_several_passes(df, monkeypatch):
    whole = associations.correlations(df).collect()
    monkeypatch.setattr(associations, "PAIRS_AT_ONCE", 4)
    assert associations.correlations(df).collect() == whole


def test_correlations_without_spread(spark):
    constant = spark.createDataFrame([(1, 2.0), (1, 3.0)], "a int, b double")
    assert tuple(associations.correlations(constant).first()) == ("a", "b", 2, None)
    assert tuple(associations.correlations(constant.limit(0)).first()) == ("a", "b", 0, None)
    assert associations.correlations(constant.select("a")).isEmpty()


def test_correlation_ratios(df, rows):
    for r in associations.correlation_ratios(df, ["kind", "o.k"], ["x", "q"], digits=None).collect():
        at, of = {"kind": 0, "o.k": 1}[r.label], {"x": 2, "q": 5}[r.number]
        pairs = [(row[at], row[of]) for row in rows if row[at] is not None and row[of] == row[of]]
        values = np.array([v for _, v in pairs])
        groups = [np.array([v for k, v in pairs if k == key]) for key in {k for k, _ in pairs}]
        between = sum(len(g) * (g.mean() - values.mean()) ** 2 for g in groups)
        assert r.n == len(pairs) and math.isclose(r.ratio, math.sqrt(between / ((values - values.mean()) ** 2).sum()), abs_tol=1e-9)
    assert associations.correlation_ratios(df.limit(0), ["kind"], ["x"]).isEmpty()
    assert associations.correlation_ratios(df, [], ["x"]).isEmpty()


def entropy(values):
    n = len(values)
    return -sum(c / n * math.log(c / n) for c in Counter(values).values())


def test_uncertainties(df, rows):
    found = associations.uncertainties(df, ["kind", "o.k"], digits=None).collect()
    pairs = [(r[0], r[1]) for r in rows if r[0] is not None]
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    shared = entropy(a) + entropy(b) - entropy(pairs)
    expected = {("kind", "o.k"): shared / entropy(b), ("o.k", "kind"): shared / entropy(a)}
    assert len(found) == 2
    for r in found:
        assert r.n == len(pairs) and math.isclose(r.uncertainty, expected[r.known, r.told], abs_tol=1e-9)


def test_uncertainty_of_a_constant(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "c string, v int")
    found = {(r.known, r.told): r.uncertainty for r in associations.uncertainties(df, ["c", "v"]).collect()}
    assert found == {("c", "v"): 0.0, ("v", "c"): None}
    assert associations.uncertainties(df.limit(0), ["c", "v"]).isEmpty() and associations.uncertainties(df, ["c"]).isEmpty()


def test_quantiles_keep_all_digits(spark):
    far = 2**60
    df = spark.createDataFrame(
        [(far + 1, Decimal("0.10"), None), (far + 2, Decimal("-7.25"), None), (far + 4, None, None), (None, Decimal("3.00"), None)],
        "id long, d decimal(10,2), none int",
    )
    with Scratch(spark) as scratch:
        found = quantiles.typed_quantiles(df, ["id", "d", "none"], (0.0, 0.25, 0.5, 1.0), scratch).collect()
    got = {(r.column, r.p): (r.lower, r.upper, r.quantile) for r in found}
    assert got["id", 0.0] == (str(far + 1), str(far + 1), str(far + 1))
    assert got["id", 0.25] == (str(far + 1), str(far + 2), f"{far + 1}.5")
    assert got["id", 0.5] == (str(far + 2),) * 3 and got["id", 1.0] == (str(far + 4),) * 3
    assert got["d", 0.25] == ("-7.25", "0.10", "-3.575") and got["d", 0.5] == ("0.10", "0.10", "0.1")
    assert not [k for k in got if k[0] == "none"]
    with pytest.raises(ValueError):
        quantiles.typed_quantiles(df.selectExpr("cast(id as double) id"), ["id"], (0.5,), None)


def test_quantiles_of_round_numbers_keep_their_zeros(spark):
    df = spark.createDataFrame([(100,), (100,), (3000,)], "n int")
    with Scratch(spark) as scratch:
        found = {r.p: r.quantile for r in quantiles.typed_quantiles(df, ["n"], (0.25, 0.75, 1.0), scratch).collect()}
    assert found == {0.25: "100", 0.75: "1550", 1.0: "3000"}
