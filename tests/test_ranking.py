"""Numbering, quantiles and top-n against brute force, with a hot group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinetally.operators import profiling, quantiles, ranking
from cinetally.operators.aggregates import key_stats
from cinetally.sources.scratch import Scratch

ORDER = ["avg_rating", "num_votes", "movieId"]


@pytest.fixture(scope="module")
def candidates():
    """Half of all rows in one group, many ties, and a NULL group."""
    draw = random.Random(7)
    groups = ["hot"] * 5 + ["a", "b", "c", None, ""]
    return [
        (draw.choice(groups), draw.choice([1.0, 2.5, 2.5, 4.0, None]), draw.randrange(5), i)
        for i in range(3000)
    ]


def expected_ranks(candidates):
    groups = {}
    for row in candidates:
        groups.setdefault(row[0], []).append(row)
    for rows in groups.values():
        rows.sort(key=lambda r: (r[1] is None, -(r[1] or 0), -r[2], r[3]))
    return {(r[0], r[3]): i for rows in groups.values() for i, r in enumerate(rows, start=1)}


def frame(spark, candidates):
    schema = "genre string, avg_rating double, num_votes int, movieId int"
    return spark.createDataFrame(candidates, schema).repartition(11)


def test_row_numbers_match_brute_force(spark, candidates):
    with Scratch(spark) as scratch:
        ranked = ranking.row_numbers(
            frame(spark, candidates), ["genre"], ranking.best_first(), scratch
        )
        got = {(r["genre"], r["movieId"]): r["rank"] for r in ranked.collect()}
    assert got == expected_ranks(candidates)


def test_row_numbers_cut_a_group_into_slices(spark, candidates):
    option = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(option, "false")
    try:
        with Scratch(spark) as scratch:
            ranked = ranking.row_numbers(
                frame(spark, candidates), ["genre"], ranking.best_first(), scratch
            )
            got = {(r["genre"], r["movieId"]): r["rank"] for r in ranked.collect()}
            stored = spark.read.parquet(f"{scratch.root}/slices-*")
            slices = stored.filter("genre = 'hot'").select(F.shiftright("row_position", 33))
            assert slices.distinct().count() > 2
    finally:
        spark.conf.unset(option)
    assert got == expected_ranks(candidates)


def test_row_numbers_over_everything(spark):
    with Scratch(spark) as scratch:
        ranked = ranking.row_numbers(spark.range(500), [], [F.desc("id")], scratch)
        assert {(r["id"], r["rank"]) for r in ranked.collect()} == {
            (i, 500 - i) for i in range(500)
        }


def test_top_n_matches_brute_force(spark, candidates):
    best = ranking.top_n_per_group(
        frame(spark, candidates), ["genre"], ranking.best_first(), 3
    )
    got = {(r["genre"], r["movieId"]): r["rank"] for r in best.collect()}
    assert got == {k: v for k, v in expected_ranks(candidates).items() if v <= 3}
    plan = best._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[1]
    assert initial.count("WindowGroupLimit") == 2


def test_top_k_ties(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 5), (2, 2.0, 5), (3, 2.0, 9), (4, None, 99), (5, 3.0, 1)],
        "movieId int, avg_rating double, num_votes int",
    )
    best = ranking.top_k(df, ranking.best_first(), 4)
    assert [r["movieId"] for r in best.collect()] == [5, 3, 1, 2]
    assert "TakeOrderedAndProject" in best._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_quantiles_match_numpy(spark, coalesce):
    draw = np.random.default_rng(3)
    hot = np.where(draw.random(4001) < 0.4, 7.25, draw.normal(0, 50, 4001))
    data = [(float(v), int(v), None if i % 3 else float(v)) for i, v in enumerate(hot)]
    data += [(float("nan"), None, None)]
    df = spark.createDataFrame(data, "x double, y int, z double").repartition(9)
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    option = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(option, coalesce)
    try:
        with Scratch(spark) as scratch:
            found = quantiles.exact_quantiles(
                df, ["x", "y", "z"], probabilities, scratch, digits=None
            )
            got = {(r["column"], r["p"]): r["quantile"] for r in found.collect()}
    finally:
        spark.conf.unset(option)
    columns = {
        "x": hot,
        "y": hot.astype(int),
        "z": np.array([v for i, v in enumerate(hot) if i % 3 == 0]),
    }
    assert len(got) == len(columns) * len(probabilities)
    for (column, p), value in got.items():
        assert value == pytest.approx(np.quantile(columns[column], p), rel=1e-12)


def test_summary_matches_numpy(spark):
    draw = np.random.default_rng(5)
    values = np.where(draw.random(5000) < 0.4, 1e9, draw.normal(1e9, 3, 5000))
    rows = [(float(v), None) for v in values] + [(None, None), (float("nan"), None)]
    df = spark.createDataFrame(rows, "x double, nothing double").repartition(7)
    with Scratch(spark) as scratch:
        exact = {r["column"]: r for r in profiling.summary_with_quartiles(df, scratch).collect()}
    near = {r["column"]: r for r in profiling.summary_with_quartiles(df, None).collect()}
    assert exact["x"].asDict().keys() == near["x"].asDict().keys()
    assert tuple(exact["nothing"])[1:] == tuple(near["nothing"])[1:] == (0,) + (None,) * 7
    expected = {
        "count": 5000, "mean": values.mean(), "stddev": values.std(ddof=1),
        "min": values.min(), "max": values.max(),
    }
    for found in (exact["x"], near["x"]):
        for name, number in expected.items():
            assert found[name] == pytest.approx(number, abs=2e-5, rel=0)
    for name, p in profiling.QUARTILES.items():
        assert exact["x"][name] == pytest.approx(np.quantile(values, p), abs=1e-5, rel=0)
        assert near["x"][name] == pytest.approx(np.quantile(values, p), abs=0.1, rel=0)


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("movieId"),
        F.lit(3.0).alias("rating"),
    )
    stats = key_stats(df)
    assert "partial_avg" in stats._jdf.queryExecution().executedPlan().toString()
    assert stats.filter("movieId = 1").first()["num_votes"] == 50_001
