"""Recorded facts about the sf0.01 tables, and the pipelines from CSV to gold."""

import pytest

from conftest import TESTDATA
from cinetally.operators import aggregates, joins
from cinetally.plans import pipelines, reports
from cinetally.sources.readers import read_silver_tables
from cinetally.sources.scratch import Scratch
from cinetally.sources.writers import write_csv
from cinetally.workload.fixtures import Fixtures


@pytest.fixture(scope="module")
def data(spark):
    return Fixtures(spark, f"{TESTDATA}/sf0.01")


@pytest.fixture(scope="module")
def silver(spark, data):
    """Bronze through CSV files into silver."""
    with Scratch(spark) as scratch:
        bronze, folder = scratch.path("bronze"), scratch.path("silver")
        for name, df in data.bronze.items():
            write_csv(df, f"{bronze}/{name}.csv")
        raw = pipelines.read_bronze_tables(spark, bronze, data.specs)
        written = pipelines.bronze_to_silver(raw, folder, data.specs)
        yield raw, folder, written


def test_counts(spark, data, silver):
    raw, folder, written = silver
    assert written == {"movies": 1990, "ratings": 54670, "tags": 9941, "links": 1980}
    report = pipelines.silver_report(spark, raw, folder, data.specs)
    assert {r["table"]: (r["n_before"], r["n_after"]) for r in report.collect()} == {
        "movies": (2020, 1990),
        "ratings": (61176, 54670),
        "tags": (10250, 9941),
        "links": (2020, 1980),
        "total": (75466, 68581),
    }
    checked = pipelines.verify_silver(spark, folder, written, data.specs).collect()
    assert len(checked) == 4 and all(r["matches"] for r in checked)


def test_a_lost_file_is_noticed(spark, data, silver):
    _, folder, written = silver
    wrong = {**written, "tags": written["tags"] + 1}
    report = pipelines.verify_silver(spark, folder, wrong, data.specs)
    assert {r["table"] for r in report.collect() if not r["matches"]} == {"tags"}


def test_analyses(spark, data, silver):
    tables = read_silver_tables(spark, silver[1], data.specs)
    ratings, movies = tables["ratings"], tables["movies"]
    best = reports.best_movies(ratings, movies, min_votes=30).collect()
    assert [tuple(r) for r in best[:3]] == [
        (422, "blue rod", 3.428125, 32),
        (554, "old gear", 3.416129, 31),
        (535, "old anvil", 3.406667, 30),
    ]
    assert reports.voted_movies(reports.movie_means(ratings), 30).count() == 644
    genres = reports.genre_ratings(ratings, movies).collect()
    assert len(genres) == 23
    assert [tuple(r) for r in genres[:3]] == [
        ("ring", 2.761402, 239),
        ("new", 2.758663, 218),
        ("gear", 2.754996, 249),
    ]
    assert reports.top_movies_per_genre(ratings, movies).count() == 69
    facts = {r["fact"]: r["value"] for r in aggregates.dataset_facts(movies, ratings).collect()}
    assert (facts["users"], facts["first_year"], facts["last_year"]) == (99, 1995, 2001)
    orphans = joins.orphan_keys(ratings, movies, "movieId").agg({"n_rows": "sum"}).first()
    assert orphans[0] == 289


def test_gold(spark, data, silver):
    with Scratch(spark) as scratch:
        gold = scratch.path("gold")
        written = pipelines.silver_to_gold(
            spark, silver[1], gold, data.specs, min_votes=30, files=1
        )
        assert written == dict(zip(pipelines.GOLD_TABLES, (10, 23, 69)))
        top = spark.read.csv(f"{gold}/{pipelines.GOLD_TABLES[2]}", header=True)
        assert top.columns == ["genre", "rank", "title", "avg_rating", "num_votes"]
        assert top.count() == 69


@pytest.mark.parametrize(
    "scale, counts", [("sf0.001", (199, 4943, 935, 198)), ("sf0.1", (19900, 551424, 99933, 19800))]
)
def test_other_scales(spark, scale, counts):
    tables = Fixtures(spark, f"{TESTDATA}/{scale}").silver
    report = {r["table"]: r["n_rows"] for r in aggregates.row_counts(tables).collect()}
    assert tuple(report.values()) == counts
