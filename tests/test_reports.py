from pyspark.sql import functions as F
import pytest

from cinetally.operators import aggregates, checks, joins, profiling
from cinetally.plans import reports, reuse
from cinetally.schemas import MOVIES, RATINGS, SPECS
from cinetally.sources.scratch import Scratch


@pytest.fixture(scope="module")
def movies(spark):
    return spark.createDataFrame(
        [
            (1, "One (1999)", "A|B"),
            (2, "Two (2000)", "A"),
            (3, "Three", "(no genres listed)"),
            (4, "Four (2001)", None),
            (5, "Five", "B|B||(no genres listed)"),
        ],
        MOVIES.schema,
    )


@pytest.fixture(scope="module")
def ratings(spark):
    data = [(u, m, r, 0) for m, values in {
        1: [4.0, 5.0], 2: [4.5, 4.5], 3: [5.0, 1.0], 4: [2.0], 5: [3.0, 3.0], 6: [1.0, 1.5, 0.5],
    }.items() for u, r in enumerate(values)]
    df = spark.createDataFrame(data, RATINGS.schema)
    return df.withColumn("year", F.when(F.col("movieId") < 3, 1999).otherwise(2000))


def test_best_movies(ratings, movies):
    best = reports.best_movies(ratings, movies, min_votes=2, k=4).collect()
    assert [tuple(r) for r in best] == [
        (1, "One (1999)", 4.5, 2),
        (2, "Two (2000)", 4.5, 2),
        (3, "Three", 3.0, 2),
        (5, "Five", 3.0, 2),
    ]
    all_of_them = reports.best_movies(ratings, movies, min_votes=1).collect()
    assert tuple(all_of_them[-1]) == (6, None, 1.0, 3)
    assert reports.best_movies(ratings, movies).count() == 0


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "merge"])
def test_genre_ratings(ratings, movies, strategy):
    got = reports.genre_ratings(ratings, movies, strategy=strategy).collect()
    # The lists of movies 3 and 4 hold no genre, and movie 6 is unknown.
    assert [tuple(r) for r in got] == [
        ("A", 4.5, 2),
        ("B", 3.5, 3),
        ("", 3.0, 1),
        (None, 2.0, 3),
    ]
    known = reports.genre_ratings(ratings, movies, strategy=strategy, include_unclassified=False)
    assert [r["genre"] for r in known.collect()] == ["A", "B", ""]


def test_unknown_strategy(ratings, movies):
    with pytest.raises(ValueError):
        reports.genre_ratings(ratings, movies, strategy="nested")


def test_top_movies_per_genre(ratings, movies):
    got = reports.top_movies_per_genre(ratings, movies, min_votes=1, n=2).collect()
    assert [tuple(r) for r in got] == [
        (None, 1, None, 3.0, 2),
        (None, 2, None, 2.0, 1),
        ("", 1, "Five", 3.0, 2),
        ("A", 1, "One (1999)", 4.5, 2),
        ("A", 2, "Two (2000)", 4.5, 2),
        ("B", 1, "One (1999)", 4.5, 2),
        ("B", 2, "Five", 3.0, 2),
    ]


def test_expanding_behind_the_join_gives_the_same_rows(ratings, movies):
    stats = aggregates.key_stats(ratings)
    behind = joins.attach_items(stats, movies, "movieId", carry=("title",))
    exploded = joins.explode_list(movies)
    before = joins.attach(stats, exploded, "movieId").select(behind.columns)
    comparison = reuse.compare_results(behind, before).first()
    assert tuple(comparison) == (behind.count(), behind.count(), 0)


def test_broadcast_only_below_the_limit(ratings, movies):
    def plan(limit):
        stats = aggregates.key_stats(ratings)
        joined = joins.attach(
            stats, movies, "movieId", strategy="broadcast", broadcast_limit=limit
        )
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(10_000)
    assert "strategy=broadcast" not in plan(10)


def test_nested_columns_are_never_vouched_for(spark):
    assert not joins.fits_broadcast(spark.sql("select array(1) as a"))
    assert joins.fits_broadcast(spark.sql("select 'a' as a where false"))


def test_orphans_and_coverage(ratings, movies):
    assert [tuple(r) for r in joins.orphan_keys(ratings, movies, "movieId").collect()] == [(6, 3)]
    of_2000 = ratings.filter("year = 2000")
    assert tuple(joins.coverage(movies, of_2000, "movieId").first()) == (5, 3, 60.0)


def test_distinct_with_and_without_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "x int")
    assert tuple(aggregates.count_distinct_values(df, "x").first()) == (2, 1)


def test_dataset_facts(ratings, movies):
    facts = {r["fact"]: r["value"] for r in aggregates.dataset_facts(movies, ratings).collect()}
    assert facts == {
        "movies": 5, "ratings": 12, "users": 3, "first_year": 1999, "last_year": 2000,
    }


def test_titles_and_scale(movies, ratings):
    assert tuple(checks.titles_with_year(movies).first()) == (5, 3, 60.0)
    off = ratings.withColumn("rating", F.col("rating") + F.when(F.col("movieId") == 4, 0.2).otherwise(0))
    assert tuple(checks.off_scale(off).first()) == (12, 1, 8.33)


def test_scorecard(spark):
    df = spark.createDataFrame(
        [(1, 1, 9.0, 1), (1, 1, 9.0, 1), (2, 1, 3.0, 1), (3, 1, None, None)], RATINGS.schema
    )
    score = checks.quality_scorecard({"ratings": df}, SPECS).first()
    assert tuple(score) == ("ratings", 4, 87.5, 75.0, 33.33, 100.0)


def test_cache_is_released(spark, ratings):
    small = ratings.select("year", "rating")
    with reuse.cached(small, eager=True) as held:
        assert held.storageLevel.useMemory and held.count() == 12
    assert not small.is_cached and not small.storageLevel.useMemory
    with pytest.raises(RuntimeError):
        with reuse.cached(small):
            raise RuntimeError
    assert not small.storageLevel.useMemory


def test_cache_of_somebody_else_stays(ratings):
    mine = ratings.select("userId").persist()
    with reuse.cached(mine) as held:
        held.count()
    assert mine.storageLevel.useMemory
    mine.unpersist()


def test_query_batch(ratings):
    batch = reuse.query_batch(reuse.rating_cube(ratings), year=1999, min_rating=4.5)
    got = {(r["query"], r["bucket"]): r["n"] for r in batch.collect()}
    assert got[("one_year", "1999")] == 4
    assert got[("high_ratings", "4.5")] == 4
    assert got[("by_year", "2000")] == 8
    assert sum(n for (q, _), n in got.items() if q == "by_rating") == 12
    nothing = reuse.query_batch(reuse.rating_cube(ratings), year=2030, min_rating=9.0)
    assert nothing.filter("query = 'one_year'").first()["n"] == 0


def test_compare_results_sees_duplicates_and_nulls(spark):
    left = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    right = spark.createDataFrame([(1,), (None,), (None,)], "x int")
    assert tuple(reuse.compare_results(left, right).first()) == (3, 3, 2)


def test_missing_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r["column"]: tuple(r)[1:] for r in profiling.missing_values(df).collect()}
    assert got == {"x": ("double", 2, 66.67), "s": ("string", 1, 33.33)}
    summary = aggregates.numeric_summary(df).collect()
    assert [tuple(r) for r in summary] == [("x", 1, 1.0, None, 1.0, 1.0, None, None)]


def test_profiles_of_an_empty_table(spark):
    empty = spark.createDataFrame([], RATINGS.schema)
    assert {tuple(r)[2:] for r in profiling.missing_values(empty).collect()} == {(0, None)}
    assert {tuple(r)[1:3] for r in profiling.top_values(empty).collect()} == {(0, 0)}
    with Scratch(spark) as scratch:
        summary = profiling.summary_with_quartiles(empty, scratch).collect()
    assert len(summary) == 4 and {r["q50"] for r in summary} == {None}


def test_long_texts_are_compared_whole(spark):
    long = "x" * 5000
    df = spark.createDataFrame([(long + "a",), (long + "a",), (long + "b",), (None,), (None,)], "t string")
    assert [tuple(r) for r in profiling.duplicates(df).collect()] == [("t", 1, 1)]


def test_top_values_scan_the_table_once(spark, tmp_path):
    spark.createDataFrame([(1, "b"), (1, "a"), (2, "a"), (None, None)], "x int, s string").write.parquet(
        f"{tmp_path}/t"
    )
    top = profiling.top_values(spark.read.parquet(f"{tmp_path}/t"), k=2)
    got = [tuple(r) for r in top.orderBy("column", "rank").collect()]
    assert got == [
        ("s", 1, 2, None, None, "a", "b", 1, "a", 2),
        ("s", 1, 2, None, None, "a", "b", 2, "b", 1),
        ("x", 1, 2, 1.0, 2.0, "1", "2", 1, "1", 2),
        ("x", 1, 2, 1.0, 2.0, "1", "2", 2, "2", 1),
    ]
    final = top._jdf.queryExecution().executedPlan().toString()
    top.collect()
    final = top._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_keys_as_labels(ratings):
    labelled = profiling.keys_as_labels(ratings, ("userId", "movieId", "absent"))
    assert aggregates.numeric_columns(labelled) == ["rating", "timestamp", "year"]


def test_sample_is_repeatable(spark):
    df = spark.range(100)
    first = profiling.sample_rows(df, ["id"], 5, seed=1).collect()
    assert first == profiling.sample_rows(df.repartition(7), ["id"], 5, seed=1).collect()
    assert first != profiling.sample_rows(df, ["id"], 5, seed=2).collect()
