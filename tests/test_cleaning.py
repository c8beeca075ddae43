from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cinetally.operators import cleaning
from cinetally.schemas import LINKS, MOVIES, RATINGS, SPECS, TAGS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def ratings(spark, data):
    return spark.createDataFrame(data, RATINGS.schema)


def test_dedup_keeps_smallest_payload(spark):
    df = ratings(spark, [(1, 1, 4.0, 10), (1, 1, 3.0, 10), (1, 1, None, 10), (1, 1, 2.0, 11)])
    kept = cleaning.dedup_by_key(df, RATINGS.key)
    assert kept.columns == df.columns
    assert rows(kept) == [(1, 1, 2.0, 11), (1, 1, 3.0, 10)]


def test_dedup_of_wide_payload_puts_null_last(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, "z", None), (1, "z", "b"), (2, None, None)], MOVIES.schema
    )
    assert rows(cleaning.dedup_by_key(df, ("movieId",))) == [(1, "z", "b"), (2, None, None)]


def test_dedup_without_payload_and_null_keys(spark):
    df = spark.createDataFrame(
        [(None, 1, "x", 5), (None, 1, "x", 5), (2, 1, "x", 5)], TAGS.schema
    )
    assert rows(cleaning.dedup_by_key(df, TAGS.key)) == [(2, 1, "x", 5), (None, 1, "x", 5)]


def test_duplicates_go_before_the_range_check(spark):
    df = ratings(spark, [(1, 1, 0.3, 10), (1, 1, 4.0, 10), (2, 1, 5.0, 10), (3, 1, 0.5, 10)])
    assert [r[0] for r in rows(cleaning.clean_ratings(df))] == [2, 3]


def test_null_required_columns_are_dropped(spark):
    df = ratings(spark, [(None, 1, 4.0, 1), (1, None, 4.0, 1), (1, 1, None, 1), (1, 1, 4.0, None)])
    kept = cleaning.clean_ratings(df).collect()
    assert len(kept) == 1 and kept[0]["timestamp"] is None and kept[0]["year"] is None


def test_epoch_and_calendar(spark):
    df = ratings(spark, [(1, 1, 4.0, 964982703)])
    row = cleaning.clean_ratings(df).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    ).first()
    assert row["timestamp"] == datetime(2000, 7, 30, 18, 45, 3)
    # The 30th of July 2000 was a Sunday.
    assert [row[c] for c in ("year", "month", "day", "dayOfWeek", "hour")] == [2000, 7, 30, 1, 18]


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([(1, "  a b ", "\t x \t")], MOVIES.schema)
    assert rows(cleaning.clean_movies(df)) == [(1, "a b", "\t x \t")]


def test_tags_equal_after_trim_both_survive(spark):
    df = spark.createDataFrame([(1, 1, " Fun", 5), (1, 1, "Fun ", 5)], TAGS.schema)
    assert [r[2] for r in rows(cleaning.clean_tags(df))] == ["Fun", "Fun"]
    assert {r[2] for r in rows(cleaning.clean_tags(df, fold_case=True))} == {"fun"}


def test_optional_column(spark):
    df = spark.createDataFrame([(1, "01", None), (2, "02", "7"), (3, None, "8")], LINKS.schema)
    assert [r[0] for r in rows(cleaning.clean_links(df))] == [1, 2]
    assert [r[0] for r in rows(cleaning.clean_links(df, keep_optional_nulls=False))] == [2]


@pytest.mark.parametrize("spec", [MOVIES, LINKS], ids=lambda s: s.name)
def test_cleaning_twice_changes_nothing(spark, spec):
    data = [(1, " a ", " b"), (1, "c", None), (2, None, "d"), (None, "e", "f")]
    once = cleaning.clean(spark.createDataFrame(data, spec.schema), spec)
    assert rows(cleaning.clean(once, spec)) == rows(once)


def test_cleaning_ratings_twice_changes_nothing(spark):
    data = [(1, 1, 4.0, 10), (1, 1, 3.0, 10), (2, 1, 9.0, 10), (3, 1, 1.0, 86400)]
    once = cleaning.clean_ratings(ratings(spark, data))
    back = once.select(
        "userId", "movieId", "rating", F.unix_timestamp("timestamp").alias("timestamp")
    )
    assert rows(cleaning.clean_ratings(back)) == rows(once)


def test_report_adds_up(spark):
    before = {
        "movies": spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, None, "y")], MOVIES.schema),
        "links": spark.createDataFrame([], LINKS.schema),
    }
    after = {name: cleaning.clean(df, SPECS[name]) for name, df in before.items()}
    report = {r["table"]: r for r in cleaning.cleaning_report(before, after).collect()}
    assert tuple(report["movies"])[1:] == (3, 1, 2, 66.7)
    assert tuple(report["links"])[1:] == (0, 0, 0, None)
    assert tuple(report["total"])[1:] == (3, 1, 2, 66.7)


def test_null_keys_are_filtered_below_the_shuffle(spark, tmp_path):
    spark.createDataFrame([(1, 1, 4.0, 1)], RATINGS.schema).write.parquet(str(tmp_path / "r"))
    df = cleaning.clean_ratings(spark.read.parquet(str(tmp_path / "r")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(userId)" in plan and "IsNotNull(movieId)" in plan
