"""Scoped caching, query batches over one frame, and comparison of strategies."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from cinetally.functions.columns import tally


@contextmanager
def cached(
    df: DataFrame, *, eager: bool = False, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Keep a frame for the length of a ``with`` block.

    Filter and select before: behind the cache neither partition pruning nor
    column pruning reaches the files. Blocks lost with an executor are computed
    again. A frame somebody else has cached stays so.
    """
    if df.is_cached:
        yield df
        return
    held = df.persist(level)
    try:
        if eager:
            held.count()
        yield held
    finally:
        held.unpersist()


def rating_cube(ratings: DataFrame) -> DataFrame:
    """Ratings per year and rating value: all that ``query_batch`` needs of them."""
    return ratings.groupBy("year", "rating").agg(F.count(F.lit(1)).alias("n"))


def query_batch(cube: DataFrame, *, year: int, min_rating: float) -> DataFrame:
    """Four answers as (query, bucket, n) rows.

    Ratings of one year, ratings from a threshold on, ratings per year, and
    ratings per value. ``cube`` has the counts of ``rating_cube``, so a batch
    over a cached cube touches the ratings themselves only once.
    """
    def answer(query: str, rows: DataFrame, bucket) -> DataFrame:
        return rows.select(F.lit(query).alias("query"), bucket.cast("string").alias("bucket"), "n")

    def total(rows: DataFrame) -> DataFrame:
        return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))

    def grouped(column: str) -> DataFrame:
        return cube.groupBy(column).agg(F.sum("n").alias("n"))

    of_year = total(cube.filter(F.col("year") == year))
    from_threshold = total(cube.filter(F.col("rating") >= min_rating))
    return reduce(
        DataFrame.unionByName,
        [
            answer("one_year", of_year, F.lit(year)),
            answer("high_ratings", from_threshold, F.lit(min_rating)),
            answer("by_year", grouped("year"), F.col("year")),
            answer("by_rating", grouped("rating"), F.col("rating")),
        ],
    )


def compare_results(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts of two results and the number of rows they do not share.

    One aggregation over both, duplicates and NULLs included, instead of two
    anti-joins.
    """
    columns = left.columns
    sides = left.withColumn("is_left", F.lit(True)).unionByName(
        right.withColumn("is_left", F.lit(False))
    )
    per_row = sides.groupBy(*columns).agg(
        tally(F.col("is_left")).alias("n_left"), tally(~F.col("is_left")).alias("n_right")
    )
    return per_row.agg(
        F.coalesce(F.sum("n_left"), F.lit(0)).alias("n_left"),
        F.coalesce(F.sum("n_right"), F.lit(0)).alias("n_right"),
        F.coalesce(F.sum(F.abs(F.col("n_left") - F.col("n_right"))), F.lit(0)).alias("n_different"),
    )
