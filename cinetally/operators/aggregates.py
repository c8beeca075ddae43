"""Grouped and global aggregates. All combine on the map side first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cinetally.functions.columns import percent, quoted, rounded, tally

# Sums of doubles depend on the order of the rows. Means are rounded before
# anything ranks or compares them, so the result does not.
MEAN_DIGITS = 6


def key_stats(
    facts: DataFrame,
    key: str = "movieId",
    value: str = "rating",
    *,
    mean: str = "avg_rating",
    votes: str = "num_votes",
    digits: int | None = MEAN_DIGITS,
) -> DataFrame:
    """Mean and number of non-NULL values per key."""
    return facts.groupBy(key).agg(
        rounded(F.avg(value), digits).alias(mean), F.count(value).alias(votes)
    )


def histogram(df: DataFrame, *columns: str, count: str = "n") -> DataFrame:
    """Rows per combination of values."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def value_range(df: DataFrame, *columns: str) -> DataFrame:
    """Smallest and largest value of each column, in one row."""
    return df.agg(
        *(
            bound(c).alias(f"{label}_{c}")
            for c in columns
            for label, bound in (("min", F.min), ("max", F.max))
        )
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def count_distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with NULL as one of them (``n_values``) and without (``n_non_null``)."""
    return distinct_values(df, column).agg(
        F.count(F.lit(1)).alias("n_values"), F.count(column).alias("n_non_null")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def one_row_per_column(df: DataFrame, measures: dict[str, dict[str, Column]]) -> DataFrame:
    """Run every column's aggregates in one pass and lay them out as rows."""
    flat = [
        aggregate.alias(f"{position}_{name}")
        for position, of_column in enumerate(measures.values())
        for name, aggregate in of_column.items()
    ]
    rows = [
        F.struct(
            F.lit(column).alias("column"),
            *(F.col(f"{position}_{name}").alias(name) for name in of_column),
        )
        for position, (column, of_column) in enumerate(measures.items())
    ]
    return df.agg(*flat).select(F.inline(F.array(*rows)))


def numeric_summary(
    df: DataFrame,
    columns: list[str] | None = None,
    *,
    digits: int | None = MEAN_DIGITS,
    quantiles: dict[str, float] | None = None,
    accuracy: int = 10000,
) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per numeric column.

    NaN counts as missing, as it does in a data frame of pandas. The figures are
    doubles; ``min_text`` and ``max_text`` give the range of whole and decimal
    numbers with all their digits. ``quantiles`` adds named approximate
    quantiles, from a mergeable summary in the same pass.
    """
    columns = numeric_columns(df) if columns is None else columns
    names, probabilities = list(quantiles or {}), list((quantiles or {}).values())

    exact = (T.IntegralType, T.DecimalType)

    def bound(column: str, of) -> Column:
        if isinstance(df.schema[column].dataType, exact):
            return of(quoted(column)).cast("string")
        return F.any_value(F.lit(None).cast("string"))

    def measures(column: str) -> dict[str, Column]:
        value = F.nanvl(quoted(column).cast("double"), F.lit(None))
        moments = {
            "count": F.count(value),
            "mean": rounded(F.avg(value), digits),
            "stddev": rounded(F.stddev_samp(value), digits),
            "min": F.min(value),
            "max": F.max(value),
            "min_text": bound(column, F.min),
            "max_text": bound(column, F.max),
        }
        for index, name in enumerate(names):
            summary = F.percentile_approx(value, probabilities, accuracy)
            moments[name] = F.get(summary, F.lit(index))
        return moments

    return one_row_per_column(df, {c: measures(c) for c in columns})


def dataset_facts(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Size and period of the data set as (fact, value) rows.

    Ratings are reduced to one row per user first, which yields the number of
    users and all the rest in the same shuffle.
    """
    per_user = ratings.groupBy("userId").agg(
        F.count(F.lit(1)).alias("n"), F.min("year").alias("first"), F.max("year").alias("last")
    )
    from_ratings = per_user.agg(
        F.sum("n").alias("ratings"),
        F.count("userId").alias("users"),
        F.min("first").cast("bigint").alias("first_year"),
        F.max("last").cast("bigint").alias("last_year"),
    ).unpivot([], ["ratings", "users", "first_year", "last_year"], "fact", "value")
    from_movies = movies.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("movies").alias("fact"), "value"
    )
    return from_movies.unionByName(from_ratings)


def mean_rows_per_key(df: DataFrame, key: str, *, digits: int = 2) -> DataFrame:
    """Number of keys and mean number of rows of a key."""
    return histogram(df, key).agg(
        F.count(F.lit(1)).alias("n_keys"), F.round(F.avg("n"), digits).alias("mean_rows")
    )


def null_share(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), tally(F.col(column).isNull()).alias("n_null")
    ).withColumn("pct_null", percent(F.col("n_null"), F.col("n_rows")))
