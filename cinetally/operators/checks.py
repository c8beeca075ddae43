"""Data quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cinetally.functions.columns import percent, tally
from cinetally.operators.joins import orphan_keys
from cinetally.schemas import TableSpec

LINK = "movieId"

# Steps are counted in doubles.
ROUNDING = 1e-9
# Fixed pattern: a release year in parentheses at the end of a title.
YEAR_IN_TITLE = r"\(\d{4}\)\s*$"


def off_scale(df: DataFrame, column: str = "rating", step: float = 0.5) -> DataFrame:
    """How many values are no multiple of the step, but for the rounding of doubles."""
    steps = F.col(column) / F.lit(step)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        tally(F.abs(steps - F.round(steps)) > ROUNDING).alias("n_off_scale"),
    ).withColumn("pct_off_scale", percent(F.col("n_off_scale"), F.col("n_rows"), 2))


def titles_with_year(df: DataFrame, column: str = "title") -> DataFrame:
    return df.agg(
        F.count(column).alias("n_titles"),
        tally(F.col(column).rlike(YEAR_IN_TITLE)).alias("n_with_year"),
    ).withColumn("pct_with_year", percent(F.col("n_with_year"), F.col("n_titles"), 2))


def quality_scorecard(tables: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    """Completeness, uniqueness, validity and coherence of each table in percent.

    Completeness is the share of filled cells, uniqueness that of distinct
    keys among rows, validity that of in-range values among the values present
    (100 for a table without ranges), coherence that of rows whose movie exists
    among the rows that name one (100 for the movies themselves).
    """
    movies = tables.get("movies")
    return reduce(
        DataFrame.unionByName, [_score(df, specs[name], movies) for name, df in tables.items()]
    )


def _score(df: DataFrame, spec: TableSpec, movies: DataFrame | None) -> DataFrame:
    columns = spec.schema.fieldNames()
    filled = reduce(lambda a, b: a + b, [F.count(c) for c in columns])
    none = F.lit(0).cast("bigint")
    present = reduce(lambda a, b: a + b, [F.count(c) for c, _, _ in spec.scale], none)
    valid = reduce(
        lambda a, b: a + b, [tally(F.col(c).between(lo, hi)) for c, lo, hi in spec.scale], none
    )
    # By key first: duplicates collapse before the shuffle, and the number of
    # groups is the number of distinct keys.
    per_key = df.groupBy(*spec.key).agg(
        F.count(F.lit(1)).alias("n"),
        filled.alias("filled"),
        present.alias("present"),
        valid.alias("valid"),
    )
    total = per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("filled").alias("filled"),
        F.sum("present").alias("present"),
        F.sum("valid").alias("valid"),
    )
    n_rows = F.col("n_rows")
    total = total.withColumns({"n_linked": none, "n_orphans": none})
    if movies is not None and spec.name != "movies":
        linked = df.filter(F.col(LINK).isNotNull())
        lost = orphan_keys(linked, movies, LINK).agg(F.sum("n_rows").alias("n_orphans"))
        links = linked.agg(F.count(F.lit(1)).alias("n_linked"))
        # One row each, added up.
        parts = [total, *(p.select(*(F.col(c) if c in p.columns else none.alias(c) for c in total.columns)) for p in (lost, links))]
        total = reduce(DataFrame.unionByName, parts).agg(*(F.sum(c).alias(c) for c in total.columns))
    coherent = percent(F.col("n_linked") - F.col("n_orphans"), F.col("n_linked"), 2)
    return total.select(
        F.lit(spec.name).alias("table"),
        n_rows,
        percent(F.col("filled"), n_rows * len(columns), 2).alias("pct_complete"),
        percent(F.col("n_keys"), n_rows, 2).alias("pct_unique"),
        F.coalesce(percent(F.col("valid"), F.col("present"), 2), F.lit(100.0)).alias("pct_valid"),
        F.coalesce(coherent, F.lit(100.0)).alias("pct_coherent"),
    )
