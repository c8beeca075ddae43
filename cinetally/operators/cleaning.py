"""Bronze-to-silver steps and the cleaning driven by a table specification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cinetally.functions.columns import calendar, instant, percent
from cinetally.schemas import CALENDAR, LINKS, MOVIES, RATINGS, TAGS, TableSpec


def dedup_by_key(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per key: the smallest payload, NULLs after values.

    Unlike an arbitrary survivor the result does not depend on task order.
    Written as an aggregate, so copies of a hot key collapse before the shuffle.
    NULL keys form a group of their own.
    """
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct().select(*df.columns)
    if len(payload) == 1:
        kept = df.groupBy(*keys).agg(F.min(payload[0]).alias(payload[0]))
        return kept.select(*df.columns)
    # A struct is compared field by field and puts NULL first; the flag ahead
    # of each value turns that round.
    fields = [
        field
        for c in payload
        for field in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(c))
    ]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("kept"))
    return kept.select(*(c if c in keys else F.col(f"kept.{c}").alias(c) for c in df.columns))


def drop_null_keys(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows with a value in every one of the columns.

    One condition per column: Catalyst moves those on grouping keys below a
    de-duplication, down to the scan, so NULL keys are never shuffled.
    """
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def in_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows inside the closed range; NULL is outside."""
    return df.filter(F.col(column).between(low, high))


def trim_columns(df: DataFrame, columns: tuple[str, ...], *, fold_case: bool = False) -> DataFrame:
    """Strip outer spaces (spaces only), optionally in lower case."""
    def tidy(name: str):
        stripped = F.trim(name)
        return F.lower(stripped) if fold_case else stripped

    return df.withColumns({c: tidy(c) for c in columns})


def epoch_to_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.withColumn(column, instant(F.col(column)))


def calendar_columns(
    df: DataFrame, column: str = "timestamp", fields: tuple[str, ...] = CALENDAR
) -> DataFrame:
    every = calendar(F.col(column))
    return df.withColumns({name: every[name] for name in fields})


def clean(
    df: DataFrame,
    spec: TableSpec,
    *,
    keep_optional_nulls: bool = True,
    fold_case: bool = False,
    calendar_fields: tuple[str, ...] = CALENDAR,
) -> DataFrame:
    """Silver rows of a bronze table.

    Duplicates go first, so the rules that follow judge the surviving row:
    a key whose smallest rating is out of range disappears with it. Only
    ``fold_case`` tidies text ahead of that, so that rows which differ in case
    or outer spaces alone become one.
    """
    if fold_case and spec.text:
        df = trim_columns(df, spec.text, fold_case=True)
    required = spec.required if keep_optional_nulls else spec.required + spec.optional
    df = drop_null_keys(dedup_by_key(df, spec.key), required)
    for column, low, high in spec.scale:
        df = in_range(df, column, low, high)
    if spec.text and not fold_case:
        df = trim_columns(df, spec.text)
    if spec.epoch:
        df = epoch_to_timestamp(df, spec.epoch)
    if spec.calendar:
        df = calendar_columns(df, spec.epoch, calendar_fields)
    return df


def clean_movies(df: DataFrame) -> DataFrame:
    return clean(df, MOVIES)


def clean_ratings(df: DataFrame) -> DataFrame:
    return clean(df, RATINGS)


def clean_tags(df: DataFrame, *, fold_case: bool = False) -> DataFrame:
    return clean(df, TAGS, fold_case=fold_case)


def clean_links(df: DataFrame, *, keep_optional_nulls: bool = True) -> DataFrame:
    return clean(df, LINKS, keep_optional_nulls=keep_optional_nulls)


def cleaning_report(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Rows before and after cleaning for each table and in total."""
    count = F.count(F.lit(1))
    nothing = F.lit(0).cast("bigint")
    sides = [
        df.agg(count.alias("n")).select(
            F.lit(name).alias("table"),
            (F.col("n") if column == "n_before" else nothing).alias("n_before"),
            (F.col("n") if column == "n_after" else nothing).alias("n_after"),
        )
        for column, tables in (("n_before", before), ("n_after", after))
        for name, df in tables.items()
    ]
    removed = F.col("n_before") - F.col("n_after")
    return (
        reduce(DataFrame.unionByName, sides)
        .rollup("table")
        .agg(F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after"))
        .select(
            F.coalesce("table", F.lit("total")).alias("table"),
            "n_before",
            "n_after",
            removed.alias("n_removed"),
            percent(removed, F.col("n_before")).alias("pct_removed"),
        )
    )
