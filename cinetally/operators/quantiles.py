"""Exact quantiles and moments without gathering a column in one task.

``ordered_counts`` makes the only pass over the table. The rest works on what
it has written: one row per distinct value of each column, in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from cinetally.functions.columns import quoted, rounded
from cinetally.sources.scratch import Scratch


def ordered_counts(
    df: DataFrame, columns: list[str], scratch: Scratch, *, kind: str = "double"
) -> DataFrame:
    """Written (column, value, n, slice) rows; NULL and NaN are left out.

    Values are cast to ``kind``; as doubles, whole numbers beyond 2**53 are rounded.

    Slices are ranges of (column, value), about equal in rows, so a column
    spreads over as many as it has values for. Copies of a value are counted
    before the first shuffle.
    """
    pairs = [
        F.struct(F.lit(c).alias("column"), quoted(c).cast(kind).alias("value")) for c in columns
    ]
    value = F.col("value")
    counted = (
        df.select(F.inline(F.array(*pairs)))
        .filter(value.isNotNull() & ~F.isnan(value))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return scratch.table(
        counted.repartitionByRange("column", "value").withColumn("slice", F.spark_partition_id()),
        "ordered",
    )


def quantiles_of(
    counts: DataFrame, probabilities: tuple[float, ...], *, digits: int | None = 6
) -> DataFrame:
    """(column, p, quantile) with linear interpolation, from ``ordered_counts``."""
    fraction = F.col("at") - F.floor("at")
    quantile = F.col("lower") + (F.col("upper") - F.col("lower")) * fraction
    found = order_statistics(counts, probabilities)
    return found.select("column", "p", rounded(quantile, digits).alias("quantile"))


def order_statistics(counts: DataFrame, probabilities: tuple[float, ...]) -> DataFrame:
    """(column, p, at, lower, upper): the position of a quantile and the values on either side of it.

    Slice totals tell which slices hold the wanted positions, and only those
    are read again in order.
    """
    # At most two rows for each column and probability, so small enough to
    # broadcast, once to pick the slices and once to pick the rows in them.
    wanted = _wanted_positions(counts, probabilities)
    picked = counts.join(
        F.broadcast(wanted.select("column", "slice")), ["column", "slice"], "left_semi"
    )
    within = Window.partitionBy("column", "slice").orderBy("value")
    until = F.col("row_in_slice") < F.col("n_until")
    since = F.col("row_in_slice") >= F.col("n_until") - F.col("n")
    numbered = picked.withColumn("n_until", F.sum("n").over(within)).alias("v")
    same_slice = (F.col("v.column") == F.col("w.column")) & (F.col("v.slice") == F.col("w.slice"))
    hits = numbered.join(F.broadcast(wanted.alias("w")), same_slice & since & until)
    return (
        hits.select("v.column", "value", "p", "at")
        .groupBy("column", "p", "at")
        .agg(F.min("value").alias("lower"), F.max("value").alias("upper"))
    )


def typed_quantiles(
    df: DataFrame, columns: list[str], probabilities: tuple[float, ...], scratch: Scratch
) -> DataFrame:
    """(column, p, lower, upper, quantile) of whole and decimal numbers, as texts with all their digits.

    ``lower`` and ``upper`` are the values on either side of the position, in
    the column's own type. The quantile between them is exact where the position is a
    multiple of a millionth; trailing zeros are left out. A column without values has no rows.
    """
    of_type: dict[str, list[str]] = {}
    for column in columns:
        kind = df.schema[column].dataType
        if not isinstance(kind, (T.IntegralType, T.DecimalType)):
            raise ValueError(f"{column} holds no whole or decimal numbers")
        name = kind.simpleString() if isinstance(kind, T.DecimalType) else "bigint"
        of_type.setdefault(name, []).append(column)

    def texts(kind: str, own: list[str]) -> DataFrame:
        found = order_statistics(ordered_counts(df, own, scratch, kind=kind), probabilities)
        share = F.round(F.col("at") - F.floor("at"), 6).cast("decimal(7,6)")
        low, high = (F.col(c).cast("decimal(30,9)") for c in ("lower", "upper"))
        between = (low * (1 - share) + high * share).cast("string")
        return found.select(
            "column",
            "p",
            F.col("lower").cast("string").alias("lower"),
            F.col("upper").cast("string").alias("upper"),
            F.regexp_replace(between, r"\.?0+$", "").alias("quantile"),
        )

    return reduce(DataFrame.unionByName, [texts(kind, own) for kind, own in of_type.items()])


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: tuple[float, ...],
    scratch: Scratch,
    *,
    digits: int | None = 6,
) -> DataFrame:
    return quantiles_of(ordered_counts(df, columns, scratch), probabilities, digits=digits)


def moments_of(counts: DataFrame, *, digits: int | None = 6) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per column."""
    value, n = F.col("value"), F.col("n")
    overall = counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        (F.sum(value * n) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # One row per column on the broadcast sides. Deviations are taken from the
    # mean, since a difference of large sums of squares would lose digits.
    spread = (
        counts.join(F.broadcast(overall.select("column", "mean")), "column")
        .groupBy("column")
        .agg(F.sum(n * F.pow(value - F.col("mean"), F.lit(2))).alias("squares"))
    )
    stddev = F.sqrt(F.try_divide(F.col("squares"), F.col("count") - 1))
    return overall.join(F.broadcast(spread), "column").select(
        "column",
        "count",
        rounded(F.col("mean"), digits).alias("mean"),
        rounded(stddev, digits).alias("stddev"),
        "min",
        "max",
    )


def _wanted_positions(counts: DataFrame, probabilities: tuple[float, ...]) -> DataFrame:
    """The wanted rows, counted from zero in their slice, for each column and p."""
    whole = Window.partitionBy("column")
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        counts.groupBy("column", "slice")
        .agg(F.sum("n").alias("n_slice"))
        .withColumn("n_before", F.coalesce(F.sum("n_slice").over(earlier), F.lit(0)))
        .withColumn("n_column", F.sum("n_slice").over(whole))
    )
    positions = [
        F.struct(F.lit(p).alias("p"), at.alias("at"), side(at).alias("row"))
        for p in probabilities
        for at in [F.lit(p) * (F.col("n_column") - 1)]
        for side in (F.floor, F.ceil)
    ]
    row_in_slice = F.col("row") - F.col("n_before")
    return (
        spans.select("*", F.inline(F.array(*positions)))
        .withColumn("row_in_slice", row_in_slice)
        .filter((F.col("row_in_slice") >= 0) & (F.col("row_in_slice") < F.col("n_slice")))
        .select("column", "slice", "p", "at", "row_in_slice")
    )
