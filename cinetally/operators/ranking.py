"""Top-k, top-n per group and complete numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cinetally.sources.scratch import Scratch


def best_first(mean: str = "avg_rating", votes: str = "num_votes", key: str = "movieId") -> list[Column]:
    """A total order: higher mean, then more votes, then smaller key."""
    return [F.desc_nulls_last(mean), F.desc_nulls_last(votes), F.asc_nulls_first(key)]


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows; every task keeps k at most, nothing is sorted globally."""
    return df.orderBy(*order).limit(k)


def top_n_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, *, rank: str = "rank"
) -> DataFrame:
    """Numbered first n rows of each group.

    The bare ``row_number() <= n`` lets Catalyst cut every group to n rows per
    task before the shuffle, so a group of any size stays small behind it.
    """
    within = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(within)).filter(F.col(rank) <= n)


def row_numbers(
    df: DataFrame, group: list[str], order: list[Column], scratch: Scratch, *, rank: str = "rank"
) -> DataFrame:
    """Number all rows of each group in order.

    A window would sort a whole group in one task. Here the rows are range
    partitioned by group and order, which cuts large groups into slices, and
    written with their position in the slice. A row's number is that position
    plus what the group has in earlier slices, taken from one small aggregate.
    ``order`` should be total, else equal rows are numbered arbitrarily.
    """
    layout = [F.asc_nulls_first(c) for c in group] + order
    position = "row_position"
    stored = scratch.table(
        df.repartitionByRange(*layout)
        .sortWithinPartitions(*layout)
        .withColumn(position, F.monotonically_increasing_id()),
        "slices",
    )
    # The upper bits of the generated id are the partition: the slice.
    slice_of = F.shiftright(position, 33)
    earlier = (
        Window.partitionBy(*group)
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        stored.groupBy(*group, slice_of.alias("slice"))
        .agg(F.min(position).alias("first_position"), F.count(F.lit(1)).alias("n_slice"))
        .withColumn("n_before", F.coalesce(F.sum("n_slice").over(earlier), F.lit(0)))
        .select(
            *(F.col(c).alias(f"start_{c}") for c in group),
            F.col("slice").alias("start_slice"),
            "first_position",
            "n_before",
        )
    )
    same_slice = slice_of == F.col("start_slice")
    for c in group:
        same_slice = same_slice & F.col(c).eqNullSafe(F.col(f"start_{c}"))
    number = F.col(position) - F.col("first_position") + F.col("n_before") + 1
    return stored.join(starts, same_slice).select(*df.columns, number.alias(rank))
