"""Joins to dimensions, list expansion and referential checks."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, functions as F, types as T

from cinetally.functions.columns import list_items, percent
from cinetally.schemas import LIST_SEPARATOR, NO_GENRE

BROADCAST_LIMIT = 64 * 1024 * 1024

_FIXED_WIDTH = (
    T.BooleanType,
    T.NumericType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Measure the frame with one aggregate and compare it with the limit in bytes.

    Only flat columns have a size this can vouch for; with any other the answer is no.
    """
    texts = []
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.sum(F.octet_length(F.col(f"`{field.name}`"))))
        elif not isinstance(field.dataType, _FIXED_WIDTH):
            return False
    # Sixteen bytes for each row and for each value, and the text itself.
    n_rows, *text_bytes = df.agg(F.count(F.lit(1)), *texts).collect()[0]
    size = n_rows * 16 * (1 + len(df.columns)) + sum(b or 0 for b in text_bytes)
    return size <= limit


def measured_strategy(dimension: DataFrame, strategy: str, limit: int = BROADCAST_LIMIT) -> str:
    """``broadcast`` becomes ``measured`` or, with a warning, ``auto``; others stay.

    For callers that join one dimension several times: it is measured once.
    """
    if strategy != "broadcast":
        return strategy
    if fits_broadcast(dimension, limit):
        return "measured"
    warnings.warn(f"not broadcast: the dimension takes more than {limit} bytes", stacklevel=3)
    return "auto"


def attach(
    left: DataFrame,
    dimension: DataFrame,
    on: str,
    *,
    how: str = "left",
    strategy: str = "auto",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Equi-join to a dimension.

    ``auto`` leaves the choice to Spark, which knows the sizes of files and,
    later, of shuffled data. ``broadcast`` runs a job at once that measures the
    dimension; beyond the limit it warns and goes on as ``auto``. ``measured``
    broadcasts what the caller has measured (see ``measured_strategy``).
    ``merge`` asks for a sort-merge join.
    """
    strategy = measured_strategy(dimension, strategy, broadcast_limit)
    if strategy == "measured":
        dimension = F.broadcast(dimension)
    elif strategy == "merge":
        dimension = dimension.hint("merge")
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy: {strategy}")
    return left.join(dimension, on, how)


def explode_list(
    df: DataFrame,
    column: str = "genres",
    alias: str = "genre",
    *,
    separator: str = LIST_SEPARATOR,
    drop: str | None = NO_GENRE,
) -> DataFrame:
    """One row per list item in place of the list; a NULL list gives no row."""
    others = [c for c in df.columns if c != column]
    items = list_items(F.col(column), separator, drop)
    return df.select(*others, F.explode(items).alias(alias))


def attach_items(
    left: DataFrame,
    dimension: DataFrame,
    on: str,
    column: str = "genres",
    alias: str = "genre",
    *,
    carry: tuple[str, ...] = (),
    separator: str = LIST_SEPARATOR,
    drop: str | None = NO_GENRE,
    keep_unmatched: bool = True,
    strategy: str = "auto",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Left rows with each item of the dimension's list, and the carried columns.

    The same rows as a left join to the exploded dimension, but the lists are
    expanded behind the join: one dimension row per key is moved, not one per
    item. Left rows without an item stay once, with NULL in all added columns.
    """
    joined = attach(
        left,
        dimension.select(on, *carry, column),
        on,
        strategy=strategy,
        broadcast_limit=broadcast_limit,
    )
    items = list_items(F.col(column), separator, drop)
    expand = F.explode_outer if keep_unmatched else F.explode
    expanded = joined.select(*left.columns, *carry, expand(items).alias(alias))
    with_item = F.col(alias).isNotNull()
    return expanded.withColumns({c: F.when(with_item, F.col(c)) for c in carry})


def orphan_keys(facts: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Keys of the fact table that the dimension lacks, with their row counts.

    Facts are counted by key before the join, so a hot key is one row in it.
    """
    used = facts.groupBy(on).agg(F.count(F.lit(1)).alias("n_rows"))
    return used.join(dimension.select(on), on, "left_anti")


def coverage(dimension: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """How many dimension rows the facts refer to, of how many."""
    used = facts.select(on).distinct().withColumn("used", F.lit(True))
    return (
        dimension.select(on)
        .join(used, on, "left")
        .agg(F.count(F.lit(1)).alias("n_total"), F.count("used").alias("n_covered"))
        .withColumn("pct_covered", percent(F.col("n_covered"), F.col("n_total"), 2))
    )
