"""Sinks. Each returns the number of rows it wrote, counted by the write job itself."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cinetally.functions.columns import quoted


@dataclass(frozen=True)
class Written:
    """What a write put into its files: the rows, and the digest of their content."""

    rows: int
    digest: str


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    partition_by: tuple[str, ...] = (),
    files: int | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    gather: bool = True,
    content: Observation | None = None,
    mode: str = "overwrite",
) -> int:
    """Write Parquet, by default in as many files as adaptive execution finds fit.

    For a partitioned table the rows of a partition value are first brought
    together, else every task would leave a small file in every directory.
    ``rebalance`` lets adaptive execution split a value that holds a large
    share of all rows into several tasks, so none of them has to take it whole.
    ``gather=False`` leaves the rows where they are instead: each task sorts its own by the
    partition columns and writes one file per value it holds. That saves a shuffle
    of all rows and costs up to tasks times values files.

    ``files`` deals the rows to that many writing tasks, behind all other work.
    It does not go together with ``partition_by``, where ``rebalance`` decides.
    ``derive`` adds columns behind the shuffle, which then need not cross it.
    ``content`` gets the ``content_digest`` of the rows as ``digest``.
    """
    if partition_by and files is not None:
        raise ValueError("files and partition_by exclude each other")
    if partition_by and gather:
        df = df.hint("rebalance", *partition_by)
    if files is not None:
        df = df.repartition(files)
    if derive is not None:
        df = derive(df)
    if partition_by and not gather:
        df = df.sortWithinPartitions(*partition_by)
    if content is not None:
        df = df.observe(content, content_digest(df.columns).alias("digest"))
    df, seen = _observed(df)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def write_parquet_checked(df: DataFrame, path: str, **options: object) -> Written:
    """``write_parquet``, and the digest of what it wrote."""
    content = Observation()
    rows = write_parquet(df, path, content=content, **options)
    return Written(rows, str(content.get["digest"] or 0))


def write_csv(
    df: DataFrame, path: str, *, files: int | None = None, mode: str = "overwrite", **options: object
) -> int:
    """Write headed CSV. Outer spaces stay; NULL and empty text both read back as NULL.

    A sorted frame keeps its order across the files, and inside the one file
    of ``files=1``: its sorted parts are read one after the other. Quotes
    inside fields are doubled.
    """
    if files is not None:
        df = df.coalesce(files)
    df, seen = _observed(df)
    settings = {
        "header": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        **options,
    }
    df.write.mode(mode).options(**settings).csv(path)
    return seen.get["rows"]


def verify_readback(
    spark: SparkSession, written: dict[str, tuple[DataFrame, int]]
) -> DataFrame:
    """Compare what each table holds on re-reading with what its write counted."""
    checks = [
        stored.agg(F.count(F.lit(1)).alias("n_read")).select(
            F.lit(name).alias("table"),
            F.lit(rows).cast("bigint").alias("n_written"),
            "n_read",
            (F.col("n_read") == F.lit(rows)).alias("matches"),
        )
        for name, (stored, rows) in written.items()
    ]
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report


def content_digest(columns: list[str]) -> Column:
    """Aggregate: a number for the rows as a whole, whatever their order and the order of their columns.

    It is the sum of a 64-bit hash per row, so copies count as often as they occur. The hash takes in
    which values are NULL, and tells empty text from NULL.
    """
    values = [v for c in sorted(columns) for v in (quoted(c).isNull(), quoted(c))]
    return F.sum(F.xxhash64(*values).cast("decimal(38,0)"))


def verify_content(spark: SparkSession, written: dict[str, tuple[DataFrame, Written]]) -> DataFrame:
    """(table, n_written, n_read, same_rows, same_content): what was written against what the files hold now.

    The write digests the rows on their way to the files; the same digest is taken of the files.
    A lost, doubled, added or changed row shows, also where the number of rows is right.
    """
    checks = [
        stored.agg(
            F.count(F.lit(1)).alias("n_read"),
            F.coalesce(content_digest(stored.columns).cast("string"), F.lit("0")).alias("digest"),
        ).select(
            F.lit(name).alias("table"),
            F.lit(was.rows).cast("bigint").alias("n_written"),
            "n_read",
            (F.col("n_read") == F.lit(was.rows)).alias("same_rows"),
            (F.col("digest") == F.lit(was.digest)).alias("same_content"),
        )
        for name, (stored, was) in written.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    # The metric sits in the last stage, right under the writer. Spark counts a
    # result task once even if it is retried; further up, behind a shuffle, a
    # rerun map task would be counted twice.
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
