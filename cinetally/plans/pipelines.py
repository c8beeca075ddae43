"""Bronze to silver and silver to gold.

Tables that do not depend on each other are written at the same time: the
small ones fill the gaps the large one leaves on the cluster.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cinetally.functions.columns import percent
from cinetally.operators.cleaning import calendar_columns, clean, cleaning_report
from cinetally.operators.joins import measured_strategy
from cinetally.plans.reports import (
    best_movies_of,
    genre_ratings_of,
    movie_means,
    top_movies_per_genre_of,
)
from cinetally.plans.reuse import cached
from cinetally.schemas import CALENDAR, SPECS, TAGS, TableSpec
from cinetally.sources.readers import UNPARSED, parsed, read_bronze, read_silver, read_silver_tables, rejected
from cinetally.sources.writers import Written, verify_content, verify_readback, write_csv, write_parquet

_Result = TypeVar("_Result")


def read_bronze_tables(
    spark: SparkSession, folder: str, specs: dict[str, TableSpec] = SPECS, **options: object
) -> dict[str, DataFrame]:
    return {
        name: read_bronze(spark, spec, f"{folder}/{name}.csv", **options)
        for name, spec in specs.items()
    }


@dataclass(frozen=True)
class TableRun:
    """What became of a table on its way to silver: rows scanned, rows that did not parse, and what was written."""

    scanned: int
    unparsed: int
    written: Written


def bronze_to_silver(bronze: dict[str, DataFrame], folder: str, specs: dict[str, TableSpec] = SPECS, **options: object) -> dict[str, int]:
    """``clean_to_silver``; returns the rows written."""
    return {name: run.written.rows for name, run in clean_to_silver(bronze, folder, specs, **options).items()}


def clean_to_silver(
    bronze: dict[str, DataFrame],
    folder: str,
    specs: dict[str, TableSpec] = SPECS,
    *,
    keep_optional_nulls: bool = True,
    fold_case: bool = False,
    files: dict[str, int] | None = None,
    gather: bool = True,
    rejects: str | None = None,
) -> dict[str, TableRun]:
    """Clean and write every table.

    Each source is evaluated once, by its write: the rows are counted below the de-duplication, on
    their way from the scan, and above all else, on their way to the files. The count of the scan is
    taken in tasks that feed a shuffle; if an executor is lost and such tasks run again, it is too high by their
    rows, never too low (``silver_report`` counts anew). ``fold_case`` concerns tags only; ``files`` may limit the number of
    files of small tables; ``gather`` is that of ``write_parquet``.

    Of tables read with ``rejects=True`` the lines that do not parse are
    counted apart and take no part. ``rejects`` names a folder for them, one of text files per
    table that has any; only such tables are read again for it.
    """
    def writer(name: str, df: DataFrame) -> Callable[[], TableRun]:
        spec = specs[name]
        # Of the calendar only what the files are parted by crosses the shuffle.
        needed = tuple(c for c in CALENDAR if c in spec.partition_by)
        checked = UNPARSED in df.columns
        seen = Observation()
        bad = F.count(UNPARSED) if checked else F.sum(F.lit(0))
        scanned = df.observe(seen, F.count(F.lit(1)).alias("rows"), bad.alias("unparsed"))
        silver = clean(
            parsed(scanned) if checked else scanned,
            spec,
            keep_optional_nulls=keep_optional_nulls,
            fold_case=fold_case and name == TAGS.name,
            calendar_fields=needed,
        )

        def complete(rows: DataFrame) -> DataFrame:
            rest = tuple(c for c in CALENDAR if c not in needed)
            rows = calendar_columns(rows, spec.epoch, rest) if spec.calendar else rows
            return rows.select(*spec.silver_schema().fieldNames())

        def run() -> TableRun:
            content = Observation()
            rows = write_parquet(
                silver,
                f"{folder}/{name}",
                partition_by=spec.partition_by,
                files=(files or {}).get(name),
                derive=complete,
                gather=gather,
                content=content,
            )
            counts = _counted(seen)
            if rejects is not None and counts["unparsed"]:
                rejected(df).write.mode("overwrite").text(f"{rejects}/{name}")
            return TableRun(counts["rows"], counts["unparsed"], Written(rows, str(content.get["digest"] or 0)))

        return run

    spark = next(iter(bronze.values())).sparkSession
    return _together(spark, {name: writer(name, df) for name, df in bronze.items()})


def _counted(seen: Observation) -> dict[str, int]:
    """What was counted below a shuffle. A scan that the optimizer knows to be empty is left out, and its observation stays without fields."""
    if seen._jo.getRow().schema() is None:
        return {"rows": 0, "unparsed": 0}
    return {name: value or 0 for name, value in seen.get.items()}


def run_report(spark: SparkSession, runs: dict[str, TableRun]) -> DataFrame:
    """Rows before and after cleaning per table and in total, with those that did not parse apart from those removed.

    From the counts of the run; nothing is read for it.
    """
    rows = [(name, run.scanned, run.unparsed, run.written.rows) for name, run in runs.items()]
    rows.append(("total", *(sum(row[i] for row in rows) for i in (1, 2, 3))))
    counts = spark.createDataFrame(rows, "`table` string, n_before bigint, n_unparsed bigint, n_after bigint")
    removed = F.col("n_before") - F.col("n_unparsed") - F.col("n_after")
    return counts.select(
        "table", "n_before", "n_unparsed", "n_after", removed.alias("n_removed"),
        percent(F.col("n_unparsed"), F.col("n_before")).alias("pct_unparsed"), percent(removed, F.col("n_before")).alias("pct_removed"),
    )


def verify_silver_content(
    spark: SparkSession, folder: str, runs: dict[str, TableRun], specs: dict[str, TableSpec] = SPECS
) -> DataFrame:
    """Rows and content of the silver files against what the run wrote."""
    tables = read_silver_tables(spark, folder, {name: specs[name] for name in runs})
    return verify_content(spark, {name: (tables[name], run.written) for name, run in runs.items()})


def _together(spark: SparkSession, jobs: dict[str, Callable[[], _Result]]) -> dict[str, _Result]:
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = {name: pool.submit(in_session(job)) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def verify_silver(
    spark: SparkSession,
    folder: str,
    written: dict[str, int],
    specs: dict[str, TableSpec] = SPECS,
) -> DataFrame:
    tables = read_silver_tables(spark, folder, specs)
    return verify_readback(spark, {name: (tables[name], rows) for name, rows in written.items()})


def silver_report(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    folder: str,
    specs: dict[str, TableSpec] = SPECS,
) -> DataFrame:
    """Cleaning report whose counts after cleaning come from the silver files."""
    return cleaning_report(bronze, read_silver_tables(spark, folder, specs))


# Names of the gold tables, fixed.
GOLD_TABLES = ("analysis1_best_films", "analysis2_avg_by_genre", "analysis3_top3_by_genre")


def silver_to_gold(
    spark: SparkSession,
    silver_folder: str,
    gold_folder: str,
    specs: dict[str, TableSpec] = SPECS,
    *,
    min_votes: int = 50,
    min_votes_per_genre: int = 5,
    k: int = 10,
    n: int = 3,
    strategy: str = "auto",
    files: int | None = None,
) -> dict[str, int]:
    """Run the analyses over silver and write each as CSV; returns the rows written.

    All three start from the means per movie, which are kept for the duration:
    the ratings are read and shuffled once.
    """
    ratings = read_silver(spark, silver_folder, specs["ratings"])
    movies = read_silver(spark, silver_folder, specs["movies"])
    strategy = measured_strategy(movies, strategy)
    with cached(movie_means(ratings), eager=True) as means:
        results = (
            best_movies_of(means, movies, min_votes=min_votes, k=k, strategy=strategy),
            genre_ratings_of(means, movies, strategy=strategy),
            top_movies_per_genre_of(
                means, movies, min_votes=min_votes_per_genre, n=n, strategy=strategy
            ),
        )

        def writer(name: str, result: DataFrame) -> Callable[[], int]:
            return lambda: write_csv(result, f"{gold_folder}/{name}", files=files)

        return _together(
            spark, {name: writer(name, result) for name, result in zip(GOLD_TABLES, results)}
        )
