"""Command line of the pipeline, to be started with spark-submit.

    spark-submit cinetally/jobs.py ingest  --bronze DIR
    spark-submit cinetally/jobs.py clean   --bronze DIR --silver DIR
    spark-submit cinetally/jobs.py analyse --silver DIR --gold DIR
    spark-submit cinetally/jobs.py explore --silver DIR --year 2009
    spark-submit cinetally/jobs.py profile --bronze DIR

Master and resources are left to spark-submit. Bronze tables are
``movies.csv``, ``ratings.csv``, ``tags.csv`` and ``links.csv`` (files or
folders) in the bronze folder.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from cinetally.operators import aggregates, associations, checks, profiling  # noqa: E402
from cinetally.plans import pipelines, reports, reuse  # noqa: E402
from cinetally.schemas import SPECS, TableSpec, wide_keys  # noqa: E402
from cinetally.sources.readers import read_silver, read_silver_tables  # noqa: E402
from cinetally.sources.scratch import Scratch  # noqa: E402
from cinetally.sources.writers import write_csv  # noqa: E402


def ingest(spark: SparkSession, args: argparse.Namespace, specs: dict[str, TableSpec]) -> None:
    """Counts, columns and first rows of the bronze tables, and a summary of ratings."""
    tables = pipelines.read_bronze_tables(spark, args.bronze, specs)
    _report(args, "rows", aggregates.row_counts(tables))
    for name, df in tables.items():
        _report(args, f"{name}: columns", profiling.schema_report(df))
        _report(args, f"{name}: first rows", profiling.first_rows(df, list(specs[name].key), 5))
    _report(args, "ratings: summary", aggregates.numeric_summary(tables["ratings"]))


def clean(spark: SparkSession, args: argparse.Namespace, specs: dict[str, TableSpec]) -> None:
    """Bronze to silver, with the cleaning report and a check of what was written."""
    tables = pipelines.read_bronze_tables(spark, args.bronze, specs, rejects=True)
    runs = pipelines.clean_to_silver(
        tables,
        args.silver,
        specs,
        keep_optional_nulls=not args.strict_links,
        fold_case=args.fold_case,
        rejects=args.rejects,
    )
    silver = read_silver_tables(spark, args.silver, specs)
    _report(args, "written and read back", pipelines.verify_silver_content(spark, args.silver, runs, specs))
    _report(args, "cleaning", pipelines.run_report(spark, runs))
    _report(args, "ratings: range", aggregates.value_range(silver["ratings"], "rating", "year"))
    _report(args, "links without tmdbId", aggregates.null_share(silver["links"], "tmdbId"))
    _report(args, "quality", checks.quality_scorecard(silver, specs))


def analyse(spark: SparkSession, args: argparse.Namespace, specs: dict[str, TableSpec]) -> None:
    """Silver to gold."""
    written = pipelines.silver_to_gold(
        spark,
        args.silver,
        args.gold,
        specs,
        min_votes=args.min_votes,
        min_votes_per_genre=args.min_votes_per_genre,
        k=args.k,
        n=args.n,
        strategy=args.strategy,
        files=args.files,
    )
    for name in written:
        _report(args, name, spark.read.csv(f"{args.gold}/{name}", header=True))
    silver = read_silver_tables(spark, args.silver, specs)
    _report(args, "data", aggregates.dataset_facts(silver["movies"], silver["ratings"]))
    means = reports.movie_means(silver["ratings"])
    _report(args, "movies with enough votes", reports.eligible_movies(means, args.min_votes))
    _report(args, "genres", reports.genre_counts(silver["movies"]))


def explore(spark: SparkSession, args: argparse.Namespace, specs: dict[str, TableSpec]) -> None:
    """Four questions about ratings over one cached frame."""
    ratings = read_silver(spark, args.silver, specs["ratings"])
    with reuse.cached(reuse.rating_cube(ratings)) as cube:
        _report(
            args, "query batch", reuse.query_batch(cube, year=args.year, min_rating=args.min_rating)
        )


def profile(spark: SparkSession, args: argparse.Namespace, specs: dict[str, TableSpec]) -> None:
    """Column profiles of the bronze tables."""
    tables = pipelines.read_bronze_tables(spark, args.bronze, specs)
    _report(args, "missing values", profiling.profile_tables(tables))
    with Scratch(spark) as scratch:
        for name, df in tables.items():
            keys = list(specs[name].key)
            labelled = profiling.keys_as_labels(df, ("userId", "movieId"))
            _report(args, f"{name}: shape", profiling.shape(df))
            _report(args, f"{name}: last rows", profiling.last_rows(df, keys))
            _report(args, f"{name}: sample", profiling.sample_rows(df, keys))
            if len(aggregates.numeric_columns(labelled)) > 1:
                _report(args, f"{name}: correlations", associations.correlations(labelled))
            if aggregates.numeric_columns(labelled):
                _report(
                    args, f"{name}: numbers", profiling.summary_with_quartiles(labelled, scratch)
                )
            _report(args, f"{name}: duplicates", profiling.duplicates(df))
            _report(args, f"{name}: frequent values", profiling.top_values(df))


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Ratings lakehouse jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(run, *folders: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__, help=run.__doc__)
        sub.set_defaults(run=run)
        for folder in folders:
            sub.add_argument(f"--{folder}", required=True)
        sub.add_argument("--wide-keys", action="store_true", help="64-bit ids")
        sub.add_argument("--time-zone", default="UTC")
        sub.add_argument("--out", help="folder for the reports as CSV; printed without it")
        return sub

    job(ingest, "bronze")
    cleaning = job(clean, "bronze", "silver")
    cleaning.add_argument("--strict-links", action="store_true", help="drop links without tmdbId")
    cleaning.add_argument("--fold-case", action="store_true", help="tags in lower case")
    cleaning.add_argument("--rejects", help="folder for the lines that do not parse")
    analysis = job(analyse, "silver", "gold")
    analysis.add_argument("--min-votes", type=int, default=50)
    analysis.add_argument("--min-votes-per-genre", type=int, default=5)
    analysis.add_argument("--k", type=int, default=10)
    analysis.add_argument("--n", type=int, default=3)
    analysis.add_argument("--strategy", choices=["auto", "broadcast", "merge"], default="auto")
    analysis.add_argument("--files", type=int, help="files per gold table")
    exploration = job(explore, "silver")
    exploration.add_argument("--year", type=int, default=2009)
    exploration.add_argument("--min-rating", type=float, default=4.0)
    job(profile, "bronze")

    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"ratings {args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    args.run(spark, args, wide_keys() if args.wide_keys else SPECS)


def _report(args: argparse.Namespace, title: str, df: DataFrame) -> None:
    """Print a report whole, or write it as CSV to a folder of its own under ``--out``."""
    if args.out:
        write_csv(df, f"{args.out}/{re.sub('[^a-z0-9]+', '-', title.lower())}")
        return
    print(f"\n{title}")
    # Reports have a row per column, table or group.
    df.show(df.count(), truncate=False)


if __name__ == "__main__":
    main()
