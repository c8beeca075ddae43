"""Time the headline jobs and print one JSON line.

The first run of a job in the session is reported under ``first_run`` and the
median of the following ones under ``queries``. Caching is timed with the fill
included and in both orders. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set the
data, the threads and the number of repeats.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from cinetally.operators.aggregates import histogram, row_counts  # noqa: E402
from cinetally.operators.cleaning import calendar_columns, epoch_to_timestamp  # noqa: E402
from cinetally.plans import pipelines, reports, reuse  # noqa: E402
from cinetally.sources.readers import read_bronze, read_silver  # noqa: E402
from cinetally.sources.scratch import Scratch  # noqa: E402
from cinetally.sources.writers import write_csv  # noqa: E402
from cinetally.workload.fixtures import Fixtures  # noqa: E402
from cinetally.workload.queries import HIGH_RATING, MIN_VOTES, YEAR  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        # The jobs take turns; with the default of 100 entries each would find
        # its generated classes evicted by the others and compile them again.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cinetally-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(job: Callable[[], object]) -> float:
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def four_queries(ratings: DataFrame) -> None:
    """The exploration batch: two counts and two groupings, one action each."""
    parts = {
        "one_year": ratings.filter(F.col("year") == YEAR),
        "high": ratings.filter(F.col("rating") >= HIGH_RATING),
    }
    for name, rows in parts.items():
        row_counts({name: rows}).collect()
    for column in ("year", "rating"):
        histogram(ratings, column).collect()


def main() -> None:
    spark = session()
    with Scratch(spark) as scratch:
        data = Fixtures(spark, SF_DIR)
        folder, csv = scratch.path("silver"), scratch.path("csv")

        def silver(target: str | None = None) -> None:
            target = target or scratch.path("silver")
            pipelines.bronze_to_silver(data.bronze, target, data.specs)

        # Written once before the queries that read it.
        first_silver = seconds(lambda: silver(folder))
        write_csv(data.ratings_raw, csv)
        ratings = read_silver(spark, folder, data.specs["ratings"])
        movies = read_silver(spark, folder, data.specs["movies"])
        of_year = ratings.filter(F.col("year") == YEAR)

        def from_csv() -> DataFrame:
            raw = read_bronze(spark, data.specs["ratings"], csv, infer=True)
            return calendar_columns(epoch_to_timestamp(raw))

        def cached_filter() -> None:
            with reuse.cached(of_year.select("rating")) as held:
                held.count()
                held.count()

        def cached_four() -> None:
            with reuse.cached(from_csv().select("year", "rating"), eager=True) as held:
                four_queries(held)

        def cube_batch() -> None:
            with reuse.cached(reuse.rating_cube(from_csv()), eager=True) as cube:
                reuse.query_batch(cube, year=YEAR, min_rating=HIGH_RATING).collect()

        def best() -> None:
            reports.best_movies(ratings, movies, min_votes=MIN_VOTES).collect()

        def genres(strategy: str = "auto") -> None:
            reports.genre_ratings(ratings, movies, strategy=strategy).collect()

        jobs: dict[str, Callable[[], object]] = {
            "best_movies": best,
            "genre_ratings": genres,
            "genre_ratings_broadcast": lambda: genres("broadcast"),
            "top_movies_per_genre": lambda: reports.top_movies_per_genre(
                ratings, movies
            ).collect(),
            "count_year": of_year.count,
            "count_year_cached_fill_and_warm": cached_filter,
            "four_queries_uncached": lambda: four_queries(from_csv()),
            "four_queries_cached_with_fill": cached_four,
            "four_queries_over_cached_cube": cube_batch,
            "bronze_to_silver": silver,
            "silver_to_gold": lambda: pipelines.silver_to_gold(
                spark, folder, scratch.path("gold"), data.specs, min_votes=MIN_VOTES
            ),
        }
        first = {"bronze_to_silver": first_silver}
        for name, job in jobs.items():
            if name not in first:
                first[name] = seconds(job)
        timed: dict[str, list[float]] = {name: [] for name in jobs}
        for turn in range(RUNS):
            # Every other turn runs the jobs, cached and uncached, in reverse.
            for name in list(jobs)[:: -1 if turn % 2 else 1]:
                timed[name].append(seconds(jobs[name]))
        rows = ratings.count()
    queries = {name: round(median(times), 3) for name, times in timed.items()}
    print(
        json.dumps(
            {
                "metric": "headline jobs, sum of warm medians",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "first_run": {name: round(t, 3) for name, t in first.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "ratings": rows,
                "ratings_per_sec": {name: round(rows / t) for name, t in queries.items() if t},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
