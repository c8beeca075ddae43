"""One named query per operator of the inventory, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cinetally.functions.columns import list_items
from cinetally.operators import aggregates, associations, checks, cleaning, joins, profiling, quantiles, ranking
from cinetally.plans import pipelines, reports, reuse
from cinetally.schemas import TableSpec
from cinetally.sources.readers import read_bronze, read_silver, rejected
from cinetally.sources.scratch import Scratch
from cinetally.sources.writers import write_csv, write_parquet
from cinetally.workload.fixtures import Fixtures, plain_time

PARTS = TableSpec(
    name="part.parquet",
    schema=T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            *(T.StructField(c, T.StringType()) for c in ("p_name", "p_brand", "p_type")),
        ]
    ),
    key=("p_partkey",),
    required=(),
)

# The test data have 11 to 46 votes per movie and the years 1995 to 2001.
MIN_VOTES = 30
YEAR = 1998
HIGH_RATING = 4.0

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def query(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Fixtures(spark, folder))

    _QUERIES[build.__name__] = run
    return build


# Sources


def _through_csv(
    data: Fixtures, name: str, rows: DataFrame | None = None, **options: object
) -> DataFrame:
    path = Scratch(data.spark).path(name)
    write_csv(data.bronze[name] if rows is None else rows, path)
    return read_bronze(data.spark, data.specs[name], path, **options)


@query
def scan_csv_schema(data: Fixtures) -> DataFrame:
    return _through_csv(data, "movies", data.movies_titled)


@query
def scan_csv_ratings(data: Fixtures) -> DataFrame:
    return _through_csv(data, "ratings")


@query
def scan_csv_tags(data: Fixtures) -> DataFrame:
    return _through_csv(data, "tags")


@query
def scan_csv_links(data: Fixtures) -> DataFrame:
    return _through_csv(data, "links")


@query
def scan_csv_infer(data: Fixtures) -> DataFrame:
    scanned = cleaning.epoch_to_timestamp(_through_csv(data, "ratings", infer=True))
    typed = scanned.withColumns(
        {c: F.col(c).cast("bigint") for c in ("userId", "movieId")}
    ).withColumn("year", F.year("timestamp"))
    return plain_time(typed)


def _ratings_with_faults(data: Fixtures) -> DataFrame:
    """Ratings as text, some with a word for the rating or a letter before the user."""
    movie = F.col("movieId")
    user = F.when(movie % 89 == 7, F.concat(F.lit("u"), F.col("userId").cast("string"))).otherwise(F.col("userId").cast("string"))
    rating = F.when(movie % 97 == 5, "four").otherwise(F.col("rating").cast("string"))
    return data.ratings_raw.select(user.alias("userId"), "movieId", rating.alias("rating"), "timestamp")


@query
def scan_csv_rejects(data: Fixtures) -> DataFrame:
    """Lines with a field that is not of its type."""
    return rejected(_through_csv(data, "ratings", _ratings_with_faults(data), rejects=True))


@query
def scan_parquet(data: Fixtures) -> DataFrame:
    """A silver-style scan by a specification; columns it does not name are not read."""
    return read_silver(data.spark, data.folder, PARTS)


@query
def scan_partitioned(data: Fixtures) -> DataFrame:
    """One partition of a partitioned table; the others are not opened."""
    folder = Scratch(data.spark).path("silver")
    write_parquet(data.ratings, f"{folder}/ratings", partition_by=("year",))
    stored = read_silver(data.spark, folder, data.specs["ratings"])
    return plain_time(stored.filter(F.col("year") == YEAR))


# Sinks


@query
def sink_parquet_roundtrip(data: Fixtures) -> DataFrame:
    path = Scratch(data.spark).path("movies")
    write_parquet(data.movies, path)
    return data.spark.read.parquet(path)


@query
def sink_partitioned_roundtrip(data: Fixtures) -> DataFrame:
    path = Scratch(data.spark).path("ratings")
    write_parquet(data.ratings, path, partition_by=("year",))
    return plain_time(data.spark.read.parquet(path))


@query
def sink_partitioned_in_place(data: Fixtures) -> DataFrame:
    """The same without a shuffle of its own."""
    path = Scratch(data.spark).path("ratings")
    write_parquet(data.ratings, path, partition_by=("year",), gather=False)
    return plain_time(data.spark.read.parquet(path))


@query
def sink_csv_roundtrip(data: Fixtures) -> DataFrame:
    """A small sorted result in one file."""
    path = Scratch(data.spark).path("best")
    best = reports.best_movies(data.ratings, data.movies, min_votes=MIN_VOTES)
    write_csv(best, path, files=1)
    return data.spark.read.schema(best.schema).csv(path, header=True)


@query
def preview_first_n(data: Fixtures) -> DataFrame:
    return profiling.first_rows(data.movies, ["movieId"], 10)


@query
def schema_report(data: Fixtures) -> DataFrame:
    listed = [
        profiling.schema_report(df, with_nulls=True).select(F.lit(name).alias("table"), "*")
        for name, df in data.bronze.items()
    ]
    return reduce(DataFrame.unionByName, listed)


@query
def verify_content(data: Fixtures) -> DataFrame:
    with Scratch(data.spark) as copies:
        folder = copies.path("silver")
        runs = pipelines.clean_to_silver(data.bronze, folder, data.specs)
        checked = pipelines.verify_silver_content(data.spark, folder, runs, data.specs)
        return Scratch(data.spark).table(checked, "checked")


@query
def verify_readback(data: Fixtures) -> DataFrame:
    with Scratch(data.spark) as copies:
        folder = copies.path("silver")
        written = pipelines.bronze_to_silver(data.bronze, folder, data.specs)
        checked = pipelines.verify_silver(data.spark, folder, written, data.specs)
        return Scratch(data.spark).table(checked, "checked")


@query
def sink_files(data: Fixtures) -> DataFrame:
    """Rows and files of a table written to a given number of files."""
    with Scratch(data.spark) as copies:
        path = copies.path("movies")
        write_parquet(data.movies, path, files=3)
        stored = data.spark.read.parquet(path).select("_metadata.file_path")
        counted = stored.agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct("file_path").alias("n_files")
        )
        return Scratch(data.spark).table(counted, "counted")


# Projections, filters, NULLs


@query
def project_columns(data: Fixtures) -> DataFrame:
    return data.ratings.select("userId", "movieId", "rating", "year", "month")


@query
def explode_genres(data: Fixtures) -> DataFrame:
    return joins.explode_list(data.movies)


@query
def calendar_columns(data: Fixtures) -> DataFrame:
    moments = cleaning.epoch_to_timestamp(data.tags_raw.select("timestamp").distinct())
    return plain_time(cleaning.calendar_columns(moments))


@query
def filter_range(data: Fixtures) -> DataFrame:
    rated = cleaning.in_range(data.ratings_raw, "rating", 0.5, 4.5)
    return aggregates.histogram(rated, "rating")


@query
def count_year(data: Fixtures) -> DataFrame:
    of_year = data.ratings.filter(F.col("year") == YEAR)
    return aggregates.row_counts({"ratings": of_year})


@query
def count_high_ratings(data: Fixtures) -> DataFrame:
    high = data.ratings.filter(F.col("rating") >= HIGH_RATING)
    return aggregates.row_counts({"ratings": high})


@query
def having_min_votes(data: Fixtures) -> DataFrame:
    return reports.voted_movies(reports.movie_means(data.ratings), MIN_VOTES)


@query
def filter_sentinel(data: Fixtures) -> DataFrame:
    return joins.explode_list(data.movies, drop=None).filter(
        F.col("genre") != "(no genres listed)"
    )


@query
def count_null_optional(data: Fixtures) -> DataFrame:
    return aggregates.null_share(data.links, "tmdbId")


@query
def drop_null_keys(data: Fixtures) -> DataFrame:
    return cleaning.drop_null_keys(data.links_raw, ("movieId", "imdbId"))


@query
def links_strict(data: Fixtures) -> DataFrame:
    return cleaning.clean_links(data.links_raw, keep_optional_nulls=False)


# Duplicates


@query
def dedup_by_key(data: Fixtures) -> DataFrame:
    return cleaning.dedup_by_key(data.ratings_raw, ("userId", "movieId", "timestamp"))


@query
def dedup_by_key_wide(data: Fixtures) -> DataFrame:
    """Conflicting payloads of several columns: orders of a customer by status."""
    orders = data.table("orders").select(
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderkey").alias("order_id"),
    )
    return cleaning.dedup_by_key(orders, ("o_custkey", "o_orderstatus"))


@query
def distinct_genres(data: Fixtures) -> DataFrame:
    return aggregates.distinct_values(joins.explode_list(data.movies), "genre")


@query
def count_distinct_users(data: Fixtures) -> DataFrame:
    return aggregates.count_distinct_values(data.ratings_raw, "userId")


# Joins


@query
def left_join_titles(data: Fixtures) -> DataFrame:
    stats = aggregates.key_stats(data.ratings)
    return joins.attach(stats, data.movies.select("movieId", "title"), "movieId")


@query
def inner_join_titles(data: Fixtures) -> DataFrame:
    stats = aggregates.key_stats(data.ratings)
    return joins.attach(stats, data.movies.select("movieId", "title"), "movieId", how="inner")


@query
def broadcast_join_genres(data: Fixtures) -> DataFrame:
    return reports.movies_by_genre(data.ratings, data.movies, strategy="broadcast")


@query
def orphan_ratings(data: Fixtures) -> DataFrame:
    return joins.orphan_keys(data.ratings, data.movies, "movieId")


@query
def orphan_tags(data: Fixtures) -> DataFrame:
    return joins.orphan_keys(data.tags, data.movies, "movieId")


@query
def catalog_coverage(data: Fixtures) -> DataFrame:
    return joins.coverage(data.movies, data.ratings, "movieId")


@query
def eligible_movies(data: Fixtures) -> DataFrame:
    return reports.eligible_movies(reports.movie_means(data.ratings), MIN_VOTES)


@query
def genre_counts(data: Fixtures) -> DataFrame:
    return reports.genre_counts(data.movies)


# Aggregates


@query
def row_counts(data: Fixtures) -> DataFrame:
    return aggregates.row_counts(data.bronze)


@query
def movie_stats(data: Fixtures) -> DataFrame:
    return aggregates.key_stats(data.ratings)


@query
def genre_mean_of_means(data: Fixtures) -> DataFrame:
    return reports.genre_ratings(data.ratings, data.movies, include_unclassified=False)


@query
def global_min_max(data: Fixtures) -> DataFrame:
    return aggregates.value_range(data.ratings_raw, "userId", "movieId", "rating", "timestamp")


@query
def ratings_per_year(data: Fixtures) -> DataFrame:
    return aggregates.histogram(data.ratings, "year")


@query
def rating_histogram(data: Fixtures) -> DataFrame:
    return aggregates.histogram(data.ratings, "rating")


@query
def describe_numeric(data: Fixtures) -> DataFrame:
    return aggregates.numeric_summary(data.ratings_raw, digits=3)


@query
def dataset_facts(data: Fixtures) -> DataFrame:
    return aggregates.dataset_facts(data.movies, data.ratings)


# Windows and top-k


@query
def row_number_genre(data: Fixtures) -> DataFrame:
    candidates = reports.movies_by_genre(data.ratings, data.movies)
    return ranking.row_numbers(
        candidates, ["genre"], ranking.best_first(), Scratch(data.spark)
    )


@query
def topn_per_genre(data: Fixtures) -> DataFrame:
    candidates = reports.movies_by_genre(data.ratings, data.movies, include_unclassified=False)
    return ranking.top_n_per_group(candidates, ["genre"], ranking.best_first(), 3)


@query
def topk_movies(data: Fixtures) -> DataFrame:
    return ranking.top_k(aggregates.key_stats(data.ratings), ranking.best_first(), 10)


# Scalar functions


@query
def trim_text(data: Fixtures) -> DataFrame:
    return cleaning.trim_columns(data.movies_raw, ("title", "genres"))


@query
def split_list(data: Fixtures) -> DataFrame:
    items = list_items(F.col("genres"))
    return data.movies.select(
        "movieId",
        F.size(items).cast("bigint").alias("n_items"),
        F.get(items, F.lit(0)).alias("first_item"),
        F.element_at(items, -1).alias("last_item"),
    )


@query
def epoch_to_timestamp(data: Fixtures) -> DataFrame:
    return plain_time(cleaning.epoch_to_timestamp(data.tags_raw))


@query
def normalize_tags(data: Fixtures) -> DataFrame:
    return plain_time(cleaning.clean(data.tags_in_two_cases, data.specs["tags"], fold_case=True))


# Reuse and placement


@query
def cached_filter_count(data: Fixtures) -> DataFrame:
    """The count without cache, while it fills, and from it."""
    # Filter and project first: only what the counts need is kept.
    of_year = data.ratings.filter(F.col("year") == YEAR).select("rating")
    scratch = Scratch(data.spark)

    def counted(run: str) -> DataFrame:
        n_rows = of_year.agg(F.count(F.lit(1)).alias("n_rows"))
        return scratch.table(n_rows.select(F.lit(run).alias("run"), "n_rows"), run)

    rounds = [counted("uncached")]
    with reuse.cached(of_year):
        rounds += [counted("filling"), counted("warm")]
    return reduce(DataFrame.unionByName, rounds)


@query
def cached_query_batch(data: Fixtures) -> DataFrame:
    scratch = Scratch(data.spark)
    with reuse.cached(reuse.rating_cube(data.ratings), eager=True) as cube:
        batch = reuse.query_batch(cube, year=YEAR, min_rating=HIGH_RATING)
        return scratch.table(batch, "batch")


@query
def strategy_equivalence(data: Fixtures) -> DataFrame:
    merged, hinted = (
        reports.genre_ratings(data.ratings, data.movies, strategy=strategy)
        for strategy in ("merge", "broadcast")
    )
    return reuse.compare_results(merged, hinted)


# Profiles


@query
def profile_shape(data: Fixtures) -> DataFrame:
    return profiling.shape(data.ratings_raw)


@query
def preview_last_n(data: Fixtures) -> DataFrame:
    return profiling.last_rows(data.movies, ["movieId"], 5)


@query
def sample_n(data: Fixtures) -> DataFrame:
    return profiling.sample_rows(data.movies, ["movieId"], 5, seed=42)


@query
def profile_missing(data: Fixtures) -> DataFrame:
    return profiling.missing_values(data.labelled_documents)


@query
def profile_quartiles(data: Fixtures) -> DataFrame:
    return profiling.summary_with_quartiles(
        data.ratings_raw, Scratch(data.spark), ["userId", "movieId", "rating"], digits=4
    )


@query
def profile_typed_quartiles(data: Fixtures) -> DataFrame:
    """Whole numbers beyond 2**53 with all their digits."""
    far = data.ratings_raw.select("movieId", (F.col("timestamp") * 9_000_000_000 + F.col("movieId")).alias("far"))
    return quantiles.typed_quantiles(far, ["movieId", "far"], (0.25, 0.5, 0.75), Scratch(data.spark))


@query
def profile_correlations(data: Fixtures) -> DataFrame:
    return associations.correlations(data.ratings, ["userId", "movieId", "rating", "month", "hour"])


@query
def profile_correlation_ratios(data: Fixtures) -> DataFrame:
    return associations.correlation_ratios(data.ratings, ["year", "dayOfWeek"], ["rating", "hour"])


@query
def profile_uncertainties(data: Fixtures) -> DataFrame:
    return associations.uncertainties(data.ratings, ["year", "month", "rating"])


@query
def profile_text_lengths(data: Fixtures) -> DataFrame:
    return profiling.summary_with_quartiles(
        data.labelled_documents, Scratch(data.spark), ["n_chars", "quality"], digits=4
    )


@query
def profile_all_tables(data: Fixtures) -> DataFrame:
    return profiling.profile_tables(data.bronze)


@query
def profile_duplicates(data: Fixtures) -> DataFrame:
    tables = {
        "movies": (data.movies, ["movieId", "title", "genres"]),
        "links": (data.links, ["movieId", "imdbId", "tmdbId"]),
        "documents": (data.table("documents"), ["doc_id", "text"]),
    }
    reports_by_table = [
        profiling.duplicates(df, columns).select(F.lit(name).alias("table"), "*")
        for name, (df, columns) in tables.items()
    ]
    first, *others = reports_by_table
    for other in others:
        first = first.unionByName(other)
    return first


@query
def profile_top_values(data: Fixtures) -> DataFrame:
    return profiling.top_values(data.tags_raw.drop("timestamp"), k=3)


@query
def profile_target(data: Fixtures) -> DataFrame:
    return profiling.target_by_value(data.ratings, "dayOfWeek", "rating")


@query
def profile_keys_as_labels(data: Fixtures) -> DataFrame:
    labelled = profiling.keys_as_labels(data.ratings_raw, ("userId", "movieId"))
    return aggregates.numeric_summary(labelled, digits=3)


# Composite jobs


@query
def clean_movies(data: Fixtures) -> DataFrame:
    return data.movies


@query
def clean_ratings(data: Fixtures) -> DataFrame:
    return plain_time(data.ratings)


@query
def clean_tags(data: Fixtures) -> DataFrame:
    return plain_time(data.tags)


@query
def clean_links(data: Fixtures) -> DataFrame:
    return data.links


@query
def cleaning_report(data: Fixtures) -> DataFrame:
    return cleaning.cleaning_report(data.bronze, data.silver)


@query
def cleaning_report_with_rejects(data: Fixtures) -> DataFrame:
    """Counts of a run over tables one of which has lines that do not parse."""
    with Scratch(data.spark) as copies:
        ratings = _through_csv(data, "ratings", _ratings_with_faults(data), rejects=True)
        runs = pipelines.clean_to_silver(data.bronze | {"ratings": ratings}, copies.path("silver"), data.specs)
    return pipelines.run_report(data.spark, runs)


@query
def silver_pipeline(data: Fixtures) -> DataFrame:
    with Scratch(data.spark) as copies:
        folder = copies.path("silver")
        pipelines.bronze_to_silver(data.bronze, folder, data.specs)
        report = pipelines.silver_report(data.spark, data.bronze, folder, data.specs)
        return Scratch(data.spark).table(report, "report")


@query
def best_movies(data: Fixtures) -> DataFrame:
    return reports.best_movies(data.ratings, data.movies, min_votes=MIN_VOTES)


@query
def genre_ratings(data: Fixtures) -> DataFrame:
    return reports.genre_ratings(data.ratings, data.movies)


@query
def top_movies_per_genre(data: Fixtures) -> DataFrame:
    return reports.top_movies_per_genre(data.ratings, data.movies)


@query
def gold_pipeline(data: Fixtures) -> DataFrame:
    """The rows of the three gold files, one value a row: table, row, column, value."""
    with Scratch(data.spark) as copies:
        silver, gold = copies.path("silver"), copies.path("gold")
        needed = {name: data.bronze[name] for name in ("movies", "ratings")}
        pipelines.bronze_to_silver(needed, silver, data.specs)
        pipelines.silver_to_gold(data.spark, silver, gold, data.specs, min_votes=MIN_VOTES)
        keys = (("movieId",), ("genre",), ("genre", "rank"))
        long_form = []
        for name, key in zip(pipelines.GOLD_TABLES, keys, strict=True):
            stored = data.spark.read.csv(f"{gold}/{name}", header=True, escape='"')
            row = F.concat_ws("|", *(F.coalesce(c, F.lit("none")) for c in key))
            cells = F.array(
                *(F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in stored.columns)
            )
            long_form.append(stored.select(F.lit(name).alias("table"), row.alias("row"), F.inline(cells)))
        return Scratch(data.spark).table(reduce(DataFrame.unionByName, long_form), "cells")


@query
def validate_ratings(data: Fixtures) -> DataFrame:
    return aggregates.value_range(data.ratings, "rating", "year")


# Stated facts and checks, computed


@query
def mean_ratings_per_user(data: Fixtures) -> DataFrame:
    return aggregates.mean_rows_per_key(data.ratings, "userId")


@query
def count_distinct_tags(data: Fixtures) -> DataFrame:
    return aggregates.count_distinct_values(data.tags, "tag")


@query
def off_scale_ratings(data: Fixtures) -> DataFrame:
    return checks.off_scale(data.ratings)


@query
def titles_with_year(data: Fixtures) -> DataFrame:
    return checks.titles_with_year(cleaning.clean_movies(data.movies_titled))


@query
def activity_by_weekday_hour(data: Fixtures) -> DataFrame:
    return aggregates.histogram(data.ratings, "dayOfWeek", "hour")


@query
def tag_frequencies(data: Fixtures) -> DataFrame:
    return aggregates.histogram(data.tags, "tag")


@query
def quality_scorecard(data: Fixtures) -> DataFrame:
    return checks.quality_scorecard(data.bronze, data.specs)
