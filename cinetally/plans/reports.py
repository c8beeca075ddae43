"""The analyses: best movies, ratings per genre, best movies per genre.

Each comes in two forms. The one named after its result starts from ratings.
The ``..._of`` form starts from ``movie_means``, so that several reports can
share that one pass over the ratings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cinetally.functions.columns import list_items, rounded, tally
from cinetally.operators.aggregates import MEAN_DIGITS, key_stats
from cinetally.operators.joins import attach, attach_items
from cinetally.operators.ranking import best_first, top_k, top_n_per_group
from cinetally.schemas import NO_GENRE


def movie_means(ratings: DataFrame) -> DataFrame:
    """Unrounded mean and votes per movie."""
    return key_stats(ratings, digits=None)


def voted_movies(
    means: DataFrame, min_votes: int, *, digits: int | None = MEAN_DIGITS
) -> DataFrame:
    """Movies with enough votes; means rounded, so that they can be ranked."""
    voted = means.filter(F.col("num_votes") >= min_votes)
    return voted.withColumn("avg_rating", rounded(F.col("avg_rating"), digits))


def best_movies(ratings: DataFrame, movies: DataFrame, **options: object) -> DataFrame:
    """``best_movies_of`` the ratings."""
    return best_movies_of(movie_means(ratings), movies, **options)


def best_movies_of(
    means: DataFrame,
    movies: DataFrame,
    *,
    min_votes: int = 50,
    k: int = 10,
    strategy: str = "auto",
) -> DataFrame:
    """The k best movies with enough votes, best first, with titles where known."""
    rated = attach(
        voted_movies(means, min_votes),
        movies.select("movieId", "title"),
        "movieId",
        strategy=strategy,
    )
    return top_k(rated.select("movieId", "title", "avg_rating", "num_votes"), best_first(), k)


def eligible_movies(means: DataFrame, min_votes: int = 50) -> DataFrame:
    """How many movies have enough votes to be ranked, of how many."""
    return means.agg(
        F.count(F.lit(1)).alias("n_movies"),
        tally(F.col("num_votes") >= min_votes).alias("n_eligible"),
    )


def genre_counts(movies: DataFrame) -> DataFrame:
    """Distinct genres, with the group of movies without one and without it."""
    genres = movies.select(
        F.explode_outer(list_items(F.col("genres"), drop=NO_GENRE)).alias("genre")
    ).distinct()
    return genres.agg(
        F.count(F.lit(1)).alias("n_with_null"), F.count("genre").alias("n_genres")
    )


def genre_ratings(ratings: DataFrame, movies: DataFrame, **options: object) -> DataFrame:
    """``genre_ratings_of`` the ratings."""
    return genre_ratings_of(movie_means(ratings), movies, **options)


def genre_ratings_of(
    means: DataFrame,
    movies: DataFrame,
    *,
    strategy: str = "auto",
    include_unclassified: bool = True,
    digits: int | None = MEAN_DIGITS,
) -> DataFrame:
    """Mean over movies of their mean rating for each genre, best genre first.

    Movies without a genre make up a group with genre NULL unless left out.
    """
    by_genre = attach_items(
        means.select("movieId", "avg_rating"),
        movies,
        "movieId",
        keep_unmatched=include_unclassified,
        strategy=strategy,
    )
    return (
        by_genre.groupBy("genre")
        .agg(
            rounded(F.avg("avg_rating"), digits).alias("avg_rating_by_genre"),
            F.count("movieId").alias("num_films"),
        )
        .orderBy(F.desc("avg_rating_by_genre"), F.asc_nulls_first("genre"))
    )


def movies_by_genre(ratings: DataFrame, movies: DataFrame, **options: object) -> DataFrame:
    """``movies_by_genre_of`` the ratings."""
    return movies_by_genre_of(movie_means(ratings), movies, **options)


def movies_by_genre_of(
    means: DataFrame,
    movies: DataFrame,
    *,
    min_votes: int = 5,
    strategy: str = "auto",
    include_unclassified: bool = True,
) -> DataFrame:
    """Movies with enough votes, once for each of their genres."""
    return attach_items(
        voted_movies(means, min_votes),
        movies,
        "movieId",
        carry=("title",),
        keep_unmatched=include_unclassified,
        strategy=strategy,
    )


def top_movies_per_genre(ratings: DataFrame, movies: DataFrame, **options: object) -> DataFrame:
    """``top_movies_per_genre_of`` the ratings."""
    return top_movies_per_genre_of(movie_means(ratings), movies, **options)


def top_movies_per_genre_of(
    means: DataFrame, movies: DataFrame, *, n: int = 3, **options: object
) -> DataFrame:
    """The n best movies of each genre, numbered; options as for ``movies_by_genre_of``."""
    candidates = movies_by_genre_of(means, movies, **options)
    return (
        top_n_per_group(candidates, ["genre"], best_first(), n)
        .select("genre", "rank", "title", "avg_rating", "num_votes")
        .orderBy(F.asc_nulls_first("genre"), "rank")
    )
