"""Ratings-style bronze tables derived from the part, lineitem and events tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cinetally.operators.cleaning import clean
from cinetally.schemas import NO_GENRE, wide_keys


class Fixtures:
    """Bronze and silver frames over one test-data folder, built when first used."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        # Calendar fields depend on the zone of the session.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder
        self.specs = wide_keys()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def movies_raw(self) -> DataFrame:
        key = F.col("p_partkey")
        title = F.when(key % 200 != 199, F.concat(F.lit("  "), "p_name", F.lit(" ")))
        words = F.concat(
            F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("|")), F.lit("|"), "p_type"
        )
        genres = F.when(F.col("p_brand") == "Brand#1", F.lit(NO_GENRE)).otherwise(words)
        return _copied(
            self.table("part"),
            copied=key % 100 == 0,
            movieId=key,
            title=title,
            genres=genres,
        )

    @cached_property
    def movies_titled(self) -> DataFrame:
        """Movies, of whose titles some hold quotes and commas and some end with a year."""
        key = F.col("movieId")
        quote = F.when(key % 11 == 5, F.lit(', the "Big" One')).otherwise("")
        year = F.concat(F.lit(" ("), (1900 + key % 50).cast("string"), F.lit(")"))
        year = F.when(key % 7 == 3, year).otherwise("")
        title = F.concat(F.rtrim("title"), quote, year, F.lit(" "))
        return self.movies_raw.withColumn("title", title)

    @cached_property
    def ratings_raw(self) -> DataFrame:
        order = F.col("l_orderkey")
        moment = (
            _epoch("l_shipdate") + 3600 * F.col("l_linenumber") + 86400 * (order % 28)
        )
        return _copied(
            self.table("lineitem"),
            copied=order % 50 == 0,
            userId=F.nullif("l_suppkey", F.lit(7)),
            movieId=F.col("l_partkey"),
            rating=F.col("l_quantity") / 10,
            timestamp=moment,
        )

    @cached_property
    def tags_raw(self) -> DataFrame:
        key = F.col("event_id")
        return _copied(
            self.table("events"),
            copied=key % 40 == 0,
            userId=F.nullif("user_id", F.lit(3)),
            movieId=key % 2000,
            tag=F.concat(F.lit(" "), "event_type", F.lit("  ")),
            timestamp=_epoch("ts"),
        )

    @cached_property
    def tags_in_two_cases(self) -> DataFrame:
        """Tags, of which some stand in another row in upper case."""
        again = self.tags_raw.filter(F.col("movieId") % 40 == 20)
        return self.tags_raw.unionByName(again.withColumn("tag", F.upper("tag")))

    @cached_property
    def links_raw(self) -> DataFrame:
        key = F.col("p_partkey")
        return _copied(
            self.table("part"),
            copied=key % 100 == 0,
            movieId=key,
            imdbId=F.when(key % 100 != 99, F.lpad(key.cast("string"), 7, "0")),
            tmdbId=F.when(key % 9 != 0, (key % 1500).cast("string")),
        )

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return {
            "movies": self.movies_raw,
            "ratings": self.ratings_raw,
            "tags": self.tags_raw,
            "links": self.links_raw,
        }

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return {name: clean(df, self.specs[name]) for name, df in self.bronze.items()}

    @property
    def movies(self) -> DataFrame:
        return self.silver["movies"]

    @property
    def ratings(self) -> DataFrame:
        return self.silver["ratings"]

    @property
    def tags(self) -> DataFrame:
        return self.silver["tags"]

    @property
    def links(self) -> DataFrame:
        return self.silver["links"]

    @cached_property
    def labelled_documents(self) -> DataFrame:
        """Documents with their labels, NULL where there is none."""
        return self.table("documents").join(self.table("labels"), "doc_id", "left")


def plain_time(df: DataFrame) -> DataFrame:
    """The timestamp without its zone, as the SQL engine returns it."""
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _epoch(column: str) -> Column:
    return F.unix_timestamp(F.col(column).cast("timestamp"))


def _copied(df: DataFrame, copied: Column, **columns: Column) -> DataFrame:
    copies = F.when(copied, 2).otherwise(1)
    rows = df.select(
        *(value.alias(name) for name, value in columns.items()),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    )
    return rows.drop("copy")
