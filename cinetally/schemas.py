"""Table specifications: column types plus the rules cleaning applies to each table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Fixed values of the data set: the marker for "no category", the list
# separator, and the closed rating scale.
NO_GENRE = "(no genres listed)"
LIST_SEPARATOR = "|"
RATING_SCALE = (0.5, 5.0)

CALENDAR = ("year", "month", "day", "dayOfWeek", "hour")


@dataclass(frozen=True)
class TableSpec:
    """What a table looks like in bronze and how it becomes silver.

    ``required`` columns lose their NULL rows, ``optional`` ones only on request.
    ``scale`` maps a column to its closed valid range. ``epoch`` names the
    epoch-seconds column that turns into a timestamp.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    text: tuple[str, ...] = ()
    scale: tuple[tuple[str, float, float], ...] = ()
    epoch: str | None = None
    calendar: bool = False
    partition_by: tuple[str, ...] = ()

    def with_types(self, **types: T.DataType) -> TableSpec:
        """The same table with other column types, e.g. 64-bit keys for large catalogues."""
        fields = [T.StructField(f.name, types.get(f.name, f.dataType), True) for f in self.schema]
        return replace(self, schema=T.StructType(fields))

    def silver_schema(self) -> T.StructType:
        """Column order and types of the table as read back from silver."""
        fields = [
            T.StructField(f.name, T.TimestampType() if f.name == self.epoch else f.dataType, True)
            for f in self.schema
        ]
        if self.calendar:
            fields += [T.StructField(c, T.IntegerType(), True) for c in CALENDAR]
        inner = [f for f in fields if f.name not in self.partition_by]
        return T.StructType(inner + [f for f in fields if f.name in self.partition_by])


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


MOVIES = TableSpec(
    name="movies",
    schema=_schema(movieId=T.IntegerType(), title=T.StringType(), genres=T.StringType()),
    key=("movieId",),
    required=("movieId", "title"),
    text=("title", "genres"),
)

RATINGS = TableSpec(
    name="ratings",
    schema=_schema(
        userId=T.IntegerType(), movieId=T.IntegerType(), rating=T.DoubleType(), timestamp=T.LongType()
    ),
    key=("userId", "movieId", "timestamp"),
    required=("userId", "movieId", "rating"),
    scale=(("rating", *RATING_SCALE),),
    epoch="timestamp",
    calendar=True,
    partition_by=("year",),
)

TAGS = TableSpec(
    name="tags",
    schema=_schema(
        userId=T.IntegerType(), movieId=T.IntegerType(), tag=T.StringType(), timestamp=T.LongType()
    ),
    key=("userId", "movieId", "tag", "timestamp"),
    required=("userId", "movieId", "tag"),
    text=("tag",),
    epoch="timestamp",
)

LINKS = TableSpec(
    name="links",
    schema=_schema(movieId=T.IntegerType(), imdbId=T.StringType(), tmdbId=T.StringType()),
    key=("movieId",),
    required=("movieId", "imdbId"),
    optional=("tmdbId",),
)

SPECS = {spec.name: spec for spec in (MOVIES, RATINGS, TAGS, LINKS)}


def wide_keys(specs: dict[str, TableSpec] = SPECS) -> dict[str, TableSpec]:
    """Specs with 64-bit ids: an id beyond 32 bits would read as NULL and be dropped."""
    ids = {"userId": T.LongType(), "movieId": T.LongType()}
    return {name: spec.with_types(**ids) for name, spec in specs.items()}
