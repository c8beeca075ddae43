"""Column profiles of a table as Spark jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cinetally.functions.columns import missing, percent, quoted, rounded, tally
from cinetally.operators.aggregates import (
    MEAN_DIGITS,
    numeric_columns,
    numeric_summary,
    one_row_per_column,
)
from cinetally.operators.quantiles import moments_of, ordered_counts, quantiles_of
from cinetally.operators.ranking import top_k, top_n_per_group
from cinetally.sources.scratch import Scratch

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}

# Longer text is shuffled as its digest.
DIGEST_BEYOND = 64


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def first_rows(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    return top_k(df, [F.asc_nulls_last(k) for k in keys], n)


def last_rows(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The n largest keys; rows of a distributed table have no other order."""
    return top_k(df, [F.desc_nulls_last(k) for k in keys], n)


def sample_rows(df: DataFrame, keys: list[str], n: int = 5, *, seed: int = 0) -> DataFrame:
    """A repeatable random sample: the n smallest digests of seed and key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))
    return top_k(df, [digest.asc(), *(F.asc_nulls_last(k) for k in keys)], n)


def schema_report(df: DataFrame, *, with_nulls: bool = False) -> DataFrame:
    """Name, type and declared nullability per column, from metadata alone.

    ``with_nulls`` adds whether NULLs really occur, which reads every column.
    """
    declared = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.nullable).alias("nullable"),
        )
        for position, f in enumerate(df.schema, start=1)
    ]
    listed = df.sparkSession.range(1).select(F.inline(F.array(*declared)))
    if not with_nulls:
        return listed
    nulls = one_row_per_column(
        df, {f.name: {"n_null": tally(quoted(f.name).isNull())} for f in df.schema}
    )
    # One row per column on either side.
    found = nulls.select("column", (F.col("n_null") > 0).alias("has_nulls"))
    return listed.join(F.broadcast(found), "column").select(*listed.columns, "has_nulls")


def missing_values(df: DataFrame) -> DataFrame:
    """Type and missing values of every column, from one pass over the table."""
    rows = F.count(F.lit(1))
    return one_row_per_column(
        df,
        {
            f.name: {
                "type": F.any_value(F.lit(f.dataType.simpleString())),
                "n_missing": tally(missing(f)),
                "pct_missing": percent(tally(missing(f)), rows, 2),
            }
            for f in df.schema
        },
    )


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """``missing_values`` of several tables."""
    profiles = [
        missing_values(df).select(F.lit(name).alias("table"), "*") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def summary_with_quartiles(
    df: DataFrame,
    scratch: Scratch | None,
    columns: list[str] | None = None,
    *,
    digits: int | None = MEAN_DIGITS,
) -> DataFrame:
    """Numeric summary plus quartiles: exact ones, or approximate without a scratch folder."""
    columns = numeric_columns(df) if columns is None else columns
    if scratch is None:
        summary = numeric_summary(df, columns, digits=digits, quantiles=QUARTILES)
        return summary.drop("min_text", "max_text")
    counts = ordered_counts(df, columns, scratch)
    quartiles = (
        quantiles_of(counts, tuple(QUARTILES.values()), digits=digits)
        .groupBy("column")
        .agg(
            *(
                F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name)
                for name, p in QUARTILES.items()
            )
        )
    )
    # One row per column on every side; a column without values has no counts.
    names = _named(df, columns)
    return (
        names.join(F.broadcast(moments_of(counts, digits=digits)), "column", "left")
        .join(F.broadcast(quartiles), "column", "left")
        .withColumn("count", F.coalesce("count", F.lit(0)))
    )


def keys_as_labels(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Key columns as text, so that numeric summaries pass over them."""
    return df.withColumns({k: F.col(k).cast("string") for k in keys if k in df.columns})


def _named(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, columns)).cast("array<string>")).alias("column")
    )


def _as_text(field: T.StructField) -> Column:
    """A value as text, missing ones as NULL; zero has one form only."""
    value = quoted(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0).cast(field.dataType)
    return F.when(~missing(field), value.cast("string"))


def _marked(text: Column) -> Column:
    """Short text behind "=", the digest of longer text behind "#".

    The marks keep a text from ever equalling another one's digest.
    """
    longer = F.concat(F.lit("#"), F.sha2(text.cast("binary"), 256))
    return F.when(F.length(text) > DIGEST_BEYOND, longer).otherwise(F.concat(F.lit("="), text))


def label_of(field: T.StructField) -> Column:
    """A value as a marked text to group by; missing ones as NULL."""
    return _marked(_as_text(field))


def _long_form(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(column, value) rows."""
    pairs = [F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in values.items()]
    return df.select(F.inline(F.array(*pairs)))


def value_counts(df: DataFrame, columns: list[str], *, marked: bool = False) -> DataFrame:
    """(column, value, n) for every distinct value as text; missing values are one NULL group.

    With ``marked`` the values carry a mark, and long ones are digests, which keeps the shuffle narrow.
    """
    types = {f.name: f for f in df.schema}
    texts = {c: _as_text(types[c]) for c in columns}
    if marked:
        texts = {c: _marked(v) for c, v in texts.items()}
    return _long_form(df, texts).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: values used more than once, and the rows beyond the first of each."""
    columns = df.columns if columns is None else columns
    repeated = F.col("value").isNotNull() & (F.col("n") > 1)
    found = (
        value_counts(df, columns, marked=True)
        .groupBy("column")
        .agg(
            tally(repeated).alias("n_repeated_values"),
            F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).alias("n_extra_rows"),
        )
    )
    # One row per column on both sides; a table without rows has no counts.
    return _named(df, columns).join(F.broadcast(found), "column", "left").na.fill(0)


def top_values(df: DataFrame, columns: list[str] | None = None, k: int = 3) -> DataFrame:
    """Per column: missing and distinct values, range, and the k most frequent values.

    The range is that of the numbers in a numeric column, else of the text; for
    whole and decimal numbers ``min_text`` and ``max_text`` have all digits,
    which the doubles beside them may lack. Equally frequent values come in the order
    of their text, long ones (over 64 characters) first and by digest.
    """
    columns = df.columns if columns is None else columns
    types = {f.name: f for f in df.schema}
    numeric = set(numeric_columns(df))

    def measures(name: str) -> dict[str, Column]:
        field, value = types[name], F.when(~missing(types[name]), quoted(name))
        floating = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        number = value.cast("double") if name in numeric else F.lit(None).cast("double")
        exact = name not in numeric or not floating
        ordered = value if name in numeric else value.cast("string")
        low, high = (
            (bound(ordered).cast("string") if exact else F.any_value(F.lit(None).cast("string")))
            for bound in (F.min, F.max)
        )
        return {
            "n_missing": tally(missing(field)),
            "min_number": F.min(number),
            "max_number": F.max(number),
            "min_text": low,
            "max_text": high,
        }

    # Missing values and ranges need no shuffle of values.
    overall = one_row_per_column(df, {c: measures(c) for c in columns})
    counts, value = value_counts(df, columns, marked=True), F.col("value")
    # Both sides use the same counts, unfiltered and with all columns (missing
    # values rank last and go afterwards): otherwise they would be made twice.
    used = value.isNotNull() & (F.col("n") > 0)
    distinct = counts.groupBy("column").agg(tally(used).alias("n_distinct"))
    frequent = top_n_per_group(
        counts, ["column"], [value.isNull().asc(), F.desc("n"), F.asc("value")], k
    ).filter(value.isNotNull())
    # The broadcast sides have one row, or at most k rows, per column of the table.
    report = overall.join(F.broadcast(distinct), "column", "left").join(
        F.broadcast(_readable(df, frequent, columns)), "column", "left"
    )
    return report.select(
        "column",
        "n_missing",
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        "min_number",
        "max_number",
        "min_text",
        "max_text",
        "rank",
        "value",
        "n",
    )


def _readable(df: DataFrame, frequent: DataFrame, columns: list[str]) -> DataFrame:
    """The marked values as they were: short ones without the mark, long ones looked up by their digest."""
    types = {f.name: f for f in df.schema}
    wide = {c: _as_text(types[c]) for c in columns if isinstance(types[c].dataType, T.StringType)}
    bare = F.substring("value", 2, DIGEST_BEYOND)
    if not wide:
        return frequent.withColumn("value", bare)
    wanted = frequent.filter(F.col("value").startswith("#")).select("column", F.col("value").alias("mark"))
    texts = _long_form(df, wide).filter(F.length("value") > DIGEST_BEYOND)
    texts = (
        texts.withColumn("mark", _marked(F.col("value")))
        .join(F.broadcast(wanted), ["column", "mark"])
        .groupBy("column", "mark")
        .agg(F.any_value("value").alias("text"))
    )
    return (
        frequent.withColumnRenamed("value", "mark")
        .join(F.broadcast(texts), ["column", "mark"], "left")
        .withColumn("value", F.coalesce("text", F.substring("mark", 2, DIGEST_BEYOND)))
        .drop("mark", "text")
    )


def target_by_value(
    df: DataFrame, column: str, target: str, *, digits: int | None = MEAN_DIGITS
) -> DataFrame:
    """Rows and mean of the target for each value of a column."""
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n_rows"), rounded(F.avg(target), digits).alias("mean_target")
    )
