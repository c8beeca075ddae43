"""How columns of a table go together.

Three measures, by the kinds of the columns: Pearson's correlation of two numbers,
the correlation ratio of a label and a number, and the uncertainty coefficient
of two labels. All come from sums that combine on the map side; labels
go through the shuffle as marked digests where they are long.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from cinetally.functions.columns import quoted, rounded
from cinetally.operators.aggregates import MEAN_DIGITS, numeric_columns
from cinetally.operators.profiling import label_of

#: Pairs whose co-moments are kept in one aggregation; more pairs take more passes.
PAIRS_AT_ONCE = 200


def _number(name: str) -> Column:
    return F.nanvl(quoted(name).cast("double"), F.lit(None))


def correlations(
    df: DataFrame, columns: list[str] | None = None, *, digits: int | None = MEAN_DIGITS
) -> DataFrame:
    """(column_a, column_b, n, correlation) of all pairs of numeric columns.

    Rows where one of the two is missing (NULL or NaN) are left out of that pair. The
    correlation is NULL for fewer than two rows and for a constant column.
    """
    columns = numeric_columns(df) if columns is None else columns
    pairs = list(combinations(columns, 2))
    if not pairs:
        return df.sparkSession.createDataFrame(
            [], "column_a string, column_b string, n bigint, correlation double"
        )

    def measured(some: list[tuple[str, str]]) -> DataFrame:
        sums, rows = [], []
        for place, (a, b) in enumerate(some):
            x, y = _number(a), _number(b)
            both = x.isNotNull() & y.isNotNull()
            spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
            sums.append(F.count(F.when(both, F.lit(1))).alias(f"n{place}"))
            sums.append(rounded(F.try_divide(F.covar_pop(x, y), spread), digits).alias(f"r{place}"))
            found = F.col(f"n{place}").alias("n"), F.col(f"r{place}").alias("correlation")
            rows.append(F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), *found))
        return df.agg(*sums).select(F.inline(F.array(*rows)))

    chunks = [pairs[i : i + PAIRS_AT_ONCE] for i in range(0, len(pairs), PAIRS_AT_ONCE)]
    return reduce(DataFrame.unionByName, map(measured, chunks))


def correlation_ratios(
    df: DataFrame, labels: list[str], numbers: list[str] | None = None, *, digits: int | None = MEAN_DIGITS
) -> DataFrame:
    """(label, number, n, ratio): the share of a number's spread that lies between the groups of a label, as its root.

    Rows without label or number are left out. The ratio is NULL where the number does not vary.
    """
    numbers = [c for c in numeric_columns(df) if c not in labels] if numbers is None else numbers
    types = {f.name: f for f in df.schema}
    pairs = [
        F.struct(F.lit(a).alias("label"), label_of(types[a]).alias("value"), F.lit(b).alias("number"), _number(b).alias("x"))
        for a in labels
        for b in numbers
    ]
    if not pairs:
        return df.sparkSession.createDataFrame([], "label string, number string, n bigint, ratio double")
    groups = (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull() & F.col("x").isNotNull())
        .groupBy("label", "number", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("spread"))
    )
    # One row per pair of columns. Deviations from the mean keep their digits, unlike differences of squares.
    overall = groups.groupBy("label", "number").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))
    between = F.sum(F.col("n") * F.pow(F.col("mean") - F.col("centre"), F.lit(2)))
    return (
        groups.join(F.broadcast(overall), ["label", "number"])
        .groupBy("label", "number")
        .agg(F.sum("n").alias("n"), between.alias("between"), F.sum(F.col("n") * F.col("spread")).alias("within"))
        .select("label", "number", "n", rounded(F.sqrt(F.try_divide("between", F.col("between") + F.col("within"))), digits).alias("ratio"))
    )


def uncertainties(df: DataFrame, labels: list[str], *, digits: int | None = MEAN_DIGITS) -> DataFrame:
    """(known, told, n, uncertainty): the share of the entropy of ``told`` that goes once ``known`` is known.

    For all ordered pairs of the columns, over rows that have both values. NULL where ``told`` does not vary.
    """
    types = {f.name: f for f in df.schema}
    pairs = [
        F.struct(
            F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
            label_of(types[a]).alias("value_a"), label_of(types[b]).alias("value_b"),
        )
        for a, b in combinations(labels, 2)
    ]
    if not pairs:
        return df.sparkSession.createDataFrame([], "known string, told string, n bigint, uncertainty double")
    joint = (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value_a").isNotNull() & F.col("value_b").isNotNull())
        .groupBy("column_a", "column_b", "value_a", "value_b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    keys = ["column_a", "column_b"]

    def entropy(counts: DataFrame, name: str) -> DataFrame:
        """log N - sum of n log n / N: no total has to be known beforehand."""
        total = F.sum("n")
        found = F.log(total) - F.sum(F.col("n") * F.log("n")) / total
        return counts.groupBy(*keys).agg(found.alias(name), total.alias(f"n_{name}"))

    def margin(value: str) -> DataFrame:
        return joint.groupBy(*keys, value).agg(F.sum("n").alias("n"))

    # One row per pair of columns on every side.
    found = (
        entropy(joint, "both")
        .join(F.broadcast(entropy(margin("value_a"), "a")), keys)
        .join(F.broadcast(entropy(margin("value_b"), "b")), keys)
    )
    shared = F.col("a") + F.col("b") - F.col("both")

    def told(known: str, of: str, own: str) -> Column:
        share = F.when(F.col(own) > 1e-12, F.greatest(shared, F.lit(0.0)) / F.col(own))
        return F.struct(
            F.col(known).alias("known"), F.col(of).alias("told"), F.col("n_both").alias("n"), rounded(share, digits).alias("uncertainty")
        )

    return found.select(F.inline(F.array(told("column_a", "column_b", "b"), told("column_b", "column_a", "a"))))
