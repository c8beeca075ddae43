"""Column-to-column helpers, all built from Catalyst expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

from cinetally.schemas import LIST_SEPARATOR


def quoted(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def instant(epoch_seconds: Column) -> Column:
    """Epoch seconds as a timestamp."""
    return F.timestamp_seconds(epoch_seconds)


def calendar(moment: Column) -> dict[str, Column]:
    """Calendar fields in the session time zone; weeks start on Sunday = 1."""
    return {
        "year": F.year(moment),
        "month": F.month(moment),
        "day": F.dayofmonth(moment),
        "dayOfWeek": F.dayofweek(moment),
        "hour": F.hour(moment),
    }


def list_items(text: Column, separator: str = LIST_SEPARATOR, drop: str | None = None) -> Column:
    """A delimited list as an array, optionally without one marker value."""
    items = F.split(text, re.escape(separator))
    return items if drop is None else F.array_remove(items, drop)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` as a percentage of ``whole``; NULL when there is no whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def missing(field: T.StructField) -> Column:
    """NULL, or NaN in a floating-point column."""
    value = quoted(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def tally(condition: Column) -> Column:
    """Aggregate: number of rows where the condition is true."""
    return F.count(F.when(condition, F.lit(1)))
