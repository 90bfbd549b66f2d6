"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_present(columns: list[str]) -> Column:
    """True where every named column holds a value."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.filter(all_present(columns))


def within_open(column: str, low: float, high: float) -> Column:
    """Strictly between the bounds; null fails."""
    return (F.col(column) > low) & (F.col(column) < high)


def within_closed(column: str, low: float | None, high: float | None) -> Column:
    """Between the bounds, bounds included; an absent bound does not restrict."""
    tests = []
    if low is not None:
        tests.append(F.col(column) >= low)
    if high is not None:
        tests.append(F.col(column) <= high)
    return reduce(lambda a, b: a & b, tests, F.lit(True))
