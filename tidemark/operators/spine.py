"""Period lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(column).distinct()


def union_periods(tables: list[DataFrame], period: str) -> DataFrame:
    """Distinct periods of all tables together; each table is reduced before the union."""
    return reduce(DataFrame.unionByName, [distinct_values(t, period) for t in tables]).distinct()
