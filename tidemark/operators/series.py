"""Aggregation of many time series at once, from one long table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rollup import mean


def series_by_period(series: DataFrame, period: str, name: str = "series_name", value: str = "value") -> DataFrame:
    """Mean, maximum and minimum per period and series."""
    return series.groupBy(period, name).agg(
        mean(value).alias("mean"), F.max(value).alias("max"), F.min(value).alias("min")
    )


def series_wide(
    series: DataFrame, period: str, names: list[str], name: str = "series_name", value: str = "value"
) -> DataFrame:
    """One row per period with ``<series>_mean``, ``_max`` and ``_min`` columns.

    The series list is given, so the columns never depend on the data; a series
    without points gives nulls.
    """
    long = series_by_period(series.filter(F.col(name).isin(names)), period, name, value)
    wide = long.groupBy(period).pivot(name, names)
    return wide.agg(F.first("mean").alias("mean"), F.first("max").alias("max"), F.first("min").alias("min"))


def fold_series(spine: DataFrame, wide: DataFrame, period: str) -> DataFrame:
    """Series columns for every period of the spine, nulls where a period has no points."""
    return spine.select(period).distinct().join(wide, period, "left")
