"""Keeping one row per business key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: list[str], order_column: str | None = None) -> DataFrame:
    """One row per key: the latest by ``order_column``, ties broken by all other columns.

    Spark applies the rank-one limit on every task before the shuffle, so a key
    that holds a large part of all rows arrives as one row per task.
    """
    ties = [c for c in df.columns if c not in keys and c != order_column]
    latest = [F.col(order_column).desc_nulls_last()] if order_column else []
    order = latest + [F.col(c).asc_nulls_last() for c in ties]
    window = Window.partitionBy(*keys).orderBy(*(order or keys))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def keep_one(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the same one on every run."""
    return keep_latest(df, keys)
