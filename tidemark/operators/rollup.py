"""Roll-ups from one level to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio


def mean(column: str) -> Column:
    """Unweighted mean as double: exact sum first, one division last."""
    return ratio(F.sum(column), F.count(column))


# Aggregates a level may declare.
AGGREGATES = {"sum": F.sum, "avg": mean, "count": F.count}

# Declared aggregates per level.
LEVEL_AGGREGATES = {
    "entity": ["sum", "avg", "count"],
    "group": ["sum", "avg", "count"],
    "nation": ["sum", "avg"],
}


def rollup_level(df: DataFrame, keys: list[str], columns: list[str], aggregates: list[str]) -> DataFrame:
    """Apply each declared aggregate to each column, named ``<column>_<aggregate>``."""
    return df.groupBy(*keys).agg(*[AGGREGATES[a](c).alias(f"{c}_{a}") for c in columns for a in aggregates])


def distinct_count(df: DataFrame, keys: list[str], name: str = "distinct_keys") -> DataFrame:
    """Number of distinct keys, where a null counts as a value."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias(name))
