"""Growth over the previous row of an ordered series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import percent


def with_growth(
    df: DataFrame, columns: dict[str, str], period: str, partition: list[str], strict: bool = False
) -> DataFrame:
    """Add growth in percent over the previous available period for each column.

    ``columns`` maps a value column to the name of its growth. The first
    period, a null on either side and a zero base give null. ``strict`` also
    gives null when the previous row is not the period directly before.
    A partition holds one row per period, so it never outgrows the number of
    periods; an empty ``partition`` suits tables with one row per period only.
    """
    window = Window.partitionBy(*partition).orderBy(period)
    added = {}
    for value, name in columns.items():
        previous = F.lag(value).over(window)
        if strict:
            previous = F.when(F.lag(period).over(window) == F.col(period) - 1, previous)
        added[name] = percent(F.col(value) - previous, previous)
    return df.withColumns(added)
