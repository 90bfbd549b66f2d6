"""Choosing periods of a source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick_periods(df: DataFrame, column: str, period: int | None, default: list[int]) -> DataFrame:
    """Rows of one period, or of the default list when none is given."""
    return df.filter(F.col(column) == period if period is not None else F.col(column).isin(default))


def trailing_window(
    df: DataFrame,
    column: str,
    as_of: dt.date | None = None,
    years: int | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Rows of the last ``years`` times 365 days up to ``as_of``, or from first to last.

    Without a complete choice of either kind every row is kept.
    """
    if years is not None:
        last = as_of or dt.date.today()
        first = last - dt.timedelta(days=years * 365)
    if first is None or last is None:
        return df
    return df.filter(F.col(column).between(F.lit(first), F.lit(last)))
