"""Ranks and shares of rows within their group and period, and within their period."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import percent
from tidemark.operators.keys import place_in_order
from tidemark.staging import Staging

STANDINGS = ["share_in_group", "share_in_nation", "rank_in_group", "rank_in_nation"]
_CELL = ["_part", "_period", "_no_period", "_group", "_no_group"]


def standings(
    df: DataFrame,
    group: str,
    period: str,
    value: str,
    tiebreak: str,
    staging: Staging,
    period_columns: DataFrame | None = None,
    reread: bool = False,
) -> DataFrame:
    """Add rank and share of ``value`` in (group, period) and in (period), at any size.

    Ranks run from the highest value, nulls last, ties by ``tiebreak``. A null
    period or group is a period or group of its own, as in a window. The rows
    are frozen, so that sorting samples them without computing them twice, then
    sorted once by (period, value, tiebreak) and numbered. Everything else
    comes from the counts and sums of the cells (sort task, period, group): a
    row's rank is its place in its cell plus the rows of earlier cells. No task
    ever receives more than one sort range of a period or group.

    ``period_columns`` is an optional table with one row per period whose
    other columns are added, through the small cell table. ``reread`` says that
    the rows are cheap to compute twice, so no copy is written before the sort.
    """
    order = [F.col(period), F.col(value).desc_nulls_last(), F.col(tiebreak)]
    rows = df if reread else staging.freeze(df, "unsorted")
    placed = place_in_order(rows, order, staging, "standings").withColumns(
        {
            "_period": F.coalesce(F.col(period).cast("string"), F.lit("")),
            "_no_period": F.col(period).isNull(),
            "_group": F.coalesce(F.col(group).cast("string"), F.lit("")),
            "_no_group": F.col(group).isNull(),
        }
    )
    offsets = _cell_offsets(placed, value, staging)
    if period_columns is not None:
        known = period_columns.withColumn("_period", F.col(period).cast("string")).withColumn("_no_period", F.lit(False))
        offsets = offsets.join(known.drop(period), ["_period", "_no_period"], "left")

    in_cell = Window.partitionBy(*_CELL).orderBy("_pos")
    ranked = placed.withColumn("_nth", F.row_number().over(in_cell)).join(offsets, _CELL, "left")
    return ranked.select(
        *df.columns,
        *_added(period_columns, period),
        percent(value, "_group_total").alias("share_in_group"),
        percent(value, "_period_total").alias("share_in_nation"),
        (F.col("_before_in_group") + F.col("_nth")).cast("int").alias("rank_in_group"),
        (F.col("_before_in_period") + F.col("_pos") - F.col("_first") + 1).cast("int").alias("rank_in_nation"),
    )


def standings_by_key(df: DataFrame, group: str, period: str, value: str, key: str, staging: Staging) -> DataFrame:
    """One row per ``key`` with ``standings``, a map from its periods to ranks and shares.

    The rank index: only (period, group, value, key) is sorted, numbered and shuffled, and wide rows that are
    partitioned by ``key`` already take their ranks by a join on it without another exchange. ``key`` and period are
    not null and unique together, so a map holds at most one entry per period.
    """
    ranked = standings(df.select(key, group, period, value), group, period, value, key, staging, reread=True)
    entry = F.struct(F.col(period).alias("key"), F.struct(*STANDINGS).alias("value"))
    return ranked.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("standings"))


def _added(period_columns: DataFrame | None, period: str) -> list[str]:
    return [c for c in period_columns.columns if c != period] if period_columns is not None else []


def _cell_offsets(placed: DataFrame, value: str, staging: Staging) -> DataFrame:
    """Totals, and rows in earlier sort tasks, for every cell.

    The cells are frozen, so the placed rows are read once for them and Spark
    knows their size when it plans the join.
    """
    summed = placed.groupBy(*_CELL).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_sum"), F.min("_pos").alias("_min_pos")
    )
    cells = staging.freeze(summed, "cells")
    runs = cells.groupBy("_part", "_period", "_no_period").agg(
        F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"), F.min("_min_pos").alias("_first")
    )
    by_period = Window.partitionBy("_period", "_no_period")
    by_group = Window.partitionBy("_period", "_no_period", "_group", "_no_group")
    runs = runs.select(
        "_part",
        "_period",
        "_no_period",
        "_first",
        F.sum("_sum").over(by_period).alias("_period_total"),
        _rows_before(by_period).alias("_before_in_period"),
    )
    cells = cells.select(
        *_CELL,
        F.sum("_sum").over(by_group).alias("_group_total"),
        _rows_before(by_group).alias("_before_in_group"),
    )
    return cells.join(runs, ["_part", "_period", "_no_period"])


def _rows_before(window):
    earlier = window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(earlier), F.lit(0))

