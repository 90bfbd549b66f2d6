"""Dense positions in a total order, for surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.staging import Staging

# A generated id holds the task in its upper bits and the position within the
# task in its lower 33 bits (documented behaviour of monotonically_increasing_id).
_POSITION_BITS = 33


def place_in_order(df: DataFrame, order: list[Column | str], staging: Staging, name: str) -> DataFrame:
    """Sort, number and freeze the rows: ``_pos`` follows the order, ``_part`` names the sort task.

    The sort cuts the order into ranges of similar size over all its columns,
    so a frequent value is spread over several tasks by the later columns.
    """
    ordered = df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id())
    placed = staging.freeze(ordered, name)
    return placed.withColumn("_part", F.shiftright("_pos", _POSITION_BITS))


def dense_index(df: DataFrame, order: list[Column | str], staging: Staging, index: str, start: int = 0) -> DataFrame:
    """Add a gap-free bigint index that follows a total order of the rows.

    Only the row counts per sort task, at most one per shuffle partition, are
    summed up in one place and broadcast.
    """
    placed = place_in_order(df, order, staging, index)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col("_pos") - F.shiftleft("_part", _POSITION_BITS)
    indexed = placed.join(F.broadcast(offsets), "_part").withColumn(index, F.col("_before") + within + start)
    return indexed.select(index, *df.columns)


def new_keys(codes: DataFrame, known: DataFrame | None, code: str, index: str, staging: Staging) -> DataFrame:
    """Rows (``index``, ``code``) for the codes that have no key among ``known`` yet.

    Known keys never change, also those of codes that are gone; new ones follow the largest without a gap, in the
    order of the code. Without ``known`` the keys start at 0. Null codes get none.
    """
    fresh, start = codes.select(code).where(F.col(code).isNotNull()).distinct(), 0
    if known is not None:
        fresh = fresh.join(known.select(code), code, "left_anti")
        largest = known.agg(F.max(index)).first()[0]
        start = 0 if largest is None else largest + 1
    return dense_index(fresh, [code], staging, index, start)


def spine_index(values: DataFrame, column: str, index: str) -> DataFrame:
    """One-based position of each value of a short list, such as the distinct periods."""
    position = F.row_number().over(Window.orderBy(column)).cast("bigint")
    return values.select(position.alias(index), column)
