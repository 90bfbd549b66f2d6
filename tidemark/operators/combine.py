"""Joins of measures and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_outer(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """All keys of both sides, values null where a side has none."""
    return left.join(right, keys, "outer")


def stack_measures(left: DataFrame, right: DataFrame, keys: list[str], colocate: list[str]) -> DataFrame:
    """Full outer join of two tables whose keys are unique, with one shuffle on ``colocate``.

    Stacking the tables and merging equal keys gives the rows of ``full_outer``
    but leaves the result partitioned by ``colocate``, so windows over those
    columns and joins on them need no further shuffle of these rows. A key that
    one side repeats raises an error in the same aggregation. Rows with a null
    key match nothing, as in a join.
    """
    values = [c for c in left.columns + right.columns if c not in keys]
    sided = left.withColumn("_side", F.lit(0)).unionByName(right.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    no_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    apart = sided.withColumn("_apart", F.when(no_key, F.monotonically_increasing_id()))
    merged = (
        apart.repartition(*colocate)
        .groupBy(*keys, "_apart")
        .agg(*[F.max(v).alias(v) for v in values], F.count("*").alias("_rows"), (F.max("_side") - F.min("_side") + 1).alias("_sides"))
    )
    message = F.lit(f"a key of {', '.join(keys)} is not unique in one of the stacked tables")
    unique = F.when(F.col("_rows") == F.col("_sides"), True).otherwise(F.raise_error(message).cast("boolean"))
    return merged.where(unique).select(*keys, *values)


def attach(fact: DataFrame, dimension: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join of dimension columns; a row without a match gets nulls.

    No join hint: Spark broadcasts a dimension only below its size limit.
    """
    return fact.join(dimension.select(key, *columns), key, "left")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Distinct child keys absent from the parent; a null child key counts as one."""
    keys = child.select(F.col(child_key)).distinct()
    known = parent.select(F.col(parent_key).alias("_parent_key")).distinct()
    return keys.join(known, keys[child_key] == known["_parent_key"], "left_anti")


def orphan_sample(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, size: int = 10) -> DataFrame:
    """The first ``size`` orphans in key order, for reports."""
    return orphans(child, parent, child_key, parent_key).orderBy(child_key).limit(size)
