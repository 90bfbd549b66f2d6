"""Facts after a landing of a few periods: which periods change, and the rows of these periods alone.

A landed period changes its own values, shares and ranks, and the growth of the
rows whose previous row is, or was, in it: for each entity its next available
period. Nothing else changes, as long as keys and groups stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.combine import attach
from tidemark.plans import model
from tidemark.staging import Staging


def touched_periods(before: DataFrame, after: DataFrame, key: str, landed: list[int]) -> list[int]:
    """Periods of ``after`` to build again: the landed ones, and those with a row that follows, or followed, one of them.

    Both tables hold ``key`` and period. Only these two columns are read and shuffled, and a key has at most one row
    per period. The answer is as long as the list of periods at most. A row that follows a landed one is later than the
    first of these, so earlier partitions are not read.
    """
    from_first = F.col("period") >= min(landed, default=0)
    sides = [(before.where(from_first), "_before"), (after.where(from_first), "_after")]
    marked = [df.select(key, "period", *[F.lit(name == side).alias(name) for _, name in sides]) for df, side in sides]
    merged = marked[0].unionByName(marked[1]).groupBy(key, "period").agg(*[F.max(name).alias(name) for _, name in sides])
    earlier = Window.partitionBy(key).orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    follows = F.lit(False)
    for _, name in sides:
        previous = F.last(F.when(F.col(name), F.col("period")), ignorenulls=True).over(earlier)
        follows = follows | F.coalesce(previous.isin(landed), F.lit(False))
    changed = merged.withColumn("_touched", follows | F.col("period").isin(landed)).where(F.col("_after") & F.col("_touched"))
    return sorted(r["period"] for r in changed.select("period").distinct().collect())


def moved_periods(fact: DataFrame, periods: DataFrame) -> list[int]:
    """Periods of the old entity fact whose key is another one now."""
    keys = fact.select("period", "period_key").distinct()
    now = periods.select("period", F.col("period_key").alias("_now"))
    return [r["period"] for r in keys.join(now, "period").where("period_key <> _now").collect()]


def basis(entities: DataFrame) -> DataFrame:
    """One row that changes with any key or group of an entity: facts built on another basis are built again as a whole."""
    columns = ["entity_code", "entity_key", "group_code", "group_short", "group_name"]
    hashes = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    return entities.agg(F.concat_ws(":", F.count(F.lit(1)), hashes).alias("basis"))


def fact_entity_of(
    before: DataFrame, measure: DataFrame, rate: DataFrame, entities: DataFrame, periods: DataFrame, landed: list[int], dirty: list[int], staging: Staging
) -> DataFrame:
    """The entity fact's rows of the ``dirty`` periods, equal to those of the whole fact; later periods are not read.

    Only the ``landed`` periods are merged and ranked again. Shares and ranks of the others have not changed, so their
    rows come from the fact as it is, and the growth of all is taken anew. Of periods that are not dirty only the values
    that growth compares with are read.
    """
    in_landed, in_dirty = F.col("period").isin(landed), F.col("period").isin(dirty)
    both = staging.freeze(model.totals(measure.where(in_landed), rate.where(in_landed)), "totals")
    fresh = model.fact_from_index(both, entities, periods, model.totals_index(both, entities, staging))
    again = ["growth_total", "growth_measure", "period_key"]
    kept = before.where(in_dirty & ~in_landed).select(*[c for c in model.FACT_ENTITY if c not in again])
    earlier = before.where((F.col("period") < max(dirty, default=0)) & ~in_dirty & ~in_landed).select("entity_code", "period", "measure", "total")
    rows = fresh.drop(*again).unionByName(kept).unionByName(earlier, allowMissingColumns=True)
    grown = model.entity_growth(rows).where(in_dirty)
    return attach(grown, periods, "period", ["period_key"]).select(*model.FACT_ENTITY)


def fact_group_of(old: DataFrame, fact: DataFrame, entities: DataFrame, landed: list[int], staging: Staging) -> DataFrame:
    """The group fact's rows that a landing changes, from the old group fact and the landed periods of the entity fact."""
    sums = model.group_sums(fact.where(F.col("period").isin(landed)), entities)
    kept = old.select(*model.GROUP_SUMS).where(~F.col("period").isin(landed))
    now = staging.freeze(kept.unionByName(sums), "group_sums")
    dirty = touched_periods(old, now, "group_code", landed)
    grown = model.group_growth(now).where(F.col("period").isin(dirty))
    return staging.freeze(model.group_standings(grown, staging), "group_rows")
