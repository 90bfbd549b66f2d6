"""Star schema: dimensions, entity, group and national facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import period_half, period_quarter, ratio, with_total
from tidemark.operators.combine import attach, stack_measures
from tidemark.operators.growth import with_growth
from tidemark.operators.keys import dense_index, new_keys, spine_index
from tidemark.operators.rollup import mean
from tidemark.operators.series import fold_series, series_wide
from tidemark.operators.spine import union_periods
from tidemark.operators.standings import STANDINGS, standings, standings_by_key
from tidemark.staging import Staging

DIM_ENTITY = [
    "entity_code",
    "entity_name",
    "group_code",
    "group_short",
    "group_name",
    "region_code",
    "region_name",
    "region_short",
]
FACT_ENTITY = [
    "entity_key",
    "period_key",
    "entity_code",
    "period",
    "measure",
    "total",
    "rate",
    "growth_total",
    "growth_measure",
    "share_in_group",
    "share_in_nation",
    "rank_in_group",
    "rank_in_nation",
]

GROUP_SUMS = ["group_code", "group_short", "group_name", "period", "entities", "measure", "total", "mean_rate"]
FACT_GROUP = [*GROUP_SUMS, "growth_total", "growth_measure", "share_in_nation", "rank_in_nation"]


def dim_entity(localities: DataFrame, staging: Staging, keys: DataFrame | None = None) -> DataFrame:
    """Entity dimension with the ``keys`` given (entity_key, entity_code), else a dense key in the order of the code."""
    places = localities.select(*DIM_ENTITY)
    if keys is None:
        return dense_index(places, ["entity_code"], staging, "entity_key")
    return places.join(keys.select("entity_key", "entity_code"), "entity_code").select("entity_key", *DIM_ENTITY)


def entity_keys(localities: DataFrame, known: DataFrame | None, staging: Staging) -> DataFrame:
    """Keys of the entities that have none yet: keys once given stay, whatever lands later."""
    return new_keys(localities, known, "entity_code", "entity_key", staging)


def dim_period(
    spark: SparkSession,
    tables: list[DataFrame],
    series: DataFrame | None = None,
    periods: list[int] | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Period dimension from given periods, else the tables, else the series, else five years up to ``as_of``."""
    if periods is not None:
        spine = spark.createDataFrame([(p,) for p in periods], "period int").distinct()
    else:
        filled = [t for t in tables if not t.isEmpty()]
        if filled:
            spine = union_periods(filled, "period")
        elif series is not None and not series.isEmpty():
            spine = series.select(F.col("year").alias("period")).distinct()
        else:
            last = (as_of or dt.date.today()).year
            spine = spark.range(last - 4, last + 1).select(F.col("id").cast("int").alias("period"))
    return spine_index(spine, "period", "period_key").withColumns(
        {"half": period_half("period"), "quarter": period_quarter("period")}
    )


def totals(measure: DataFrame, rate: DataFrame, period: int | None = None) -> DataFrame:
    """Measure, rate and total per entity and period, partitioned by entity; ``period`` picks one before the join.

    The roll-ups start here: they need neither keys nor ranks of the entity fact.
    """
    keys = ["entity_code", "period"]
    sides = [measure.select(*keys, "measure"), rate.select(*keys, "rate")]
    if period is not None:
        sides = [side.filter(F.col("period") == period) for side in sides]
    return with_total(stack_measures(*sides, keys, colocate=["entity_code"]), "rate", "measure", "total")


def fact_entity(
    measure: DataFrame,
    rate: DataFrame,
    entities: DataFrame,
    periods: DataFrame,
    staging: Staging,
    strict_growth: bool = False,
) -> DataFrame:
    """Entity fact from cleaned measure and rate, both unique per entity and period.

    ``total`` is in thousands. One shuffle by entity serves the outer join, both
    dimension lookups, the growth and the ranks; these come from an index of
    narrow rows, sorted once, so no full row is sorted or shuffled for them.
    """
    return fact_from_totals(totals(measure, rate), entities, periods, staging, strict_growth)


def fact_from_totals(
    both: DataFrame, entities: DataFrame, periods: DataFrame, staging: Staging, strict_growth: bool = False
) -> DataFrame:
    """Entity fact from the table of ``totals``, whose entities and periods are not null, as cleaning leaves them."""
    return fact_from_index(both, entities, periods, totals_index(both, entities, staging), strict_growth)


def totals_index(both: DataFrame, entities: DataFrame, staging: Staging) -> DataFrame:
    """Ranks and shares of every entity, as a map by period; ``entities`` needs code and group only."""
    narrow = attach(both.select("entity_code", "period", "total"), entities, "entity_code", ["group_code"])
    return standings_by_key(narrow, "group_code", "period", "total", "entity_code", staging)


def fact_from_index(
    both: DataFrame, entities: DataFrame, periods: DataFrame, index: DataFrame, strict_growth: bool = False
) -> DataFrame:
    """Entity fact from the totals, both dimensions and the rank index: one full-width shuffle, by entity."""
    located = attach(both, entities, "entity_code", ["entity_key"])
    grown = entity_growth(located, strict_growth)
    placed = attach(grown, index, "entity_code", ["standings"]).withColumn("_found", F.element_at("standings", F.col("period")))
    ranked = placed.withColumns({c: F.col(f"_found.{c}") for c in STANDINGS})
    return attach(ranked, periods, "period", ["period_key"]).select(*FACT_ENTITY)


def entity_growth(rows: DataFrame, strict: bool = False) -> DataFrame:
    """Rows with the growth of total and measure over the entity's previous period."""
    return with_growth(rows, {"total": "growth_total", "measure": "growth_measure"}, "period", ["entity_code"], strict)


def fact_group(fact: DataFrame, entities: DataFrame, staging: Staging) -> DataFrame:
    """Group fact from the entity fact or its totals: sums, unweighted mean rate, growth, national share and rank."""
    return group_standings(group_growth(group_sums(fact, entities)), staging)


def group_sums(fact: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities, sums and unweighted mean rate per group and period."""
    groups = ["group_code", "group_short", "group_name"]
    located = attach(fact, entities, "entity_code", groups)
    return located.groupBy(*groups, "period").agg(
        F.count("entity_code").alias("entities"),
        F.sum("measure").alias("measure"),
        F.sum("total").alias("total"),
        mean("rate").alias("mean_rate"),
    )


def group_growth(rolled: DataFrame) -> DataFrame:
    """The sums with their growth over the group's previous period."""
    return with_growth(rolled, {"total": "growth_total", "measure": "growth_measure"}, "period", ["group_code"])


def group_standings(grown: DataFrame, staging: Staging) -> DataFrame:
    """Group fact from sums with growth, for whole periods."""
    return standings(grown, "group_code", "period", "total", "group_code", staging).select(*FACT_GROUP)


def fact_nation(groups: DataFrame) -> DataFrame:
    """National fact from the group fact; a missing group code adds to the sums but not to the count."""
    rolled = groups.groupBy("period").agg(
        F.count("group_code").alias("groups"),
        F.sum("measure").alias("measure"),
        F.sum("total").alias("total"),
    )
    rated = rolled.withColumn("rate", ratio("total", "measure"))
    grown = with_growth(rated, {"total": "growth_total", "measure": "growth_measure"}, "period", [])
    return grown.select("period", "groups", "measure", "total", "rate", "growth_total", "growth_measure")


def fact_nation_from_series(periods: DataFrame, series: DataFrame, names: list[str]) -> DataFrame:
    """National fact from the series alone: mean, maximum and minimum of each per period."""
    points = series.withColumnRenamed("year", "period")
    return fold_series(periods, series_wide(points, "period", names), "period")


def nation_enriched(nation: DataFrame, series: DataFrame, names: list[str]) -> DataFrame:
    """National fact with the series columns added."""
    points = series.withColumnRenamed("year", "period")
    return nation.join(series_wide(points, "period", names), "period", "left")


def total_by_region(fact: DataFrame, entities: DataFrame, period: int) -> DataFrame:
    """Total per region for one period."""
    chosen = fact.filter(F.col("period") == period).select("entity_code", "total")
    return (
        attach(chosen, entities, "entity_code", ["region_name"])
        .groupBy("region_name")
        .agg(F.sum("total").alias("total"))
    )
