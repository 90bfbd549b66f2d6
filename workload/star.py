"""Dimensions, facts, joins, windows and roll-ups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.combine import attach, full_outer, stack_measures
from tidemark.operators.growth import with_growth
from tidemark.operators.rollup import LEVEL_AGGREGATES, rollup_level
from tidemark.operators.series import fold_series, series_by_period, series_wide
from tidemark.operators.standings import standings
from tidemark.plans import model
from tidemark.plans.clean import clean_localities, clean_measure, clean_rate, clean_series
from tidemark.sources.series import land_series, read_series, read_series_pieces, series_catalogue
from tidemark.staging import Staging
from workload.registry import query
from workload.standin import (
    BASE_SQL,
    DIM_ENTITY_SQL,
    DIM_PERIOD_SQL,
    ENT_SQL,
    FACT_SQL,
    GROUP_SQL,
    LOCALITIES_SQL,
    NATION_SQL,
    SERIES,
    SERIES_NAMES,
    base_sql,
    entity_codes,
    fact_sql,
    group_fact,
    growth_sql,
    localities,
    measure,
    order_values,
    order_values_sql,
    rate,
    series_code_sql,
    series_points,
    series_raw,
    share_sql,
    star,
    table,
    wide_sql,
)

FACT_COLUMNS = """entity_key, period_key, entity_code, period, measure, CAST(total AS DOUBLE) AS total,
  CAST(rate AS DOUBLE) AS rate, growth_total, growth_measure, share_in_group, share_in_nation,
  rank_in_group, rank_in_nation"""
GROUP_COLUMNS = """group_code, group_short, group_name, period, entities, measure, CAST(total AS DOUBLE) AS total,
  mean_rate, growth_total, growth_measure, share_in_nation, rank_in_nation"""
NATION_COLUMNS = "period, groups, measure, CAST(total AS DOUBLE) AS total, rate, growth_total, growth_measure"


# Cleaning


def _clean_sql(name: str, type_: str, low: int, high: int, factor: int) -> str:
    value = f"trunc(value)::{type_}" if type_ == "BIGINT" else f"value::{type_}"
    return f"""WITH {ENT_SQL}, {order_values_sql(factor)},
typed AS (SELECT entity_code, upper(trim(entity_name)) AS entity_name, period, {value} AS {name},
                 processed_at, load_date FROM raw),
ranked AS (SELECT *, row_number() OVER (PARTITION BY entity_code, period
             ORDER BY processed_at DESC NULLS LAST, entity_name, {name}, load_date) AS rn
           FROM typed WHERE {name} > {low} AND {name} < {high})
SELECT entity_code, entity_name, substr(entity_code, 1, 2) AS group_code, period, {name}, processed_at, load_date
FROM ranked WHERE rn = 1"""


@query("clean_measure", _clean_sql("measure", "BIGINT", 0, 20_000_000, 60))
def clean_measure_(spark, sf):
    return clean_measure(order_values(spark, sf, 60))


@query("clean_rate", _clean_sql("rate", "DOUBLE", 0, 1_000_000, 3))
def clean_rate_(spark, sf):
    return clean_rate(order_values(spark, sf, 3), "double")


@query(
    "clean_localities",
    f"""WITH {LOCALITIES_SQL} SELECT *, TIMESTAMP '2024-05-01 00:00:00' AS processed_at,
        DATE '2024-05-01' AS load_date FROM localities""",
)
def clean_localities_(spark, sf):
    return clean_localities(localities(spark, sf))


@query(
    "clean_series",
    f"""SELECT * EXCLUDE (rn) FROM (
          SELECT {series_code_sql()} AS series_code, event_type AS series_name,
                 strftime(ts, '%d/%m/%Y') AS date_text, CAST(ts AS DATE) AS obs_date,
                 CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
                 CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) AS value_text,
                 CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS value, 'events' AS source, ts AS processed_at,
                 CAST(ts AS DATE) AS load_date,
                 row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, value) AS rn
          FROM events) WHERE rn = 1""",
)
def clean_series_(spark, sf):
    catalogue = series_catalogue(spark, SERIES)
    raw = series_raw(spark, sf)
    codes = catalogue.select("series_code", "series_name")
    tagged = raw.join(F.broadcast(codes), "series_code").select(
        "series_code",
        "series_name",
        F.col("data").alias("date_text"),
        F.lit(None).cast("date").alias("obs_date"),
        F.col("valor").alias("value_text"),
        F.lit(None).cast("decimal(18,4)").alias("value"),
        F.lit("events").alias("source"),
        "processed_at",
        "load_date",
    )
    return clean_series(tagged, min_year=2010)


LAND_SERIES_SQL = f"""SELECT {series_code_sql()} AS series_code, event_type AS series_name, 'events' AS source,
               strftime(ts, '%d/%m/%Y') AS date_text, CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) AS value_text,
               CAST(ts AS DATE) AS obs_date, CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS value,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month FROM events"""


@query("land_series", LAND_SERIES_SQL)
def land_series_(spark, sf):
    return land_series(series_raw(spark, sf), series_catalogue(spark, SERIES), "events")


@query("land_series_files", LAND_SERIES_SQL)
def land_series_files(spark, sf):
    """The same through landed files, one folder a series and one point a line."""
    folder = Staging(spark).folder("series")
    line = F.to_json(F.struct("data", "valor")).alias("value")
    series_raw(spark, sf).select("series_code", line).write.partitionBy("series_code").text(folder)
    return read_series(spark, folder, series_catalogue(spark, SERIES), "events", lines=True)


@query("land_series_pieces", LAND_SERIES_SQL)
def land_series_pieces(spark, sf):
    """The same through files that hold whole arrays, cut at a key."""
    folder = Staging(spark).folder("series")
    point = F.to_json(F.struct("data", "valor"))
    days = series_raw(spark, sf).withColumn("day", F.to_date("processed_at"))
    arrays = days.groupBy("series_code", "day").agg(F.concat(F.lit("[ "), F.array_join(F.collect_list(point), ", "), F.lit(" ]")).alias("value"))
    arrays.select("series_code", "value").write.partitionBy("series_code").text(folder)
    return read_series_pieces(spark, folder, series_catalogue(spark, SERIES), "events")


# Dimensions


@query("dim_entity", f"WITH {DIM_ENTITY_SQL} SELECT * FROM dim_entity")
def dim_entity(spark, sf):
    return model.dim_entity(clean_localities(localities(spark, sf)), Staging(spark))


@query("dim_period", f"WITH {BASE_SQL}, {DIM_PERIOD_SQL} SELECT * FROM dim_period")
def dim_period(spark, sf):
    tables = Staging(spark).freeze_all({"measure": measure(spark, sf), "rate": rate(spark, sf)})
    return model.dim_period(spark, list(tables.values()))


# Joins


@query(
    "outer_measures",
    f"WITH {BASE_SQL} SELECT entity_code, period, measure, CAST(rate AS DOUBLE) AS rate FROM base",
)
def outer_measures(spark, sf):
    return full_outer(measure(spark, sf), rate(spark, sf), ["entity_code", "period"])


@query(
    "stacked_measures",
    f"WITH {BASE_SQL} SELECT entity_code, period, measure, CAST(rate AS DOUBLE) AS rate FROM base",
)
def stacked_measures(spark, sf):
    keys = ["entity_code", "period"]
    return stack_measures(measure(spark, sf), rate(spark, sf), keys, ["entity_code"])


@query(
    "attach_group",
    f"""WITH {ENT_SQL}, {LOCALITIES_SQL} SELECT o_orderkey, e.entity_code, group_code, group_name, region_name
        FROM orders JOIN ent e ON o_custkey = c_custkey LEFT JOIN localities l ON e.entity_code = l.entity_code
          AND l.group_code <> '03'""",
)
def attach_group(spark, sf):
    orders = table(spark, sf, "orders")
    coded = orders.join(entity_codes(spark, sf), orders.o_custkey == F.col("c_custkey"))
    known = clean_localities(localities(spark, sf)).filter("group_code <> '03'")
    fact = coded.select("o_orderkey", "entity_code")
    return attach(fact, known, "entity_code", ["group_code", "group_name", "region_name"])


@query(
    "attach_keys",
    f"WITH {FACT_SQL} SELECT entity_key, period_key, entity_code, period FROM fact",
)
def attach_keys(spark, sf):
    return star(spark, sf)["fact_entity"].select("entity_key", "period_key", "entity_code", "period")


# Facts


@query("fact_entity", f"WITH {FACT_SQL} SELECT {FACT_COLUMNS} FROM fact")
def fact_entity(spark, sf):
    return star(spark, sf)["fact_entity"]


@query(
    "fact_entity_no_overlap",
    f"""WITH {fact_sql(base_sql("year(o_orderdate) = 1998", "year(o_orderdate) = 1996"))}
        SELECT {FACT_COLUMNS} FROM fact""",
)
def fact_entity_no_overlap(spark, sf):
    """Measure and rate of different years, as the default periods give: no total, ranks by code."""
    staging = Staging(spark)
    clean = staging.freeze_all(
        {
            "measure": measure(spark, sf).filter("period = 1998"),
            "rate": rate(spark, sf).filter("period = 1996"),
        }
    )
    measures, rates = clean["measure"], clean["rate"]
    entities = model.dim_entity(clean_localities(localities(spark, sf)), staging)
    return model.fact_entity(measures, rates, entities, model.dim_period(spark, [measures, rates]), staging)


@query("fact_group", f"WITH {GROUP_SQL} SELECT {GROUP_COLUMNS} FROM fact_group")
def fact_group(spark, sf):
    return group_fact(spark, sf)


@query("fact_nation", f"WITH {NATION_SQL} SELECT {NATION_COLUMNS} FROM fact_nation")
def fact_nation(spark, sf):
    return model.fact_nation(group_fact(spark, sf))


@query(
    "star_region_total",
    f"""WITH {FACT_SQL} SELECT region_name, CAST(sum(total) AS DOUBLE) AS total
        FROM fact f LEFT JOIN dim_entity d ON f.entity_code = d.entity_code WHERE period = 1998 GROUP BY 1""",
)
def star_region_total(spark, sf):
    year = model.totals(measure(spark, sf), rate(spark, sf), period=1998)
    return model.total_by_region(year, clean_localities(localities(spark, sf)), 1998)


# Growth, shares and ranks on their own


@query(
    "growth_entity",
    f"""WITH {BASE_SQL} SELECT entity_code, period, measure,
        {growth_sql("measure", "PARTITION BY entity_code ORDER BY period")} AS growth_measure FROM measure""",
)
def growth_entity(spark, sf):
    return with_growth(measure(spark, sf), {"measure": "growth_measure"}, "period", ["entity_code"])


@query(
    "growth_strict",
    f"""WITH {BASE_SQL} SELECT entity_code, period, measure,
        CASE WHEN lag(period) OVER (PARTITION BY entity_code ORDER BY period) = period - 1 THEN
        {growth_sql("measure", "PARTITION BY entity_code ORDER BY period")} END AS growth_measure FROM measure""",
)
def growth_strict(spark, sf):
    return with_growth(measure(spark, sf), {"measure": "growth_measure"}, "period", ["entity_code"], strict=True)


PER_GROUP_SQL = """per_group AS (
  SELECT substr(entity_code, 1, 2) AS group_code, period, CAST(sum(measure) AS BIGINT) AS measure
  FROM measure GROUP BY 1, 2)"""


def _per_group(spark, sf):
    grouped = measure(spark, sf).groupBy(F.substring("entity_code", 1, 2).alias("group_code"), "period")
    return grouped.agg(F.sum("measure").alias("measure"))


@query(
    "growth_group",
    f"""WITH {BASE_SQL}, {PER_GROUP_SQL} SELECT *,
        {growth_sql("measure", "PARTITION BY group_code ORDER BY period")} AS growth_measure FROM per_group""",
)
def growth_group(spark, sf):
    return with_growth(_per_group(spark, sf), {"measure": "growth_measure"}, "period", ["group_code"])


@query(
    "growth_nation",
    f"""WITH {BASE_SQL}, per_year AS (SELECT period, CAST(sum(measure) AS BIGINT) AS measure FROM measure GROUP BY 1)
        SELECT *, {growth_sql("measure", "ORDER BY period")} AS growth_measure FROM per_year""",
)
def growth_nation(spark, sf):
    per_year = measure(spark, sf).groupBy("period").agg(F.sum("measure").alias("measure"))
    return with_growth(per_year, {"measure": "growth_measure"}, "period", [])


ORDER_STANDINGS_SQL = f"""WITH o AS (
  SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, nullif(CAST(year(o_orderdate) AS INTEGER), 1995) AS period,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 50000) * 50000 AS DECIMAL(18,2)) END AS value
  FROM orders)
SELECT o_orderkey, priority, period, CAST(value AS DOUBLE) AS value,
  {share_sql("value", "PARTITION BY priority, period")} AS share_in_group,
  {share_sql("value", "PARTITION BY period")} AS share_in_nation,
  CAST(row_number() OVER (PARTITION BY priority, period ORDER BY value DESC NULLS LAST, o_orderkey) AS INTEGER)
    AS rank_in_group,
  CAST(row_number() OVER (PARTITION BY period ORDER BY value DESC NULLS LAST, o_orderkey) AS INTEGER)
    AS rank_in_nation
FROM o"""


@query("order_standings", ORDER_STANDINGS_SQL)
def order_standings(spark, sf):
    """Ranks and shares with few distinct values, a third of them null, a null group and a null period."""
    rounded = (F.floor(F.col("o_totalprice") / 50000) * 50000).cast("decimal(18,2)")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.nullif(F.year("o_orderdate"), F.lit(1995)).alias("period"),
        F.when(F.col("o_orderstatus") != "P", rounded).alias("value"),
    )
    return standings(orders, "priority", "period", "value", "o_orderkey", Staging(spark))


# Roll-ups and series


@query(
    "declared_rollup",
    """SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS period,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price_sum,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS price_avg,
              count(o_totalprice) AS price_count
       FROM orders GROUP BY 1, 2""",
)
def declared_rollup(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderpriority",
        F.year("o_orderdate").alias("period"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    return rollup_level(orders, ["o_orderpriority", "period"], ["price"], LEVEL_AGGREGATES["group"])


@query(
    "series_by_period",
    """SELECT CAST(day(ts) AS INTEGER) AS period, event_type AS series_name,
              CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(value) AS mean,
              CAST(max(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS max,
              CAST(min(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS min
       FROM events GROUP BY 1, 2""",
)
def series_by_period_(spark, sf):
    return series_by_period(series_points(spark, sf), "period")


@query("series_wide", wide_sql("CAST(day(ts) AS INTEGER)"))
def series_wide_(spark, sf):
    return series_wide(series_points(spark, sf), "period", SERIES_NAMES)


@query(
    "series_fold",
    f"""WITH wide AS ({wide_sql("CAST(day(ts) AS INTEGER)")}),
        spine AS (SELECT DISTINCT CAST(day(o_orderdate) AS INTEGER) AS period FROM orders)
        SELECT s.period, wide.* EXCLUDE (period) FROM spine s LEFT JOIN wide ON s.period = wide.period""",
)
def series_fold(spark, sf):
    spine = table(spark, sf, "orders").select(F.dayofmonth("o_orderdate").alias("period"))
    return fold_series(spine, series_wide(series_points(spark, sf), "period", SERIES_NAMES), "period")


@query(
    "nation_from_series",
    f"""WITH wide AS ({wide_sql("CAST(year(ts) AS INTEGER)")}),
        spine AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS period FROM orders
                  UNION SELECT CAST(year(ts) AS INTEGER) FROM events)
        SELECT s.period, wide.* EXCLUDE (period) FROM spine s LEFT JOIN wide ON s.period = wide.period""",
)
def nation_from_series(spark, sf):
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("period"))
    events = table(spark, sf, "events").select(F.year("ts").alias("period"))
    periods = model.dim_period(spark, [orders, events], as_of=dt.date(2024, 12, 31))
    return model.fact_nation_from_series(periods, _yearly_points(spark, sf), SERIES_NAMES)


def _yearly_points(spark, sf, shift: int = 0):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("series_name"),
        (F.year("ts") - shift).alias("year"),
        F.col("value").cast("decimal(18,4)").alias("value"),
    )


@query(
    "nation_enriched",
    f"""WITH {NATION_SQL}, wide AS ({wide_sql("CAST(year(ts) AS INTEGER) - 26")})
        SELECT {NATION_COLUMNS.replace("period", "n.period")}, wide.* EXCLUDE (period)
        FROM fact_nation n LEFT JOIN wide ON n.period = wide.period""",
)
def nation_enriched(spark, sf):
    nation = model.fact_nation(group_fact(spark, sf))
    return model.nation_enriched(nation, _yearly_points(spark, sf, shift=26), SERIES_NAMES)
