"""The given tables in the shape of the library's inputs, and the same as SQL.

Entities are customers, groups nations, periods order years. The measure is the
quantity and the rate the price total per customer and year; orders in status P
have no rate. Series are event types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import model
from tidemark.plans.clean import clean_localities
from tidemark.sources.lake import read_table
from tidemark.staging import Staging, at_once

SERIES = {"view": 11, "signup": 12, "purchase": 13, "error": 14, "click": 15, "uncoded": None}
SERIES_NAMES = ["view", "signup", "purchase", "error", "click"]


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def code(nation: str, customer: str):
    return F.concat(
        F.lpad(F.col(nation).cast("string"), 2, "0"), F.lpad(F.col(customer).cast("string"), 12, "0")
    )


def entity_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", code("c_nationkey", "c_custkey").alias("entity_code")
    )


def localities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw localities: lower-case padded names, numeric codes."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return joined.select(
        code("c_nationkey", "c_custkey").alias("entity_code"),
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("entity_name"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("group_code"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("group_short"),
        F.lower("n_name").alias("group_name"),
        F.col("r_regionkey").alias("region_code"),
        F.lower("r_name").alias("region_name"),
        F.substring("r_name", 1, 2).alias("region_short"),
        F.to_timestamp_ntz(F.lit("2024-05-01 00:00:00")).alias("processed_at"),
        F.lit("2024-05-01").cast("date").alias("load_date"),
    )


ENT_SQL = """ent AS (
  SELECT c_custkey, c_name,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS entity_code
  FROM customer)"""

LOCALITIES_SQL = """localities AS (
  SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS entity_code,
         upper(c_name) AS entity_name,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS group_code,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS group_short,
         upper(n_name) AS group_name,
         CAST(r_regionkey AS VARCHAR) AS region_code,
         upper(r_name) AS region_name,
         upper(substr(r_name, 1, 2)) AS region_short
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

DIM_ENTITY_SQL = (
    LOCALITIES_SQL
    + """,
dim_entity AS (
  SELECT CAST(row_number() OVER (ORDER BY entity_code) - 1 AS BIGINT) AS entity_key, * FROM localities)"""
)


def order_values(spark: SparkSession, sf_dir: str, factor: int) -> DataFrame:
    """Raw values at order grain: many copies per entity and period, some out of bounds."""
    orders = table(spark, sf_dir, "orders")
    return orders.join(entity_codes(spark, sf_dir), orders.o_custkey == F.col("c_custkey")).select(
        "entity_code",
        F.concat(F.lit(" "), F.lower("c_name"), F.lit("  ")).alias("entity_name"),
        F.year("o_orderdate").alias("period"),
        (F.col("o_totalprice") * factor).alias("value"),
        F.lit("orders").alias("source"),
        F.col("o_orderdate").alias("processed_at"),
        F.to_date("o_orderdate").alias("load_date"),
    )


def order_values_sql(factor: int) -> str:
    return f"""raw AS (
  SELECT entity_code, ' ' || lower(c_name) || '  ' AS entity_name, CAST(year(o_orderdate) AS INTEGER) AS period,
         o_totalprice * {factor} AS value, 'orders' AS source,
         o_orderdate AS processed_at, CAST(o_orderdate AS DATE) AS load_date
  FROM orders JOIN ent ON o_custkey = c_custkey)"""


def measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean measure, summed in whole hundredths. Lines are summed per order and orders per customer before each join."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    per_order = lines.agg(F.sum(F.round(F.col("l_quantity") * 100).cast("bigint")).alias("hundredths"))
    orders = table(spark, sf_dir, "orders")
    per_customer = (
        orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
        .groupBy("o_custkey", F.year("o_orderdate").alias("period"))
        .agg(F.expr("sum(hundredths) div 100").alias("measure"))
    )
    return _with_entity(spark, sf_dir, per_customer, "measure")


def rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rate as exact decimal."""
    per_customer = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus <> 'P'")
        .groupBy("o_custkey", F.year("o_orderdate").alias("period"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("rate"))
    )
    return _with_entity(spark, sf_dir, per_customer, "rate")


def _with_entity(spark, sf_dir, per_customer, value):
    names = entity_codes(spark, sf_dir)
    joined = per_customer.join(names, per_customer.o_custkey == names.c_custkey)
    return joined.select("entity_code", "period", value)


def base_sql(measure_where: str = "TRUE", rate_where: str = "TRUE") -> str:
    return f"""{ENT_SQL},
measure AS (
  SELECT entity_code, CAST(year(o_orderdate) AS INTEGER) AS period,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS BIGINT) AS measure
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN ent ON o_custkey = c_custkey
  WHERE {measure_where} GROUP BY 1, 2),
rate AS (
  SELECT entity_code, CAST(year(o_orderdate) AS INTEGER) AS period,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS rate
  FROM orders JOIN ent ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' AND {rate_where} GROUP BY 1, 2),
base AS (
  SELECT coalesce(m.entity_code, r.entity_code) AS entity_code, coalesce(m.period, r.period) AS period,
         measure, rate,
         CAST(rate * measure AS DECIMAL(28,2)) * CAST(0.001 AS DECIMAL(3,3)) AS total
  FROM measure m FULL JOIN rate r ON m.entity_code = r.entity_code AND m.period = r.period)"""


BASE_SQL = base_sql()

DIM_PERIOD_SQL = """dim_period AS (
  SELECT CAST(row_number() OVER (ORDER BY period) AS BIGINT) AS period_key, period,
         CAST(CASE WHEN period % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS half,
         CAST(period % 4 + 1 AS INTEGER) AS quarter
  FROM (SELECT period FROM measure UNION SELECT period FROM rate))"""


def growth_sql(value: str, over: str) -> str:
    previous = f"lag({value}) OVER ({over})"
    return f"CAST({value} - {previous} AS DOUBLE) / nullif(CAST({previous} AS DOUBLE), 0) * 100"


def share_sql(value: str, over: str) -> str:
    return f"CAST({value} AS DOUBLE) / nullif(CAST(sum({value}) OVER ({over}) AS DOUBLE), 0) * 100"


def fact_sql(base: str) -> str:
    return f"""{base},
{DIM_ENTITY_SQL},
{DIM_PERIOD_SQL},
fact AS (
  SELECT d.entity_key, p.period_key, b.entity_code, b.period, b.measure, b.total, b.rate,
         {growth_sql("b.total", "PARTITION BY b.entity_code ORDER BY b.period")} AS growth_total,
         {growth_sql("b.measure", "PARTITION BY b.entity_code ORDER BY b.period")} AS growth_measure,
         {share_sql("b.total", "PARTITION BY d.group_code, b.period")} AS share_in_group,
         {share_sql("b.total", "PARTITION BY b.period")} AS share_in_nation,
         CAST(row_number() OVER (PARTITION BY d.group_code, b.period
              ORDER BY b.total DESC NULLS LAST, b.entity_code) AS INTEGER) AS rank_in_group,
         CAST(row_number() OVER (PARTITION BY b.period
              ORDER BY b.total DESC NULLS LAST, b.entity_code) AS INTEGER) AS rank_in_nation
  FROM base b LEFT JOIN dim_entity d ON b.entity_code = d.entity_code
       LEFT JOIN dim_period p ON b.period = p.period)"""


FACT_SQL = fact_sql(BASE_SQL)

GROUP_SQL = f"""{FACT_SQL},
rolled AS (
  SELECT group_code, group_short, group_name, f.period, count(f.entity_code) AS entities,
         CAST(sum(measure) AS BIGINT) AS measure, sum(total) AS total,
         CAST(sum(rate) AS DOUBLE) / nullif(count(rate), 0) AS mean_rate
  FROM fact f LEFT JOIN dim_entity d ON f.entity_code = d.entity_code GROUP BY 1, 2, 3, 4),
fact_group AS (
  SELECT *, {growth_sql("total", "PARTITION BY group_code ORDER BY period")} AS growth_total,
         {growth_sql("measure", "PARTITION BY group_code ORDER BY period")} AS growth_measure,
         {share_sql("total", "PARTITION BY period")} AS share_in_nation,
         CAST(row_number() OVER (PARTITION BY period
              ORDER BY total DESC NULLS LAST, group_code) AS INTEGER) AS rank_in_nation
  FROM rolled)"""

NATION_SQL = f"""{GROUP_SQL},
summed AS (
  SELECT period, count(group_code) AS groups, CAST(sum(measure) AS BIGINT) AS measure, sum(total) AS total
  FROM fact_group GROUP BY 1),
fact_nation AS (
  SELECT *, CAST(total AS DOUBLE) / nullif(CAST(measure AS DOUBLE), 0) AS rate,
         {growth_sql("total", "ORDER BY period")} AS growth_total,
         {growth_sql("measure", "ORDER BY period")} AS growth_measure
  FROM summed)"""


def star_inputs(spark: SparkSession, sf_dir: str, staging: Staging) -> dict[str, DataFrame]:
    """Clean localities and the totals of measure and rate, written."""
    both = model.totals(measure(spark, sf_dir), rate(spark, sf_dir))
    return staging.freeze_all({"localities": clean_localities(localities(spark, sf_dir)), "totals": both})


def star(spark: SparkSession, sf_dir: str, staging: Staging | None = None) -> dict[str, DataFrame]:
    """Dimensions and entity fact. What several of them read is written first, what is independent at the same time."""
    staging = staging or Staging(spark)

    def entity_dimension() -> DataFrame:
        places = staging.freeze(clean_localities(localities(spark, sf_dir)), "localities")
        return staging.freeze(model.dim_entity(places, staging), "dim_entity")

    def all_totals() -> DataFrame:
        return staging.freeze(model.totals(measure(spark, sf_dir), rate(spark, sf_dir)), "totals")

    first = at_once({"totals": all_totals, "dim_entity": entity_dimension})
    totals, entities = first["totals"], first["dim_entity"]
    built = at_once(
        {
            "dim_period": lambda: staging.freeze(model.dim_period(spark, [totals]), "dim_period"),
            "index": lambda: model.totals_index(totals, entities, staging),
        }
    )
    periods = built["dim_period"]
    fact = model.fact_from_index(totals, entities, periods, built["index"])
    return {"dim_entity": entities, "dim_period": periods, "fact_entity": fact}


def group_fact(spark: SparkSession, sf_dir: str, staging: Staging | None = None) -> DataFrame:
    """Group fact from the totals, without the ranks and keys of the entity fact."""
    both = model.totals(measure(spark, sf_dir), rate(spark, sf_dir))
    return model.fact_group(both, clean_localities(localities(spark, sf_dir)), staging or Staging(spark))


def series_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw series points as text pairs with their series code."""
    codes = F.create_map(*[F.lit(v) for n in SERIES_NAMES for v in (n, SERIES[n])])
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "dd/MM/yyyy").alias("data"),
        F.col("value").cast("decimal(18,4)").cast("string").alias("valor"),
        codes[F.col("event_type")].alias("series_code"),
        F.col("ts").alias("processed_at"),
        F.to_date("ts").alias("load_date"),
    )


def series_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed points with the day as period."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_name"),
        F.dayofmonth("ts").alias("period"),
        F.col("value").cast("decimal(18,4)").alias("value"),
    )


def series_code_sql(column: str = "event_type") -> str:
    cases = " ".join(f"WHEN '{n}' THEN {SERIES[n]}" for n in SERIES_NAMES)
    return f"CAST(CASE {column} {cases} END AS INTEGER)"


def wide_sql(period: str) -> str:
    parts = []
    for n in SERIES_NAMES:
        v = f"CASE WHEN event_type = '{n}' THEN CAST(value AS DECIMAL(18,4)) END"
        parts.append(f"CAST(sum({v}) AS DOUBLE) / nullif(count({v}), 0) AS {n}_mean")
        parts.append(f"CAST(max({v}) AS DOUBLE) AS {n}_max")
        parts.append(f"CAST(min({v}) AS DOUBLE) AS {n}_min")
    return f"SELECT {period} AS period, {', '.join(parts)} FROM events GROUP BY 1"
