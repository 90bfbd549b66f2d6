"""Quality checks and suites."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.plans import model
from tidemark.plans.clean import clean_localities, clean_measure, clean_rate, clean_series
from tidemark.quality import checks
from tidemark.quality.rules import (
    BRONZE_RULES,
    DECLARED_RANGES,
    DECLARED_RULES,
    ERROR_RATE,
    GOLD_REFERENCES,
    GOLD_RULES,
    SILVER_RULES,
    DatasetRules,
    ReferenceRule,
    rule_table,
    rules_from,
)
from tidemark.quality.suites import layer_checks, summarize
from tidemark.staging import Staging
from workload.registry import query
from workload.standin import (
    ENT_SQL,
    FACT_SQL,
    LOCALITIES_SQL,
    NATION_SQL,
    localities,
    order_values,
    order_values_sql,
    star,
    table,
)


def orders_with_nulls(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), "o_totalprice"
    )


NULLS_SQL = "o AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, o_totalprice FROM orders)"
NULLS_COLUMNS = ["o_orderkey", "o_custkey", "status", "o_totalprice"]


@query(
    "check_schema",
    f"""WITH {NULLS_SQL} SELECT * FROM (
        SELECT 'o_orderkey' AS column_name, TRUE AS present, count(o_orderkey) AS filled FROM o
        UNION ALL SELECT 'status', TRUE, count(status) FROM o UNION ALL SELECT 'o_region', FALSE, NULL)""",
)
def check_schema(spark, sf):
    return checks.schema_report(orders_with_nulls(spark, sf), ["o_orderkey", "status", "o_region"])


@query(
    "missing_columns",
    """SELECT 'o_region' AS column_name, count(*) AS rows FROM orders
       UNION ALL SELECT 'o_zone', count(*) FROM orders""",
)
def missing_columns(spark, sf):
    orders = table(spark, sf, "orders")
    missing = checks.missing_columns(orders, ["o_orderkey", "o_region", "o_zone"])
    names = F.explode(F.array(*[F.lit(c) for c in missing])).alias("column_name")
    return orders.agg(F.count(F.lit(1)).alias("rows")).select(names, "rows")


@query(
    "check_nulls",
    f"""WITH {NULLS_SQL}, n AS (
          SELECT 'status' AS column_name, count(*) AS total_rows, count(*) - count(status) AS null_count FROM o
          UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey) FROM o)
        SELECT *, floor(CAST(null_count AS DOUBLE) / total_rows * 100 * 100 + 0.5) / 100 AS null_percentage,
               CAST(null_count AS DOUBLE) / total_rows <= 0.1 AS passed FROM n""",
)
def check_nulls(spark, sf):
    return checks.null_report(orders_with_nulls(spark, sf), ["status", "o_custkey", "o_region"], threshold=0.1)


@query(
    "check_duplicates",
    """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
            t AS (SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS unique_rows FROM k)
       SELECT *, total_rows - unique_rows AS duplicate_count, total_rows = unique_rows AS passed FROM t""",
)
def check_duplicates(spark, sf):
    return checks.duplicate_report(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_range",
    """SELECT 'c_acctbal' AS column_name, min(c_acctbal) AS min, max(c_acctbal) AS max,
              CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS avg, count(c_acctbal) AS count,
              CAST(0 AS DOUBLE) AS expected_min, CAST(20000 AS DOUBLE) AS expected_max,
              CASE WHEN min(c_acctbal) < 0 THEN 'minimum below bound' WHEN max(c_acctbal) > 20000
                   THEN 'maximum above bound' END AS failure,
              min(c_acctbal) >= 0 AND max(c_acctbal) <= 20000 AS passed
       FROM customer""",
)
def check_range(spark, sf):
    exact = F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal")
    return checks.range_report(table(spark, sf, "customer").select(exact), "c_acctbal", 0, 20000)


def _completeness_sql(columns: list[str], threshold: float) -> str:
    filled = " + ".join(f"count({c})" for c in columns)
    per_column = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS filled FROM o" for c in columns)
    return f"""t AS (SELECT count(*) AS total_rows, count(*) * {len(columns)} AS total_cells, {filled} AS total_filled FROM o),
        f AS ({per_column})
        SELECT column_name, filled, floor(CAST(filled AS DOUBLE) / total_rows * 100 * 100 + 0.5) / 100 AS column_completeness,
               total_rows, total_cells, total_filled,
               floor(CAST(total_filled AS DOUBLE) / total_cells * 100 * 100 + 0.5) / 100 AS overall_completeness,
               CAST(total_filled AS DOUBLE) / total_cells >= {threshold} AS passed
        FROM f JOIN t ON TRUE"""


@query("check_completeness", f"WITH {NULLS_SQL}, {_completeness_sql(NULLS_COLUMNS, 0.95)}")
def check_completeness(spark, sf):
    return checks.completeness_report(orders_with_nulls(spark, sf), 0.95)


@query(
    "check_integrity",
    """WITH k AS (SELECT DISTINCT doc_id FROM documents),
            t AS (SELECT count(*) AS total_child_keys,
                         count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS orphan_count FROM k),
            s AS (SELECT string_agg(doc_id, ',' ORDER BY doc_id) AS sample
                  FROM (SELECT doc_id FROM k WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 10))
       SELECT t.*, orphan_count = 0 AS passed, sample FROM t, s""",
)
def check_integrity(spark, sf):
    return checks.integrity_report(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", "doc_id")


@query(
    "null_probes",
    f"""WITH {NULLS_SQL} SELECT count(*) - count(status) AS null_status, count(status) AS filled_status FROM o""",
)
def null_probes(spark, sf):
    status = F.col("status")
    return orders_with_nulls(spark, sf).agg(
        F.count_if(status.isNull()).alias("null_status"), F.count_if(status.isNotNull()).alias("filled_status")
    )


@query(
    "profile",
    f"WITH {NULLS_SQL} "
    + " UNION ALL ".join(
        f"SELECT count(*) AS row_count, CAST(4 AS INTEGER) AS column_count, '{c}' AS column_name, count(*) - count({c}) AS null_count FROM o"
        for c in NULLS_COLUMNS
    ),
)
def profile(spark, sf):
    return checks.profile(orders_with_nulls(spark, sf))


@query(
    "error_rate",
    f"""WITH {NULLS_SQL}, t AS (
          SELECT count(*) AS rows, count(*) FILTER (WHERE status IS NULL OR o_totalprice < 1000 OR o_totalprice > 400000)
                 AS failing_rows FROM o)
        SELECT *, CAST(failing_rows AS DOUBLE) / rows AS error_rate,
               CAST(failing_rows AS DOUBLE) / rows <= {ERROR_RATE} AS passed FROM t""",
)
def error_rate(spark, sf):
    ranges = {"o_totalprice": (1000, 400_000)}
    return checks.error_rate(orders_with_nulls(spark, sf), ["o_orderkey", "status"], ranges, ERROR_RATE)


@query(
    "declared_error_rate",
    f"""WITH {FACT_SQL}, t AS (
          SELECT count(*) AS rows, count(*) FILTER (WHERE entity_code IS NULL OR period IS NULL OR total IS NULL
                   OR measure IS NULL OR measure NOT BETWEEN 0 AND 20000000
                   OR total NOT BETWEEN 0 AND 1000000000000 OR period NOT BETWEEN 2000 AND 2030) AS failing_rows
          FROM fact)
        SELECT *, CAST(failing_rows AS DOUBLE) / rows AS error_rate,
               CAST(failing_rows AS DOUBLE) / rows <= {ERROR_RATE} AS passed FROM t""",
)
def declared_error_rate(spark, sf):
    """Critical columns, ranges and limit come from the rule table."""
    rules = rules_from(rule_table(spark, [DECLARED_RULES]))[0]
    return checks.error_rate(star(spark, sf)["fact_entity"], rules.critical, rules.ranges, rules.error_rate)


@query(
    "group_agreement",
    f"""WITH {ENT_SQL}, {LOCALITIES_SQL}, {order_values_sql(3)},
             k AS (SELECT DISTINCT entity_code, CASE WHEN source_group = '07' THEN '99' ELSE source_group END AS prefix
                   FROM (SELECT entity_code, substr(entity_code, 1, 2) AS source_group FROM raw)),
             t AS (SELECT count(*) AS entities, count(*) FILTER (WHERE prefix <> group_code) AS disagreeing
                   FROM k JOIN localities USING (entity_code))
        SELECT *, disagreeing = 0 AS passed FROM t""",
)
def group_agreement(spark, sf):
    """One group is named differently by the values."""
    prefix = F.substring("entity_code", 1, 2)
    named = F.when(prefix == "07", F.lit("99")).otherwise(prefix)
    values = order_values(spark, sf, 3).select("entity_code", named.alias("group_code"))
    return checks.group_agreement(values, clean_localities(localities(spark, sf)))


# Suites. The SQL of each check is written out per dataset.


def dataset_sql(rule: DatasetRules, relation: str, columns: list[str]) -> str:
    """Result rows of one dataset."""
    head = f"SELECT '{rule.layer}' AS layer, '{rule.dataset}' AS dataset,"
    missing = len([c for c in rule.required if c not in columns])
    critical = [c for c in rule.critical if c in columns]
    nulls = [f"(count(*) - count({c}))" for c in critical]
    shares = ", ".join(f"coalesce(CAST({n} AS DOUBLE) / nullif(count(*), 0), 0)" for n in nulls)
    worst = f"greatest(0.0, {shares})" if shares else "0.0"
    filled = " + ".join(f"count({c})" for c in columns)
    cells = f"(count(*) * {len(columns)})"
    complete = f"coalesce(CAST({filled} AS DOUBLE) / nullif({cells}, 0), 0)"
    parts = [
        f"""{head} 'schema' AS check, {missing == 0} AS passed, CAST({len(rule.required)} AS BIGINT) AS checked,
            CAST({missing} AS BIGINT) AS failed, CAST({missing / len(rule.required)} AS DOUBLE) AS metric,
            CAST(NULL AS VARCHAR) AS sample""",
        f"""{head} 'nulls', {worst} <= {rule.null_threshold}, count(*) * {len(critical)}, {" + ".join(nulls) or 0},
            CAST({worst} AS DOUBLE), NULL FROM {relation}""",
        f"""{head} 'completeness', {complete} >= {rule.completeness}, {cells}, {cells} - ({filled}),
            {complete}, NULL FROM {relation}""",
        f"""{head} 'duplicates', CAST(sum(n) AS BIGINT) = count(*), CAST(sum(n) AS BIGINT),
            CAST(sum(n) - count(*) AS BIGINT), CAST(sum(n) - count(*) AS DOUBLE) / CAST(sum(n) AS DOUBLE), NULL
            FROM (SELECT {", ".join(rule.keys)}, count(*) AS n FROM {relation} GROUP BY ALL)""",
    ]
    for column, (low, high) in rule.ranges.items():
        outside = f"count(*) FILTER (WHERE {column} < {low} OR {column} > {high})"
        parts.append(
            f"""{head} 'range_{column}', count({column}) > 0 AND {outside} = 0, count({column}), {outside},
                CAST({outside} AS DOUBLE) / nullif(count({column}), 0), NULL FROM {relation}"""
        )
    if rule.error_rate is not None:
        broken = [f"{c} IS NULL" for c in rule.critical]
        broken += [f"{c} IS NULL OR {c} NOT BETWEEN {low} AND {high}" for c, (low, high) in rule.ranges.items()]
        failing = f"count(*) FILTER (WHERE {' OR '.join(broken)})"
        share = f"CAST({failing} AS DOUBLE) / count(*)"
        parts.append(f"{head} 'error_rate', {share} <= {rule.error_rate}, count(*), {failing}, {share}, NULL FROM {relation}")
    return " UNION ALL ".join(parts)


def integrity_sql(rule: ReferenceRule) -> str:
    missing = f"k IS NULL OR k NOT IN (SELECT {rule.parent_key} FROM {rule.parent})"
    orphan = f"count(*) FILTER (WHERE {missing})"
    return f"""SELECT '{rule.layer}', '{rule.child}', 'integrity_{rule.child_key}', {orphan} = 0, count(*), {orphan},
        CAST({orphan} AS DOUBLE) / nullif(count(*), 0),
        array_to_string(list(coalesce(CAST(k AS VARCHAR), 'null') ORDER BY k NULLS FIRST) FILTER (WHERE {missing})[1:10], ',')
        FROM (SELECT DISTINCT {rule.child_key} AS k FROM {rule.child})"""


VALUE_COLUMNS = ["entity_code", "entity_name", "period", "value", "source", "processed_at", "load_date"]
LOCALITY_COLUMNS = [
    "entity_code",
    "entity_name",
    "group_code",
    "group_short",
    "group_name",
    "region_code",
    "region_name",
    "region_short",
    "processed_at",
    "load_date",
]
STAMPED_LOCALITIES = f"""{LOCALITIES_SQL}, stamped AS (
  SELECT *, TIMESTAMP '2024-05-01' AS processed_at, DATE '2024-05-01' AS load_date FROM localities)"""


def bronze_tables(spark, sf):
    values = Staging(spark).freeze(order_values(spark, sf, 3), "values")
    gaps = values.withColumn("value", F.when(F.col("value") < 500_000, F.col("value")))
    return {"measure": values, "rate": gaps, "localities": localities(spark, sf)}


BRONZE_SQL = f"""WITH {ENT_SQL}, {order_values_sql(3)}, {STAMPED_LOCALITIES},
gaps AS (SELECT * REPLACE (CASE WHEN value < 500000 THEN value END AS value) FROM raw), results AS (
{dataset_sql(BRONZE_RULES[0], "raw", VALUE_COLUMNS)} UNION ALL
{dataset_sql(BRONZE_RULES[1], "gaps", VALUE_COLUMNS)} UNION ALL
{dataset_sql(BRONZE_RULES[2], "stamped", LOCALITY_COLUMNS)})"""


@query("suite_bronze", f"{BRONZE_SQL} SELECT * FROM results")
def suite_bronze(spark, sf):
    return layer_checks(spark, bronze_tables(spark, sf), BRONZE_RULES)


def _clean_sql(name: str, value: str, source: str, low: int, high: int) -> str:
    return f"""{name} AS (SELECT * EXCLUDE (rn) FROM (
  SELECT entity_code, upper(trim(entity_name)) AS entity_name, substr(entity_code, 1, 2) AS group_code, period,
         {value} AS {name}, processed_at, load_date,
         row_number() OVER (PARTITION BY entity_code, period ORDER BY processed_at DESC, {value}) AS rn
  FROM {source} WHERE {value} > {low} AND {value} < {high}) WHERE rn = 1)"""


SERIES_CLEAN_SQL = """series AS (SELECT * EXCLUDE (rn) FROM (
  SELECT event_type AS series_code, event_type AS series_name, CAST(ts AS DATE) AS obs_date, value,
         row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, value) AS rn
  FROM events) WHERE rn = 1)"""
CLEAN_COLUMNS = ["entity_code", "entity_name", "group_code", "period", "{}", "processed_at", "load_date"]
SILVER_SQL = f"""WITH {ENT_SQL}, {order_values_sql(3)}, {STAMPED_LOCALITIES},
{_clean_sql("measure", "trunc(value)::BIGINT", "raw", 0, 20_000_000)},
{_clean_sql("rate", "value", "raw", 0, 1_000_000)}, {SERIES_CLEAN_SQL}, results AS (
{dataset_sql(SILVER_RULES[0], "measure", [c.format("measure") for c in CLEAN_COLUMNS])} UNION ALL
{dataset_sql(SILVER_RULES[1], "rate", [c.format("rate") for c in CLEAN_COLUMNS])} UNION ALL
{dataset_sql(SILVER_RULES[2], "stamped", LOCALITY_COLUMNS)} UNION ALL
{dataset_sql(SILVER_RULES[3], "series", ["series_code", "series_name", "obs_date", "value"])})"""


@query("suite_silver", f"{SILVER_SQL} SELECT * FROM results")
def suite_silver(spark, sf):
    """Clean tables are written first: a suite reads each of them twice."""
    staging = Staging(spark)
    values = order_values(spark, sf, 3)
    points = table(spark, sf, "events").select(
        F.col("event_type").alias("series_code"),
        F.col("event_type").alias("series_name"),
        F.lit(None).cast("string").alias("date_text"),
        F.to_date("ts").alias("obs_date"),
        F.lit(None).cast("string").alias("value_text"),
        F.col("value").cast("decimal(18,4)").alias("value"),
        F.lit("events").alias("source"),
        F.col("ts").alias("processed_at"),
        F.to_date("ts").alias("load_date"),
    )
    clean = {
        "measure": clean_measure(values),
        "rate": clean_rate(values, "double"),
        "localities": clean_localities(localities(spark, sf)),
        "series": clean_series(points).select("series_code", "series_name", "obs_date", "value"),
    }
    return layer_checks(spark, staging.freeze_all(clean), SILVER_RULES)


GOLD_COLUMNS = {
    "dim_entity": ["entity_key", *model.DIM_ENTITY],
    "dim_period": ["period_key", "period", "half", "quarter"],
    "fact_entity": model.FACT_ENTITY,
    "fact_group": [
        "group_code",
        "group_short",
        "group_name",
        "period",
        "entities",
        "measure",
        "total",
        "mean_rate",
        "growth_total",
        "growth_measure",
        "share_in_nation",
        "rank_in_nation",
    ],
    "fact_nation": ["period", "groups", "measure", "total", "rate", "growth_total", "growth_measure"],
}
GOLD_SQL = f"""WITH {NATION_SQL}, fact_entity AS (SELECT * FROM fact), results AS (
{" UNION ALL ".join(dataset_sql(r, r.dataset, GOLD_COLUMNS[r.dataset]) for r in GOLD_RULES)} UNION ALL
{" UNION ALL ".join(integrity_sql(r) for r in GOLD_REFERENCES)})"""


@query("suite_gold", f"{GOLD_SQL} SELECT * FROM results")
def suite_gold(spark, sf):
    staging = Staging(spark)
    tables = star(spark, sf, staging)
    tables["fact_entity"] = staging.freeze(tables["fact_entity"], "fact_entity")
    groups = model.fact_group(tables["fact_entity"], tables["dim_entity"], Staging(spark))
    tables["fact_group"] = staging.freeze(groups, "fact_group")
    tables["fact_nation"] = model.fact_nation(tables["fact_group"])
    return layer_checks(spark, tables, GOLD_RULES, GOLD_REFERENCES)


@query(
    "quality_summary",
    f"""{BRONZE_SQL} SELECT layer, count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks,
        count(*) FILTER (WHERE NOT passed) AS failed_checks,
        floor(CAST(count(*) FILTER (WHERE passed) AS DOUBLE) / count(*) * 100 * 100 + 0.5) / 100 AS pass_rate
        FROM results GROUP BY 1""",
)
def quality_summary(spark, sf):
    return summarize(layer_checks(spark, bronze_tables(spark, sf), BRONZE_RULES))


# Rules as a table


CHANGED_RULES = replace(
    DECLARED_RULES,
    critical=["entity_code", "total"],
    ranges={c: bounds for c, bounds in DECLARED_RANGES.items() if c != "period"},
    null_threshold=0.5,
    completeness=0.5,
)


@query(
    "suite_from_rules",
    f"""WITH {FACT_SQL}, results AS ({dataset_sql(CHANGED_RULES, "fact", model.FACT_ENTITY)})
        SELECT * FROM results WHERE "check" <> 'duplicates'""",
)
def suite_from_rules(spark, sf):
    """The declared rules as a table, read back after a user changed it.

    Duplicates are off, the period has no range and is no longer critical, and two limits are others.
    """
    rules = rule_table(spark, [DECLARED_RULES])
    off = (F.col("check") == "duplicates") | (F.col("check").isin("nulls", "range") & (F.col("column") == "period"))
    limit = F.when(F.col("check").isin("nulls", "completeness"), 0.5).otherwise(F.col("limit"))
    changed = rules.withColumns({"enabled": F.col("enabled") & ~off, "limit": limit})
    fact = Staging(spark).freeze(star(spark, sf)["fact_entity"], "fact_entity")
    return layer_checks(spark, {"fact_entity": fact}, rules_from(changed))
