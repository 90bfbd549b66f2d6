"""Scans, projections, filters, sets and dedupe."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.functions import predicates as p
from tidemark.operators.combine import orphan_sample, orphans
from tidemark.operators.dedupe import keep_latest, keep_one
from tidemark.operators.keys import spine_index
from tidemark.operators.rollup import distinct_count
from tidemark.operators.spine import distinct_values, union_periods
from tidemark.plans.clean import CleaningRules, apply_rules
from tidemark.sinks.parquet import retained
from tidemark.sources.lake import read_table
from tidemark.sources.selection import pick_periods, trailing_window
from workload.registry import query
from workload.standin import ENT_SQL, code, table


@query(
    "scan_forced_schema",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
)
def scan_forced_schema(spark, sf):
    schema = "o_orderkey bigint, o_totalprice double, o_orderstatus string"
    return read_table(spark, f"{sf}/orders.parquet", schema)


@query(
    "select_alias",
    "SELECT c_custkey AS entity_id, c_name AS entity_name, c_mktsegment AS segment FROM customer",
)
def select_alias(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entity_id"),
        F.col("c_name").alias("entity_name"),
        F.col("c_mktsegment").alias("segment"),
    )


@query(
    "typed_casts",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS user_code, CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS value,
              TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, TRY_CAST(event_type AS INTEGER) AS bad
       FROM events""",
)
def typed_casts(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").alias("user_code"),
        "value",
        F.get_json_object("props", "$.k").alias("k"),
        F.col("event_type").alias("bad"),
    )
    types = {"user_code": "string", "value": "decimal(18,4)", "k": "int", "bad": "int"}
    return c.cast_columns(events, types)


@query(
    "literal_tags",
    """SELECT event_id, CAST(11 AS INTEGER) AS series_code, 'view' AS series_name, 'events' AS source FROM events""",
)
def literal_tags(spark, sf):
    events = table(spark, sf, "events").select("event_id")
    return c.tag_literals(events, {"series_code": 11, "series_name": "view", "source": "events"})


@query(
    "audit_columns",
    """SELECT o_orderkey, TIMESTAMP '2024-05-01 12:30:00' AS processed_at, DATE '2024-05-01' AS load_date FROM orders""",
)
def audit_columns(spark, sf):
    stamped = c.audit_columns(table(spark, sf, "orders").select("o_orderkey"), dt.datetime(2024, 5, 1, 12, 30))
    # The stamp is a moment in the session's zone; as local time it equals the SQL side in any zone.
    return stamped.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


@query(
    "standard_names",
    "SELECT p_partkey, upper(trim('  ' || p_name || ' ')) AS name FROM part",
)
def standard_names(spark, sf):
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", c.standard_name(padded).alias("name"))


@query(
    "group_prefix",
    f"WITH {ENT_SQL} SELECT c_custkey, substr(entity_code, 1, 2) AS group_code FROM ent",
)
def group_prefix(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.select("c_custkey", c.code_prefix(code("c_nationkey", "c_custkey")).alias("group_code"))


@query(
    "date_fallback",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS obs_date FROM events""",
)
def date_fallback(spark, sf):
    parsed = F.when(F.col("event_type") == "view", F.to_date("ts"))
    raw = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.date_format("ts", "dd/MM/yyyy"))
    return table(spark, sf, "events").select("event_id", c.parse_date(parsed, raw).alias("obs_date"))


@query(
    "decimal_fallback",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
              ELSE CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) END AS value FROM events""",
)
def decimal_fallback(spark, sf):
    exact = F.col("value").cast("decimal(18,4)")
    parsed = F.when(F.col("event_type") == "view", exact)
    raw = F.when(F.col("event_type") == "error", F.lit("...")).otherwise(exact.cast("string"))
    return table(spark, sf, "events").select("event_id", c.parse_decimal(parsed, raw).alias("value"))


@query(
    "year_month",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
       FROM orders""",
)
def year_month(spark, sf):
    orders = c.year_month(table(spark, sf, "orders"), "o_orderdate")
    return orders.select("o_orderkey", "year", "month")


@query(
    "derived_total",
    """SELECT event_id, CAST(CAST(CAST(value AS DECIMAL(18,2)) * k AS DECIMAL(28,2)) * CAST(0.001 AS DECIMAL(3,3)) AS DOUBLE)
              AS total
       FROM (SELECT *, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
             FROM events)""",
)
def derived_total(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("measure"),
        F.col("value").cast("decimal(18,2)").alias("rate"),
    )
    return c.with_total(events, "rate", "measure", "total").select("event_id", "total")


@query(
    "ratio_after_sum",
    """SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)
              / nullif(CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS DOUBLE), 0) AS per_view
       FROM events GROUP BY 1""",
)
def ratio_after_sum(spark, sf):
    sums = (
        table(spark, sf, "events")
        .groupBy("user_id")
        .agg(
            F.sum(F.col("value").cast("decimal(18,2)")).alias("total"),
            F.count_if(F.col("event_type") == "view").alias("views"),
        )
    )
    return sums.select("user_id", c.ratio("total", "views").alias("per_view"))


@query(
    "period_attributes",
    """SELECT o_orderkey, CAST(CASE WHEN year(o_orderdate) % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS half,
              CAST(year(o_orderdate) % 4 + 1 AS INTEGER) AS quarter FROM orders""",
)
def period_attributes(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("period"))
    return orders.select(
        "o_orderkey", c.period_half("period").alias("half"), c.period_quarter("period").alias("quarter")
    )


@query(
    "drop_null_keys",
    "SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'",
)
def drop_null_keys(spark, sf):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    orders = table(spark, sf, "orders").select("o_orderkey", status.alias("status"))
    return p.drop_missing(orders, ["o_orderkey", "status"])


@query(
    "open_bounds",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_acctbal < 5000",
)
def open_bounds(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal").filter(p.within_open("c_acctbal", 0, 5000))


@query(
    "parsed_only",
    """SELECT event_id, CAST(ts AS DATE) AS obs_date, CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS value
       FROM events WHERE event_type NOT IN ('error', 'click')""",
)
def parsed_only(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.to_date("ts")).alias("obs_date"),
        F.when(F.col("event_type") != "click", F.col("value").cast("decimal(18,4)")).alias("value"),
    )
    return events.filter(p.all_present(["obs_date", "value"]))


@query(
    "year_list",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS period FROM orders
       WHERE year(o_orderdate) IN (1996, 1998, 2000)""",
)
def year_list(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("period"))
    return pick_periods(orders, "period", None, [1996, 1998, 2000])


@query(
    "single_year",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS period FROM orders WHERE year(o_orderdate) = 1997""",
)
def single_year(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("period"))
    return pick_periods(orders, "period", 1997, [])


@query(
    "trailing_window",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS obs_date FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-06-30' - 730 AND DATE '1999-06-30'""",
)
def trailing_window_(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("obs_date"))
    return trailing_window(orders, "obs_date", as_of=dt.date(1999, 6, 30), years=2)


@query(
    "distinct_values",
    "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS period FROM orders",
)
def distinct_values_(spark, sf):
    return distinct_values(table(spark, sf, "orders").select(F.year("o_orderdate").alias("period")), "period")


@query(
    "ordered_periods",
    """SELECT period, CAST(row_number() OVER (ORDER BY period) AS BIGINT) AS period_key
       FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS period FROM orders) ORDER BY period""",
)
def ordered_periods(spark, sf):
    years = distinct_values(table(spark, sf, "orders").select(F.year("o_orderdate").alias("period")), "period")
    return spine_index(years, "period", "period_key").orderBy("period")


@query(
    "period_union",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS period FROM orders
       UNION SELECT CAST(year(l_shipdate) AS INTEGER) FROM lineitem
       UNION SELECT CAST(year(ts) AS INTEGER) FROM events""",
)
def period_union(spark, sf):
    dates = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]
    return union_periods([table(spark, sf, t).select(F.year(d).alias("period")) for t, d in dates], "period")


@query(
    "dedupe_latest",
    """SELECT * EXCLUDE (rn) FROM (
         SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate,
                row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def dedupe_latest(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    lines = table(spark, sf, "lineitem").select(*columns)
    return keep_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "dedupe_any",
    """SELECT * EXCLUDE (rn) FROM (
         SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS rn
         FROM lineitem) WHERE rn = 1""",
)
def dedupe_any(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return keep_one(lines, ["l_orderkey", "l_linenumber"])


@query(
    "distinct_keys",
    """SELECT CAST(count(*) AS BIGINT) AS distinct_keys FROM (
         SELECT DISTINCT o_custkey, nullif(o_orderstatus, 'P') AS status FROM orders)""",
)
def distinct_keys(spark, sf):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    orders = table(spark, sf, "orders").select("o_custkey", status.alias("status"))
    return distinct_count(orders, ["o_custkey", "status"])


@query(
    "row_counts",
    "SELECT 'orders' AS dataset, count(*) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem",
)
def row_counts(spark, sf):
    counts = [
        table(spark, sf, t).agg(F.lit(t).alias("dataset"), F.count(F.lit(1)).alias("rows"))
        for t in ("orders", "lineitem")
    ]
    return counts[0].unionByName(counts[1])


@query(
    "orphan_keys",
    """SELECT DISTINCT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def orphan_keys(spark, sf):
    return orphans(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", "doc_id")


@query(
    "orphan_sample",
    """SELECT DISTINCT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
       ORDER BY doc_id LIMIT 10""",
)
def orphan_sample_(spark, sf):
    return orphan_sample(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", "doc_id")


@query(
    "retention",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS load_date FROM orders
       WHERE CAST(o_orderdate AS DATE) >= DATE '1999-12-31' - 365""",
)
def retention(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("load_date"))
    return retained(orders, "silver", dt.date(1999, 12, 31))


@query(
    "rename_rules",
    """SELECT o_orderkey AS order_id, upper(trim(' ' || lower(o_orderpriority) || ' ')) AS priority,
              o_totalprice AS value, o_orderstatus AS status
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def rename_rules(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" ")).alias("Prioridade"),
        F.col("o_totalprice").cast("string").alias("Valor"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
    )
    rules = CleaningRules(
        renames={"o_orderkey": "order_id", "Prioridade": "priority", "Valor": "value"},
        types={"value": "double"},
        not_null=["status"],
        trim=True,
        standard_names=["priority"],
    )
    return apply_rules(orders, rules)
