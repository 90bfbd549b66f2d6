"""Landing, sinks and layer runs."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import audit_columns
from tidemark.functions.names import with_surveyed_names
from tidemark.plans import model
from tidemark.plans.clean import clean_localities
from tidemark.plans.lakehouse import bronze_jobs, gold_jobs, run_all, silver_jobs
from tidemark.plans.run import Job, Lake, Layer, report_frame, run_layer, run_layers
from tidemark.quality.checks import require_columns
from tidemark.quality.rules import BRONZE_RULES, GOLD_REFERENCES, GOLD_RULES, SILVER_RULES, DatasetRules
from tidemark.quality.suites import summarize
from tidemark.sinks.contract import CONTRACTS, contract_violations, require_contract, to_contract
from tidemark.sinks.parquet import write_table
from tidemark.sources.aggregates import parse_aggregates, read_aggregate_lines, read_aggregate_pieces, rejected_values
from tidemark.sources.localities import parse_localities, read_locality_lines
from tidemark.sources.selection import pick_periods
from tidemark.sources.series import land_series, series_catalogue
from tidemark.staging import Staging
from workload.checks import GOLD_COLUMNS, dataset_sql, integrity_sql
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
    entity_codes,
    fact_sql,
    group_fact,
    localities,
    measure,
    rate,
    series_code_sql,
    series_raw,
    star,
    star_inputs,
    table,
    wide_sql,
)

STAMP = dt.datetime(2024, 5, 1)


def aggregates_json(spark, sf):
    """One response per order. Its value is plain text, an object, the missing marker, empty or null."""
    orders = table(spark, sf, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    value = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("null"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit('""'))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit('"n/a"'))
        .when(F.col("o_orderstatus") == "P", F.lit('"..."'))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit('{"valor": "'), price, F.lit('"}')))
        .otherwise(F.concat(F.lit('"'), price, F.lit('"')))
    )
    place = F.concat(
        F.lit('{"id":"'), F.col("entity_code"), F.lit('","nome":"'), F.col("c_name"), F.lit('","nivel":{"id":"N6"}}')
    )
    year = F.year("o_orderdate").cast("string")
    text = F.concat(
        F.lit('[{"id":"9324","resultados":[{"classificacoes":[],"series":[{"localidade":'),
        place,
        F.lit(',"serie":{"'),
        year,
        F.lit('":'),
        value,
        F.lit(',"media":"7"}}]}]}]'),
    )
    coded = orders.join(entity_codes(spark, sf), orders.o_custkey == F.col("c_custkey"))
    return coded.select(text.alias("payload"))


AGGREGATES_SQL = f"""{ENT_SQL},
points AS (
  SELECT entity_code, c_name AS entity_name, CAST(year(o_orderdate) AS INTEGER) AS period,
         CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW', '2-HIGH') OR o_orderstatus = 'P' THEN NULL
              ELSE o_totalprice END AS value,
         o_orderpriority = '2-HIGH' AS rejected
  FROM orders JOIN ent ON o_custkey = c_custkey
  UNION ALL SELECT entity_code, c_name, NULL, 7.0, FALSE FROM orders JOIN ent ON o_custkey = c_custkey)"""


@query(
    "land_aggregates",
    f"""WITH {AGGREGATES_SQL} SELECT entity_code, entity_name, period, CAST(value AS DOUBLE) AS value,
        '9324' AS variable, 'population' AS source, 'N6' AS level FROM points""",
)
def land_aggregates(spark, sf):
    return parse_aggregates(aggregates_json(spark, sf), "payload", "population")


@query(
    "land_aggregates_files",
    f"""WITH {AGGREGATES_SQL} SELECT entity_code, entity_name, period, CAST(value AS DOUBLE) AS value,
        '9324' AS variable, 'population' AS source, 'N6' AS level FROM points""",
)
def land_aggregates_files(spark, sf):
    """The same through landed files with one response a line."""
    folder = Staging(spark).folder("aggregates")
    aggregates_json(spark, sf).write.text(folder)
    return read_aggregate_lines(spark, folder, "population")


@query(
    "land_aggregates_pieces",
    f"""WITH {AGGREGATES_SQL} SELECT entity_code, entity_name, period, CAST(value AS DOUBLE) AS value,
        '9324' AS variable, 'population' AS source, 'N6' AS level FROM points""",
)
def land_aggregates_pieces(spark, sf):
    """The same through files of whole responses, cut at a key; several responses follow each other in a file."""
    folder = Staging(spark).folder("aggregates")
    aggregates_json(spark, sf).write.text(folder)
    return read_aggregate_pieces(spark, folder, "population")


@query(
    "land_rejects",
    f"""WITH {AGGREGATES_SQL}, broken AS (SELECT count(*) AS n FROM part)
        SELECT count(*) AS values, count(*) FILTER (WHERE rejected) AS rejected,
               (SELECT count(*) FROM orders JOIN ent ON o_custkey = c_custkey) + any_value(n) AS responses,
               any_value(n) AS broken_responses FROM points, broken""",
)
def land_rejects(spark, sf):
    """Part names stand among the responses as broken ones."""
    broken = table(spark, sf, "part").select(F.col("p_name").alias("payload"))
    return rejected_values(aggregates_json(spark, sf).unionByName(broken), "payload")


@query(
    "land_measure_year",
    f"""WITH {AGGREGATES_SQL} SELECT entity_code, entity_name, period, CAST(value AS DOUBLE) AS value,
        '9324' AS variable, 'population' AS source, 'N6' AS level, DATE '2024-05-01' AS load_date
        FROM points WHERE period = 1997""",
)
def land_measure_year(spark, sf):
    landed = parse_aggregates(aggregates_json(spark, sf), "payload", "population")
    return audit_columns(pick_periods(landed, "period", 1997, []), STAMP).drop("processed_at")


LAND_LOCALITIES_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS entity_code, c_name AS entity_name,
              CASE WHEN known THEN CAST(n_nationkey AS VARCHAR) END AS group_code,
              CASE WHEN known THEN substr(n_name, 1, 2) END AS group_short,
              CASE WHEN known THEN n_name END AS group_name,
              CASE WHEN known THEN CAST(r_regionkey AS VARCHAR) END AS region_code,
              CASE WHEN known THEN r_name END AS region_name,
              CASE WHEN known THEN substr(r_name, 1, 2) END AS region_short
       FROM (SELECT *, c_mktsegment <> 'HOUSEHOLD' AS known FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey)"""


def localities_json(spark, sf):
    """One locality per customer as JSON; households have no levels above."""
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    top = F.struct(
        F.col("r_regionkey").alias("id"), F.substring("r_name", 1, 2).alias("sigla"), F.col("r_name").alias("nome")
    )
    group = F.struct(
        F.col("n_nationkey").alias("id"),
        F.substring("n_name", 1, 2).alias("sigla"),
        F.col("n_name").alias("nome"),
        top.alias("regiao"),
    )
    small = F.struct(F.struct(group.alias("UF")).alias("mesorregiao"))
    payload = F.to_json(
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("nome"),
            F.when(F.col("c_mktsegment") != "HOUSEHOLD", small).alias("microrregiao"),
        )
    )
    return joined.select(payload.alias("payload"))


@query("land_localities", LAND_LOCALITIES_SQL)
def land_localities(spark, sf):
    return parse_localities(localities_json(spark, sf), "payload")


@query("land_localities_files", LAND_LOCALITIES_SQL)
def land_localities_files(spark, sf):
    """The same through landed files with one locality a line."""
    folder = Staging(spark).folder("localities")
    localities_json(spark, sf).write.text(folder)
    return read_locality_lines(spark, folder)


# Sinks


def priced_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("value"),
        F.year("o_orderdate").alias("period"),
        F.lit("orders").alias("source"),
    )


@query(
    "write_partitioned",
    """SELECT o_orderkey, o_totalprice AS value, CAST(year(o_orderdate) AS INTEGER) AS period, 'orders' AS source
       FROM orders""",
)
def write_partitioned(spark, sf):
    path = Staging(spark).folder("orders")
    write_table(priced_orders(spark, sf), path, partition_by=["period", "source"])
    return spark.read.parquet(path)


@query(
    "partition_overwrite",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice * 2 ELSE o_totalprice END AS value,
              CAST(year(o_orderdate) AS INTEGER) AS period, 'orders' AS source FROM orders""",
)
def partition_overwrite(spark, sf):
    path = Staging(spark).folder("orders")
    orders = priced_orders(spark, sf)
    write_table(orders, path, partition_by=["period", "source"])
    redone = orders.filter("period = 1998").withColumn("value", F.col("value") * 2)
    write_table(redone, path, partition_by=["period", "source"])
    return spark.read.parquet(path)


def _half_up(column: str, type_: str) -> str:
    """A double rounded half up by its decimal digits; DuckDB's direct cast may round a tie down."""
    return f"CAST(CAST(CAST({column} AS VARCHAR) AS {type_}) AS DOUBLE)"


def _cast_sql(columns: dict[str, str]) -> str:
    """Columns cast to their contract types as the SQL side writes them."""
    parts = []
    for name, type_ in columns.items():
        if type_.startswith("decimal"):
            parts.append(f"{_half_up(name, type_)} AS {name}")
        elif type_.startswith("varchar"):
            parts.append(name)
        else:
            parts.append(f"CAST({name} AS {type_}) AS {name}")
    return ", ".join(parts)


CODE_LENGTH = {"entity_code": 14}
ENTITY_CONTRACT = CONTRACTS["dim_entity"].with_lengths(**CODE_LENGTH)
FACT_CONTRACT = CONTRACTS["fact_entity"].with_lengths(**CODE_LENGTH)
# An entity may grow from next to nothing, so its percentages have no bound that the surveyed decimal(10,4) would hold.
WIDE_FACT_CONTRACT = FACT_CONTRACT.with_types(growth_total="decimal(38,4)", growth_measure="decimal(38,4)")
NATION_OWN = {n: t for n, t in CONTRACTS["fact_nation"].types.items() if not n.endswith("_mean")}
NATION_ABSENT = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in CONTRACTS["fact_nation"].types if n.endswith("_mean"))


def checked(df, contract):
    """As the export does it: rows that do not fit would fail the table."""
    require_contract(df, contract)
    return to_contract(df, contract)


@query("contract_cast", f"WITH {GROUP_SQL} SELECT {_cast_sql(CONTRACTS['fact_group'].types)} FROM fact_group")
def contract_cast(spark, sf):
    staging = Staging(spark)
    return checked(staging.freeze(group_fact(spark, sf, staging), "fact_group"), CONTRACTS["fact_group"])


@query("contract_dim_entity", f"WITH {DIM_ENTITY_SQL} SELECT {_cast_sql(ENTITY_CONTRACT.types)} FROM dim_entity")
def contract_dim_entity(spark, sf):
    return checked(model.dim_entity(clean_localities(localities(spark, sf)), Staging(spark)), ENTITY_CONTRACT)


@query("contract_dim_period", f"WITH {BASE_SQL}, {DIM_PERIOD_SQL} SELECT {_cast_sql(CONTRACTS['dim_period'].types)} FROM dim_period")
def contract_dim_period(spark, sf):
    inputs = star_inputs(spark, sf, Staging(spark))
    return checked(model.dim_period(spark, [inputs["totals"]]), CONTRACTS["dim_period"])


@query("contract_fact_entity", f"WITH {FACT_SQL} SELECT {_cast_sql(FACT_CONTRACT.types)} FROM fact")
def contract_fact_entity(spark, sf):
    """The entity fact as a table with columns for growth of any size."""
    staging = Staging(spark)
    return checked(staging.freeze(star(spark, sf, staging)["fact_entity"], "fact_entity"), WIDE_FACT_CONTRACT)


@query("contract_nation", f"WITH {NATION_SQL} SELECT {_cast_sql(NATION_OWN)}, {NATION_ABSENT} FROM fact_nation")
def contract_nation(spark, sf):
    staging = Staging(spark)
    return checked(staging.freeze(model.fact_nation(group_fact(spark, sf, staging)), "fact_nation"), CONTRACTS["fact_nation"])


@query(
    "contract_nation_enriched",
    f"""WITH {NATION_SQL}, wide AS ({wide_sql("CAST(year(ts) AS INTEGER) - 26")}), own AS (
        SELECT {_cast_sql(NATION_OWN)}, {NATION_ABSENT} FROM fact_nation)
        SELECT own.*, wide.* EXCLUDE (period) FROM own LEFT JOIN wide ON own.period = wide.period""",
)
def contract_nation_enriched(spark, sf):
    """Series columns beyond the contract pass through."""
    staging = Staging(spark)
    points = table(spark, sf, "events").select(
        F.col("event_type").alias("series_name"), (F.year("ts") - 26).alias("year"), F.col("value").cast("decimal(18,4)").alias("value")
    )
    nation = model.nation_enriched(model.fact_nation(group_fact(spark, sf, staging)), points, SERIES_NAMES)
    return checked(staging.freeze(nation, "fact_nation"), CONTRACTS["fact_nation"])


@query(
    "contract_violations",
    f"""WITH {DIM_ENTITY_SQL}, n AS (SELECT count(*) FILTER (WHERE length(group_name) > 7) AS n FROM dim_entity)
        SELECT column_name, CASE WHEN column_name = 'group_name' THEN n ELSE 0 END AS violations
        FROM n JOIN (SELECT unnest(['entity_key', 'entity_code', 'entity_name', 'group_code', 'group_short',
          'group_name', 'region_code', 'region_name', 'region_short']) AS column_name) ON TRUE""",
)
def contract_violations_(spark, sf):
    """Some group names are longer than a narrower contract allows, others fit."""
    entities = model.dim_entity(clean_localities(localities(spark, sf)), Staging(spark))
    return contract_violations(entities, ENTITY_CONTRACT.with_lengths(group_name=7))


@query(
    "surveyed_names",
    f"""WITH {DIM_ENTITY_SQL} SELECT entity_key AS sk_municipio, entity_code AS codigo_municipio,
        entity_name AS nome_municipio, group_code AS codigo_uf, group_short AS sigla_uf, group_name AS nome_uf,
        region_code AS codigo_regiao, region_name AS nome_regiao, region_short AS sigla_regiao FROM dim_entity""",
)
def surveyed_names(spark, sf):
    entities = model.dim_entity(clean_localities(localities(spark, sf)), Staging(spark))
    return with_surveyed_names(entities, "gold")


# Layer runs


def run_sources(spark, sf):
    names = entity_codes(spark, sf).select("entity_code", F.col("c_name").alias("entity_name"))

    def values(build, value, source):
        def load(lake):
            df = build(spark, sf).withColumnRenamed(value, "value").join(names, "entity_code")
            return df.withColumn("source", F.lit(source))

        return load

    def series(lake):
        points = series_raw(spark, sf).drop("processed_at", "load_date")
        return land_series(points, series_catalogue(spark, SERIES), "events")

    def places(lake):
        return localities(spark, sf).drop("processed_at", "load_date")

    return {
        "localities": places,
        "measure": values(measure, "measure", "lineitem"),
        "rate": values(rate, "rate", "orders"),
        "series": series,
    }


RUN_SQL = f"""{BASE_SQL}, {LOCALITIES_SQL},
points AS (SELECT count(*) AS n FROM events),
dates AS (SELECT count(*) AS n FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) FROM events)),
clean AS (
  SELECT entity_code, period FROM measure WHERE measure > 0 AND measure < 20000000
  UNION SELECT entity_code, period FROM rate WHERE rate > 0 AND rate < 1000000),
groups AS (SELECT count(*) AS n FROM (SELECT DISTINCT substr(entity_code, 1, 2), period FROM clean)),
years AS (SELECT count(DISTINCT period) AS n FROM clean),
report AS (
  SELECT 'bronze' AS layer, 'localities' AS dataset, count(*) AS rows FROM localities
  UNION ALL SELECT 'bronze', 'measure', count(*) FROM measure UNION ALL SELECT 'bronze', 'rate', count(*) FROM rate
  UNION ALL SELECT 'bronze', 'series', n FROM points
  UNION ALL SELECT 'silver', 'localities', count(*) FROM localities
  UNION ALL SELECT 'silver', 'measure', count(*) FROM measure WHERE measure > 0 AND measure < 20000000
  UNION ALL SELECT 'silver', 'rate', count(*) FROM rate WHERE rate > 0 AND rate < 1000000
  UNION ALL SELECT 'silver', 'series', n FROM dates
  UNION ALL SELECT 'gold', 'entity_keys', count(*) FROM localities
  UNION ALL SELECT 'gold', 'dim_entity', count(*) FROM localities
  UNION ALL SELECT 'gold', 'dim_period', n FROM years
  UNION ALL SELECT 'gold', 'fact_entity', count(*) FROM clean
  UNION ALL SELECT 'gold', 'fact_group', n FROM groups
  UNION ALL SELECT 'gold', 'fact_nation', n FROM years)"""


def order_years(spark, sf):
    return sorted(r[0] for r in table(spark, sf, "orders").select(F.year("o_orderdate")).distinct().collect())


def full_run(spark, sf, **options):
    """All years of the data through all layers; the rates keep their default type."""
    lake, years = Lake(spark, Staging(spark).folder("lake")), order_years(spark, sf)
    return run_all(lake, run_sources(spark, sf), SERIES_NAMES, years, years, processed_at=STAMP, **options)


@query("run_report", f"WITH {RUN_SQL} SELECT layer, dataset, 'done' AS status, rows FROM report")
def run_report(spark, sf):
    return report_frame(spark, full_run(spark, sf).layers).select("layer", "dataset", "status", "rows")


@query("run_unchecked", f"WITH {RUN_SQL} SELECT CAST(sum(rows) AS BIGINT) AS total_rows, CAST(NULL AS DOUBLE) AS mean_pass_rate FROM report")
def run_unchecked(spark, sf):
    """Totals of a run with its checks off: no pass rate."""
    overall = full_run(spark, sf, checks_enabled=False).overall()
    return spark.createDataFrame([(overall["total_rows"], overall["mean_pass_rate"])], "total_rows long, mean_pass_rate double")


@query(
    "run_missing_columns",
    """SELECT 'bronze' AS layer, 'localities' AS dataset, 'failed' AS status, CAST(NULL AS BIGINT) AS rows
       UNION ALL SELECT 'bronze', 'series', 'done', count(*) FROM events""",
)
def run_missing_columns(spark, sf):
    """A landing whose required columns are missing fails with its assertion; the others land."""
    sources = run_sources(spark, sf)
    places = sources["localities"]
    sources["localities"] = lambda lake: require_columns(places(lake).drop("entity_code"), ["entity_code", "entity_name"])
    jobs = [job for job in bronze_jobs(sources, processed_at=STAMP) if job.dataset in ("localities", "series")]
    run = run_layer(Lake(spark, Staging(spark).folder("lake")), "bronze", jobs, BRONZE_RULES)
    return report_frame(spark, [run]).select("layer", "dataset", "status", "rows")


@query(
    "dim_period_given",
    """WITH given AS (SELECT CAST(1990 + i AS INTEGER) AS period FROM range(12) r(i)),
       keyed AS (SELECT CAST(row_number() OVER (ORDER BY period) AS BIGINT) AS period_key, period FROM given)
       SELECT period_key, period, count(o_orderkey) AS orders FROM keyed LEFT JOIN orders ON year(o_orderdate) = period
       GROUP BY 1, 2""",
)
def dim_period_given(spark, sf):
    """A period dimension from given periods, with the orders of each."""
    periods = model.dim_period(spark, [], periods=list(range(1990, 2002)))
    orders = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("o_orderkey").alias("n"))
    joined = periods.join(orders, periods.period == orders.year, "left")
    return joined.select("period_key", "period", F.coalesce("n", F.lit(0)).alias("orders"))


@query(
    "land_all_tolerant",
    """SELECT 'bronze' AS layer, 'localities' AS dataset, 'done' AS status, count(*) AS rows FROM customer
       UNION ALL SELECT 'bronze', 'measure', 'failed', NULL UNION ALL SELECT 'bronze', 'rate', 'disabled', NULL
       UNION ALL SELECT 'bronze', 'series', 'done', count(*) FROM events""",
)
def land_all_tolerant(spark, sf):
    """One source fails and one is switched off; the others still land."""
    sources = run_sources(spark, sf)
    sources["measure"] = lambda lake: spark.read.parquet(f"{sf}/no_such_table.parquet")
    jobs = [
        Job(job.dataset, job.build, enabled=job.dataset != "rate")
        for job in bronze_jobs(sources, None, None, processed_at=STAMP)
    ]
    run = run_layer(Lake(spark, Staging(spark).folder("lake")), "bronze", jobs, BRONZE_RULES)
    return report_frame(spark, [run]).select("layer", "dataset", "status", "rows")


# What a landed table of values, places or points holds, for its completeness.
VALUE_COLUMNS = ["entity_code", "period", "value", "entity_name", "source", "processed_at", "load_date"]
POINT_COLUMNS = ["date_text", "value_text", "series_code", "series_name", "source", "obs_date", "year", "month", "value", "processed_at", "load_date"]
SERIES_RULE = DatasetRules("bronze", "series", ["series_code", "obs_date"], ["series_code"], ["series_code", "obs_date"])
LANDED_SQL = f"""{ENT_SQL}, {LOCALITIES_SQL},
landed_measure AS (
  SELECT entity_code, CAST(year(o_orderdate) AS INTEGER) AS period,
         CASE WHEN o_totalprice < 100000 THEN o_totalprice END AS value, c_name AS entity_name, 'orders' AS source,
         1 AS processed_at, 1 AS load_date
  FROM orders JOIN ent ON o_custkey = c_custkey),
landed_rate AS (SELECT * FROM landed_measure QUALIFY row_number() OVER (PARTITION BY entity_code, period ORDER BY value) = 1),
landed_localities AS (SELECT *, 1 AS processed_at, 1 AS load_date FROM localities),
landed_series AS (
  SELECT 1 AS date_text, 1 AS value_text, {series_code_sql()} AS series_code, CAST(ts AS DATE) AS obs_date,
         event_type AS series_name, 1 AS source, 1 AS year, 1 AS month, CAST(value AS DECIMAL(18,4)) AS value,
         1 AS processed_at, 1 AS load_date FROM events),
results AS (
{dataset_sql(BRONZE_RULES[0], "landed_measure", VALUE_COLUMNS)} UNION ALL
{dataset_sql(BRONZE_RULES[1], "landed_rate", VALUE_COLUMNS)} UNION ALL
{dataset_sql(BRONZE_RULES[2], "landed_localities", [*model.DIM_ENTITY, "processed_at", "load_date"])} UNION ALL
{dataset_sql(SERIES_RULE, "landed_series", POINT_COLUMNS)})"""


def landed_with_faults(spark, sf):
    """Four raw datasets, some of whose checks fail: orders as measures repeat their keys, and large values are missing."""
    prices = table(spark, sf, "orders").join(entity_codes(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    values = prices.select(
        "entity_code",
        F.year("o_orderdate").alias("period"),
        F.when(F.col("o_totalprice") < 100_000, F.col("o_totalprice")).alias("value"),
        F.col("c_name").alias("entity_name"),
        F.lit("orders").alias("source"),
    )
    single = values.groupBy("entity_code", "period", "entity_name", "source").agg(F.min("value").alias("value"))
    sources = {**run_sources(spark, sf), "measure": lambda lake: values, "rate": lambda lake: single}
    years = order_years(spark, sf)
    return bronze_jobs(sources, years, years, processed_at=STAMP)


@query(
    "layer_run_checks",
    f"""WITH {LANDED_SQL}
        SELECT layer, count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks,
               count(*) FILTER (WHERE NOT passed) AS failed_checks,
               floor(CAST(count(*) FILTER (WHERE passed) AS DOUBLE) / count(*) * 100 * 100 + 0.5) / 100 AS pass_rate
        FROM results GROUP BY layer""",
)
def layer_run_checks(spark, sf):
    """Checks of all four datasets of a landed layer, read from what was written; some of them fail."""
    run = run_layer(Lake(spark, Staging(spark).folder("lake")), "bronze", landed_with_faults(spark, sf), [*BRONZE_RULES, SERIES_RULE])
    return summarize(run.checks)


@query("layer_run_results", f"WITH {LANDED_SQL} SELECT * FROM results")
def layer_run_results(spark, sf):
    """The same run, check by check."""
    return run_layer(Lake(spark, Staging(spark).folder("lake")), "bronze", landed_with_faults(spark, sf), [*BRONZE_RULES, SERIES_RULE]).checks


@query(
    "incremental_silver",
    f"""WITH {BASE_SQL} SELECT period, count(*) AS rows, CAST(sum(CASE WHEN period = 1997 THEN 2 * measure ELSE measure END) AS BIGINT) AS measure
        FROM measure WHERE period IN (1996, 1997) GROUP BY 1""",
)
def incremental_silver(spark, sf):
    """Two years landed and cleaned; one landed again, doubled, and only that one cleaned again."""
    lake, sources = Lake(spark, Staging(spark).folder("lake")), run_sources(spark, sf)
    first = sources["measure"]
    for years, factor in (([1996, 1997], 1), ([1997], 2)):
        sources["measure"] = lambda lake, by=factor: first(lake).withColumn("value", F.col("value") * by)
        jobs = [job for job in bronze_jobs(sources, years, processed_at=STAMP) if job.dataset == "measure"]
        run_layer(lake, "bronze", jobs, BRONZE_RULES, checks_enabled=False)
        jobs = [job for job in silver_jobs(landed=years) if job.dataset == "measure"]
        run_layer(lake, "silver", jobs, BRONZE_RULES, checks_enabled=False)
    return lake.read("silver", "measure").groupBy("period").agg(F.count("*").alias("rows"), F.sum("measure").alias("measure"))


# Runs after a failure, with retention, with later landings


@query(
    "run_after_failure",
    f"""WITH {RUN_SQL}, runs AS (
        SELECT 'series' AS broken, * FROM report UNION ALL SELECT 'measure', * FROM report),
        fate AS (SELECT *, CASE
          WHEN layer = 'bronze' AND dataset = broken THEN 'failed'
          WHEN layer = 'silver' AND dataset = broken THEN 'skipped'
          WHEN broken = 'series' AND layer = 'gold' AND dataset = 'fact_nation' THEN 'skipped'
          WHEN broken = 'measure' AND layer = 'gold' AND dataset NOT IN ('entity_keys', 'dim_entity') THEN 'skipped'
          ELSE 'done' END AS status FROM runs)
        SELECT broken, layer, dataset, status,
               CASE WHEN status <> 'done' THEN NULL WHEN dataset = 'entity_keys' THEN 0 ELSE rows END AS rows FROM fate""",
)
def run_after_failure(spark, sf):
    """A good run, then one without the series and one without the measure: what reads them is skipped, in every layer."""
    lake, years, sources = Lake(spark, Staging(spark).folder("lake")), order_years(spark, sf), run_sources(spark, sf)
    run_all(lake, sources, SERIES_NAMES, years, years, enrich=True, processed_at=STAMP, checks_enabled=False)
    frames = []
    for broken in ("series", "measure"):
        held = {**sources, broken: lambda lake: spark.read.parquet(f"{sf}/no_such_table.parquet")}
        run = run_all(lake, held, SERIES_NAMES, years, years, enrich=True, processed_at=STAMP, checks_enabled=False)
        frames.append(report_frame(spark, run.layers).select(F.lit(broken).alias("broken"), "layer", "dataset", "status", "rows"))
    return frames[0].unionByName(frames[1])


def part_of(sources, name, parity):
    """A source's rows of every other entity, under a source name of their own."""
    odd = F.col("entity_code").cast("decimal(20,0)") % 2 == parity
    return lambda lake: sources[name](lake).where(odd).withColumn("source", F.lit(f"{name}-{parity}"))


RETAINED_SQL = """SELECT '{layer}' AS layer, '{name}' AS dataset, period, count(*) AS rows FROM {name}
  WHERE period IN (1996, 1997) AND CAST(entity_code AS DECIMAL(20,0)) % 2 = 1 AND {bounds} GROUP BY period"""


@query(
    "run_retention",
    f"WITH {BASE_SQL} "
    + " UNION ALL ".join(
        RETAINED_SQL.format(layer=layer, name=name, bounds=bounds)
        for name, limit in (("measure", 20_000_000), ("rate", 1_000_000))
        for layer, bounds in (("bronze", "TRUE"), ("silver", f"{name} > 0 AND {name} < {limit}"))
    ),
)
def run_retention(spark, sf):
    """Half of the entities landed long ago, the others of late; at the end of the second run the first are past their time.

    In the raw layer they are partitions of their own, which are deleted; in the clean layer they share the partition
    of 1996 with others, so a new version of the table takes its place.
    """
    lake, sources = Lake(spark, Staging(spark).folder("lake")), run_sources(spark, sf)
    for parity, years, stamp, as_of in ((0, [1996], dt.datetime(2022, 12, 1), None), (1, [1996, 1997], STAMP, dt.date(2024, 5, 2))):
        held = {**sources, **{name: part_of(sources, name, parity) for name in ("measure", "rate")}}
        run_all(lake, held, SERIES_NAMES, years, years, processed_at=stamp, checks_enabled=False, retention_as_of=as_of)
    counts = [
        lake.read(layer, name).groupBy("period").agg(F.count("*").alias("rows")).select(F.lit(layer).alias("layer"), F.lit(name).alias("dataset"), "period", "rows")
        for layer in ("bronze", "silver")
        for name in ("measure", "rate")
    ]
    return reduce(DataFrame.unionByName, counts)


def run_base_sql(doubled: int) -> str:
    """Totals as a run cleans them, the measure of one year doubled."""
    inputs, base = BASE_SQL.replace("measure AS (", "all_measures AS (", 1).replace("rate AS (", "all_rates AS (", 1).split("base AS (")
    return f"""{inputs}landed_measures AS (
  SELECT entity_code, period, CASE WHEN period = {doubled} THEN 2 * measure ELSE measure END AS measure FROM all_measures),
measure AS (SELECT * FROM landed_measures WHERE measure > 0 AND measure < 20000000),
rate AS (SELECT * FROM all_rates WHERE rate > 0 AND rate < 1000000),
base AS ({base}"""


INCREMENTAL_SQL = fact_sql(run_base_sql(1997))


def landed_twice(spark, sf):
    """A run over all years, then one that lands 1997 again, doubled, and builds only what that changes."""
    lake, years, sources = Lake(spark, Staging(spark).folder("lake")), order_years(spark, sf), run_sources(spark, sf)
    options = {"processed_at": STAMP, "checks_enabled": False, "gold_by_period": True}
    run_all(lake, sources, SERIES_NAMES, years, years, **options)
    doubled = {**sources, "measure": lambda lake: sources["measure"](lake).withColumn("value", 2 * F.col("value"))}
    run_all(lake, doubled, SERIES_NAMES, 1997, 1997, landed=[1997], **options)
    return lake


@query(
    "incremental_fact",
    f"""WITH {INCREMENTAL_SQL} SELECT entity_key, period_key, entity_code, period, measure, CAST(total AS DOUBLE) AS total,
        CAST(rate AS DOUBLE) AS rate, growth_total, growth_measure, share_in_group, share_in_nation, rank_in_group,
        rank_in_nation FROM fact""",
)
def incremental_fact(spark, sf):
    """The entity fact after the second landing, equal to one built as a whole."""
    return landed_twice(spark, sf).read("gold", "fact_entity").select(*model.FACT_ENTITY)


@query(
    "incremental_group",
    f"""WITH {GROUP_SQL.replace(FACT_SQL, INCREMENTAL_SQL)} SELECT group_code, group_short, group_name, period, entities, measure,
        CAST(total AS DOUBLE) AS total, mean_rate, growth_total, growth_measure, share_in_nation, rank_in_nation FROM fact_group""",
)
def incremental_group(spark, sf):
    """The group fact after the second landing."""
    return landed_twice(spark, sf).read("gold", "fact_group").select(*model.FACT_GROUP)


@query(
    "stable_keys",
    f"""WITH {LOCALITIES_SQL}, marked AS (SELECT *, CAST(entity_code AS DECIMAL(20,0)) % 2 = 0 AS late FROM localities)
        SELECT CAST(row_number() OVER (ORDER BY late, entity_code) - 1 AS BIGINT) AS entity_key, entity_code, group_code
        FROM marked""",
)
def stable_keys(spark, sf):
    """Entities with odd codes land first, all of them later: the first keep their keys, the new ones follow."""
    lake, staging = Lake(spark, Staging(spark).folder("lake")), Staging(spark)
    jobs = [job for job in gold_jobs(staging, SERIES_NAMES) if job.dataset in ("entity_keys", "dim_entity")]
    places = clean_localities(localities(spark, sf))
    for landed in (places.where(F.col("entity_code").cast("decimal(20,0)") % 2 == 1), places):
        run_layers(lake, [Layer("silver", [Job("localities", lambda lake, df=landed: df)], []), Layer("gold", jobs, [])])
    return lake.read("gold", "dim_entity").select("entity_key", "entity_code", "group_code")


# Checks of a full run


RUN_STAR_SQL = NATION_SQL.replace(FACT_SQL, fact_sql(run_base_sql(0)))
FILLED = "'x' AS source, 1 AS processed_at, 1 AS load_date"
CHECKED_SQL = f"""{RUN_STAR_SQL}, fact_entity AS (SELECT * FROM fact),
bronze_measure AS (
  SELECT entity_code, period, measure AS value, 'x' AS entity_name, {FILLED}
  FROM (SELECT * FROM all_measures UNION ALL SELECT * FROM all_measures WHERE period = 1997)),
bronze_rate AS (SELECT entity_code, period, rate AS value, 'x' AS entity_name, {FILLED} FROM all_rates),
places AS (SELECT *, 1 AS processed_at, 1 AS load_date FROM localities),
silver_measure AS (SELECT *, 'x' AS entity_name, 'x' AS group_code, 1 AS processed_at, 1 AS load_date FROM measure),
silver_rate AS (SELECT *, 'x' AS entity_name, 'x' AS group_code, 1 AS processed_at, 1 AS load_date FROM rate),
silver_series AS (
  SELECT DISTINCT event_type AS series_code, CAST(ts AS DATE) AS obs_date, 1 AS value, 'x' AS series_name, 'x' AS date_text,
         'x' AS value_text, 1 AS year, 1 AS month, {FILLED} FROM events),
results AS (
{dataset_sql(BRONZE_RULES[0], "bronze_measure", VALUE_COLUMNS)} UNION ALL
{dataset_sql(BRONZE_RULES[1], "bronze_rate", VALUE_COLUMNS)} UNION ALL
{dataset_sql(BRONZE_RULES[2], "places", [*model.DIM_ENTITY, "processed_at", "load_date"])} UNION ALL
{dataset_sql(SILVER_RULES[0], "silver_measure", ["entity_code", "period", "measure", "entity_name", "group_code", "processed_at", "load_date"])} UNION ALL
{dataset_sql(SILVER_RULES[1], "silver_rate", ["entity_code", "period", "rate", "entity_name", "group_code", "processed_at", "load_date"])} UNION ALL
{dataset_sql(SILVER_RULES[2], "places", [*model.DIM_ENTITY, "processed_at", "load_date"])} UNION ALL
{dataset_sql(SILVER_RULES[3], "silver_series", POINT_COLUMNS)} UNION ALL
{" UNION ALL ".join(dataset_sql(r, r.dataset, GOLD_COLUMNS[r.dataset]) for r in GOLD_RULES)} UNION ALL
{" UNION ALL ".join(integrity_sql(r) for r in GOLD_REFERENCES)}),
rates AS (
  SELECT layer, count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks,
         floor(CAST(count(*) FILTER (WHERE passed) AS DOUBLE) / count(*) * 100 * 100 + 0.5) / 100 AS pass_rate
  FROM results GROUP BY layer)"""


@query(
    "run_pass_rate",
    f"""WITH {CHECKED_SQL}
        SELECT layer, total_checks, passed_checks, pass_rate FROM rates UNION ALL
        SELECT 'all', CAST(sum(total_checks) AS BIGINT), CAST(sum(passed_checks) AS BIGINT), round(avg(pass_rate), 2) FROM rates""",
)
def run_pass_rate(spark, sf):
    """Checks of a full run whose raw measure holds one year twice: per layer, and the mean rate of the run."""
    lake, years, sources = Lake(spark, Staging(spark).folder("lake")), order_years(spark, sf), run_sources(spark, sf)
    measures = sources["measure"]
    sources["measure"] = lambda lake: measures(lake).unionByName(measures(lake).where("period = 1997"))
    run = run_all(lake, sources, SERIES_NAMES, years, years, processed_at=STAMP)
    layers = reduce(DataFrame.unionByName, [summarize(layer.checks) for layer in run.layers]).drop("failed_checks")
    mean = F.lit(run.overall()["mean_pass_rate"]).alias("pass_rate")
    sums = [F.sum(c).alias(c) for c in ("total_checks", "passed_checks")]
    return layers.unionByName(layers.agg(*sums).select(F.lit("all").alias("layer"), "total_checks", "passed_checks", mean))
