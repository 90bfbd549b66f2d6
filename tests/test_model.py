import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans import clean, incremental, model

STAMP = "timestamp '2024-05-01 00:00:00'"


def entities(spark, staging, codes=("0100001", "0100002", "0200001")):
    data = [(c, f"name {c}", c[:2], c[:2], f"group {c[:2]}", "1", "region", "R") for c in codes]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in model.DIM_ENTITY))
    return model.dim_entity(df, staging)


def build(spark, staging, measures, rates, **options):
    m = spark.createDataFrame(measures, "entity_code string, period int, measure bigint")
    r = spark.createDataFrame(rates, "entity_code string, period int, rate double")
    dims = entities(spark, staging)
    periods = model.dim_period(spark, [m, r])
    return model.fact_entity(m, r, dims, periods, staging, **options), dims, periods


def by_key(df):
    return {(r["entity_code"], r["period"]): r for r in df.collect()}


def test_entity_fact_totals_growth_shares_and_ranks(spark, staging):
    measures = [("0100001", 2020, 1000), ("0100001", 2021, 1100), ("0100002", 2020, 500), ("0200001", 2021, 100)]
    rates = [("0100001", 2020, 30.0), ("0100001", 2021, 60.0), ("0100002", 2020, 20.0), ("0200001", 2020, 7.0)]
    fact, dims, periods = build(spark, staging, measures, rates)
    assert fact.columns == model.FACT_ENTITY
    got = by_key(fact)
    assert len(got) == 5
    first = got["0100001", 2020]
    assert (first.entity_key, first.period_key, first.total) == (0, 1, 30.0)
    assert (first.growth_total, first.growth_measure) == (None, None)
    assert (first.share_in_group, first.share_in_nation) == (75.0, 75.0)
    assert (first.rank_in_group, first.rank_in_nation) == (1, 1)
    second = got["0100001", 2021]
    assert second.total == 66.0 and second.growth_total == pytest.approx(120.0) and second.growth_measure == 10.0
    only_rate = got["0200001", 2020]
    assert (only_rate.measure, only_rate.total, only_rate.rate) == (None, None, 7.0)
    assert (only_rate.rank_in_group, only_rate.rank_in_nation, only_rate.share_in_group) == (1, 3, None)


def test_no_common_period_gives_no_totals_and_ranks_by_code(spark, staging):
    fact, _, _ = build(spark, staging, [("0100002", 2024, 5), ("0100001", 2024, 5)], [("0100001", 2021, 2.0)])
    got = by_key(fact)
    assert all(r.total is None and r.growth_total is None and r.share_in_nation is None for r in got.values())
    assert got["0100001", 2024].rank_in_nation == 1 and got["0100002", 2024].rank_in_nation == 2


def test_unknown_entities_form_a_group_of_their_own(spark, staging):
    measures = [("9900001", 2020, 1000), ("9900002", 2020, 3000), ("0100001", 2020, 1000)]
    rates = [("9900001", 2020, 1.0), ("9900002", 2020, 1.0), ("0100001", 2020, 4.0)]
    fact, dims, _ = build(spark, staging, measures, rates)
    got = by_key(fact)
    assert got["9900001", 2020].entity_key is None
    assert got["9900001", 2020].share_in_group == 25.0 and got["9900001", 2020].rank_in_group == 2
    groups = model.fact_group(fact, dims, staging)
    assert {r.group_code: r.entities for r in groups.collect()} == {None: 2, "01": 1}
    nation = model.fact_nation(groups).first()
    assert (nation.groups, nation.measure, nation.total) == (1, 5000, 8.0)
    assert nation.rate == 8.0 / 5000


def test_group_and_nation_growth(spark, staging):
    measures = [("0100001", y, m) for y, m in [(2020, 100), (2022, 200)]] + [("0200001", 2022, 100)]
    rates = [("0100001", 2020, 10.0), ("0100001", 2022, 10.0), ("0200001", 2022, 30.0)]
    fact, dims, _ = build(spark, staging, measures, rates)
    groups = model.fact_group(fact, dims, staging)
    got = {(r.group_code, r.period): r for r in groups.collect()}
    assert got["01", 2022].growth_total == 100.0 and got["01", 2022].mean_rate == 10.0
    assert (got["01", 2022].share_in_nation, got["01", 2022].rank_in_nation) == (40.0, 2)
    nation = {r.period: r for r in model.fact_nation(groups).collect()}
    assert nation[2022].growth_measure == 200.0 and nation[2020].growth_measure is None


def test_strict_growth_needs_the_period_before(spark, staging):
    measures = [("0100001", y, m) for y, m in [(2020, 100), (2022, 200)]]
    fact, _, _ = build(spark, staging, measures, [("0100001", 2020, 1.0)], strict_growth=True)
    assert by_key(fact)["0100001", 2022].growth_measure is None


def test_period_dimension_falls_back_in_order(spark):
    empty = spark.createDataFrame([], "period int")
    table = spark.createDataFrame([(2003,), (2002,)], "period int")
    series = spark.createDataFrame([(2010,), (2011,), (2010,)], "year int")
    no_series = spark.createDataFrame([], "year int")

    def years(*args, **kwargs):
        return [r.period for r in model.dim_period(spark, *args, **kwargs).orderBy("period_key").collect()]

    assert years([table], series, periods=[1999, 1998]) == [1998, 1999]
    assert years([empty, table], series) == [2002, 2003]
    assert years([empty], series) == [2010, 2011]
    assert years([], no_series, as_of=dt.date(2024, 6, 1)) == [2020, 2021, 2022, 2023, 2024]


def test_region_total(spark, staging):
    fact, dims, _ = build(
        spark, staging, [("0100001", 2021, 1000), ("0200001", 2021, 1000)], [("0100001", 2021, 1.0), ("0200001", 2021, 2.0)]
    )
    assert rows(model.total_by_region(fact, dims, 2021)) == [("region", 3.0)]


def raw_values(spark, data):
    schema = "entity_code string, entity_name string, period string, value double, processed_at string"
    return spark.createDataFrame(data, schema).selectExpr(
        "entity_code", "entity_name", "period", "value", "cast(processed_at as timestamp) processed_at",
        "cast(processed_at as date) load_date",
    )


def test_a_copy_out_of_bounds_never_replaces_a_good_one(spark):
    data = [
        ("0100001", " São Paulo ", "2020", 100.0, "2024-01-01"),
        ("0100001", "São Paulo", "2020", 30_000_000.0, "2024-02-01"),
        ("0100002", "b", "2020", 0.0, "2024-01-01"),
        ("0100003", "c", "bad", 5.0, "2024-01-01"),
        ("0100004", "d", "2020", None, "2024-01-01"),
        (None, "e", "2020", 5.0, "2024-01-01"),
    ]
    got = clean.clean_measure(raw_values(spark, data)).collect()
    assert [(r.entity_code, r.entity_name, r.group_code, r.period, r.measure) for r in got] == [
        ("0100001", "SÃO PAULO", "01", 2020, 100)
    ]


def test_rate_keeps_the_latest_load(spark):
    data = [("0100001", "a", "2020", 1.5, "2024-01-01"), ("0100001", "a", "2020", 2.5, "2024-03-01")]
    assert [r.rate for r in clean.clean_rate(raw_values(spark, data)).collect()] == [2.5]


def test_clean_series_parses_and_deduplicates_all_series_at_once(spark):
    schema = "series_code int, series_name string, date_text string, value_text string, processed_at string"
    data = [
        (1, "a", "01/02/2020", "0.5", "2024-01-01"),
        (1, "a", "01/02/2020", "0.7", "2024-01-02"),
        (2, "b", "01/02/2020", "3", "2024-01-01"),
        (2, "b", "31/02/2020", "3", "2024-01-01"),
        (2, "b", "03/02/2020", "-", "2024-01-01"),
        (2, "b", "03/02/2009", "1", "2024-01-01"),
    ]
    df = spark.createDataFrame(data, schema).selectExpr(
        "*", "cast(null as date) obs_date", "cast(null as decimal(18,4)) value", "'api' source",
        "cast(processed_at as date) load_date",
    )
    got = clean.clean_series(df, min_year=2010)
    assert [(r.series_code, str(r.obs_date), str(r.value)) for r in got.orderBy("series_code").collect()] == [
        (1, "2020-02-01", "0.7000"),
        (2, "2020-02-01", "3.0000"),
    ]


def test_declared_rules(spark):
    df = spark.createDataFrame([(" 1 ", "5.5", "2020", " x "), (None, "1", "2020", "y"), ("2", "bad", "20x", "z")], "codigo_municipio string, Valor string, Ano string, other string")
    got = rows(clean.apply_rules(df, clean.DEFAULT_RULES))
    assert got == [("1", 5.5, 2020, "x")]


def test_a_landing_merges_and_ranks_only_its_own_periods(spark, staging):
    """Rows of other periods come from the fact as it is; only their growth is taken anew."""
    both = [(f"0{e}", p, 100 * e + p % 7, float(e + p % 5)) for e in range(1, 9) for p in range(2015, 2020) if (e + p) % 4]
    places = spark.createDataFrame([(e, f"0{e}", f"{e % 2}") for e in range(1, 9)], "entity_key long, entity_code string, group_code string")
    periods = spark.createDataFrame([(p - 2014, p) for p in range(2015, 2020)], "period_key long, period int")

    def sides(data):
        measures = spark.createDataFrame([(e, p, m) for e, p, m, _ in data], "entity_code string, period int, measure long")
        rates = spark.createDataFrame([(e, p, r) for e, p, _, r in data], "entity_code string, period int, rate double")
        return measures, rates.withColumn("rate", F.col("rate").cast("decimal(18,4)"))

    changed = [(e, p, 3 * m if p == 2017 else m, r) for e, p, m, r in both if (e, p) != ("03", 2017)]
    before, after = (staging.freeze(model.fact_entity(*sides(data), places, periods, staging), "fact") for data in (both, changed))
    keys = sides(changed)[0].select("entity_code", "period")
    dirty = incremental.touched_periods(before, keys, "entity_code", [2017])
    alone = sides([row for row in changed if row[1] == 2017])
    found = incremental.fact_entity_of(before, *alone, places, periods, [2017], dirty, staging)
    assert dirty == [2017, 2018, 2019]
    assert rows(found) == rows(after.where(F.col("period").isin(dirty)))
