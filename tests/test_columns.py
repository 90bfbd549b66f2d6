import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests_util import one
from tidemark.functions import columns as c
from tidemark.functions import predicates as p


def test_standard_name_keeps_accents_and_strips_spaces(spark):
    df = spark.createDataFrame([("  São Paulo ",), ("rio",), (None,), ("\tx ",)], "name string")
    got = [r[0] for r in df.select(c.standard_name("name")).collect()]
    assert got == ["SÃO PAULO", "RIO", None, "\tX"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("12325232", 12325232.0),
        ("0.5", 0.5),
        ('{"valor": "7.25"}', 7.25),
        ('{"valor": 3}', 3.0),
        ('{"valor": null}', None),
        ('{"other": 1}', None),
        ('{"valor": "..."}', None),
        ('{"valor": ""}', None),
        ("...", None),
        ("", None),
        ("n/a", None),
        (None, None),
    ],
)
def test_decode_value(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert one(df.select(c.decode_value("raw"))) == expected


def test_decode_period(spark):
    df = spark.createDataFrame([("2020",), ("202201",), ("media",), ("-5",), ("99999999999",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(c.decode_period("t")).collect()] == [2020, 202201] + [None] * 5


def test_dates_and_decimals_fall_back_to_text(spark):
    data = [
        (dt.date(2020, 1, 2), "05/06/2021", Decimal("1.5"), "9"),
        (None, "05/06/2021", None, "9.12345"),
        (None, "2021-06-05", None, "x"),
        (None, None, None, None),
    ]
    df = spark.createDataFrame(data, "d date, dtext string, v decimal(18,4), vtext string")
    got = df.select(c.parse_date("d", "dtext"), c.parse_decimal("v", "vtext")).collect()
    assert [tuple(r) for r in got] == [
        (dt.date(2020, 1, 2), Decimal("1.5000")),
        (dt.date(2021, 6, 5), Decimal("9.1235")),
        (None, None),
        (None, None),
    ]


def test_total_is_exact_for_decimals_and_double_otherwise(spark):
    df = spark.createDataFrame([(Decimal("10.55"), 2000), (None, 5), (Decimal("1.00"), None)], "r decimal(18,2), m bigint")
    got = [r["t"] for r in c.with_total(df, "r", "m", "t").collect()]
    assert got == [Decimal("21.10000"), None, None]
    doubles = df.withColumn("r", F.col("r").cast("double"))
    assert [r["t"] for r in c.with_total(doubles, "r", "m", "t").collect()] == [21.1, None, None]


def test_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(5, 0), (5, 4), (None, 4)], "a int, b int")
    assert [r[0] for r in df.select(c.percent("a", "b")).collect()] == [None, 125.0, None]


def test_period_attributes_follow_parity(spark):
    df = spark.createDataFrame([(2020,), (2021,), (2022,), (2023,)], "period int")
    got = [tuple(r) for r in df.select(c.period_half("period"), c.period_quarter("period")).collect()]
    assert got == [(1, 1), (2, 2), (1, 3), (2, 4)]


def test_casts_turn_bad_values_into_null(spark):
    df = spark.createDataFrame([("7", "x", "99999999999")], "a string, b string, c string")
    got = c.cast_columns(df, {"a": "int", "b": "int", "c": "int"}).first()
    assert tuple(got) == (7, None, None)


def test_audit_columns_take_the_given_time(spark):
    stamp = dt.datetime(2024, 5, 1, 12)
    got = c.audit_columns(spark.range(1), stamp).first()
    assert got["load_date"] == dt.date(2024, 5, 1)
    assert c.audit_columns(spark.range(1)).dtypes[1:] == [("processed_at", "timestamp"), ("load_date", "date")]


def test_bounds(spark):
    df = spark.createDataFrame([(0,), (1,), (9,), (10,), (None,)], "v int")
    assert [r[0] for r in df.filter(p.within_open("v", 0, 10)).collect()] == [1, 9]
    assert [r[0] for r in df.filter(p.within_closed("v", 0, None)).collect()] == [0, 1, 9, 10]
    assert [r[0] for r in df.filter(p.within_closed("v", None, 1)).collect()] == [0, 1]


def test_drop_missing(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, 1)], "a int, b int")
    assert [tuple(r) for r in p.drop_missing(df, ["a", "b"]).collect()] == [(1, 1)]
