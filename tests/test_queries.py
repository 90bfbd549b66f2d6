"""Every registered query against DuckDB on the smallest tables."""

from decimal import Decimal

import duckdb
import pytest
from conftest import plan

import __spark_entry__ as entry
from workload.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield connection
    connection.close()


def plain(row):
    return tuple(float(v) if isinstance(v, Decimal) else v for v in row)


def ordered(found):
    return sorted(map(plain, found), key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    physical = plan(df)
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in physical
    columns = sorted(df.columns)
    relation = duck.sql(entry.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    got = ordered(df.select(*columns).collect())
    want = ordered(relation.select(*[f'"{c}"' for c in columns]).fetchall())
    assert got == want


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["entity_key", "period_key", "entity_code", "period"]
    assert df.count() == 797
