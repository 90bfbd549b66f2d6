"""Registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; decimals leave as doubles, as the SQL side casts them too."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(spark, sf_dir)
            decimals = [f.name for f in df.schema.fields if f.dataType.simpleString().startswith("decimal")]
            return df.withColumns({c: F.col(c).cast("double") for c in decimals})

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register
