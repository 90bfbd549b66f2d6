"""Parquet tables of the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Scan a Parquet table, with a forced schema when one is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
