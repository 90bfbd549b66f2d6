"""Landing of locality responses: a four-deep struct per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import JSON_ARRAY_FILE

# Field names of the public localities format.
LOCALITIES_SCHEMA = (
    "id string, nome string, microrregiao struct<mesorregiao: struct<UF: struct<"
    "id: string, sigla: string, nome: string,"
    "regiao: struct<id: string, sigla: string, nome: string>>>>"
)
_GROUP = "microrregiao.mesorregiao.UF"


def read_localities(spark: SparkSession, path: str) -> DataFrame:
    """Read landed response files (one JSON array each) and project them."""
    rows = spark.read.schema(LOCALITIES_SCHEMA).options(**JSON_ARRAY_FILE).json(path)
    return flatten_localities(rows)


def parse_localities(texts: DataFrame, column: str) -> DataFrame:
    """Project localities held as JSON text in ``column``, one object per row; ``rejected_localities`` counts the rest."""
    parsed = texts.select(F.from_json(column, LOCALITIES_SCHEMA).alias("l"))
    return flatten_localities(parsed.where(~_broken("l")).select("l.*"))


def read_locality_lines(spark: SparkSession, path: str) -> DataFrame:
    """Read landed files with one locality on each line, which split."""
    return parse_localities(spark.read.text(path), "value")


def rejected_localities(texts: DataFrame, column: str) -> DataFrame:
    """Count all texts, and those that are no valid locality: broken JSON, or neither code nor name."""
    parsed = texts.select(F.from_json(column, LOCALITIES_SCHEMA).alias("l"))
    return parsed.agg(F.count(F.lit(1)).alias("responses"), F.count_if(_broken("l")).alias("broken_responses"))


def _broken(column: str):
    return F.col(column).isNull() | (F.col(f"{column}.id").isNull() & F.col(f"{column}.nome").isNull())


def flatten_localities(rows: DataFrame) -> DataFrame:
    """Eight flat columns; a level that is absent gives null."""
    return rows.select(
        F.col("id").alias("entity_code"),
        F.col("nome").alias("entity_name"),
        F.col(f"{_GROUP}.id").alias("group_code"),
        F.col(f"{_GROUP}.sigla").alias("group_short"),
        F.col(f"{_GROUP}.nome").alias("group_name"),
        F.col(f"{_GROUP}.regiao.id").alias("region_code"),
        F.col(f"{_GROUP}.regiao.nome").alias("region_name"),
        F.col(f"{_GROUP}.regiao.sigla").alias("region_short"),
    )
