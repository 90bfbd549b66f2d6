"""Landing of economic time series: ``{data, valor}`` text pairs per series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import parse_date, parse_decimal, year_month
from tidemark.sources import Landing
from tidemark.sources.pieces import parsed, read_pieces

# Name and public code of each default series.
DEFAULT_SERIES = {
    "ipca_mensal": 433,
    "ipca_12m": 13522,
    "ipca_15": 10764,
    "inpc": 188,
    "igpm": 189,
    "igpdi": 190,
    "pib_mensal": 4380,
    "pib_acumulado_12m": 4381,
    "desemprego": 24369,
    "selic": 432,
    "cdi": 12,
    "dolar": 1,
    "euro": 21619,
    "reservas_internacionais": 13621,
    "base_monetaria": 1787,
    "meios_pagamento": 1788,
}
# Field names of the public series format.
SERIES_SCHEMA = "data string, valor string"


def series_catalogue(spark: SparkSession, series: dict[str, int | None] | None = None) -> DataFrame:
    """Configured series as (series_code, series_name); entries without a code are dropped."""
    entries = DEFAULT_SERIES if series is None else series
    rows = [(code, name) for name, code in entries.items() if code is not None]
    return spark.createDataFrame(rows, "series_code int, series_name string")


def read_series(spark: SparkSession, path: str, catalogue: DataFrame, source: str, lines: bool = False) -> DataFrame:
    """Read every series under ``path/series_code=<code>/`` in one job and type it.

    A file is one JSON array, or one point on each line where ``lines`` is set, which lets a large file split.
    What is not valid JSON loses only its own points; ``broken_series`` counts it, and a run reports the counts.
    """
    raw = _raw_points(spark, path, lines).filter(F.col("_broken").isNull()).drop("_broken")
    return land_series(raw, catalogue, source)


def broken_series(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Files, or lines, per series that could not be parsed."""
    # Spark refuses a query that reads the broken text alone; its points are null as well.
    broken = _raw_points(spark, path, lines).filter(F.col("_broken").isNotNull() & F.col("data").isNull())
    return broken.groupBy("series_code").agg(F.count(F.lit(1)).alias("files"))


def read_series_pieces(spark: SparkSession, path: str, catalogue: DataFrame, source: str) -> DataFrame:
    """As :func:`read_series`, but a file that is one large array is read by many tasks.

    The files are cut at the key of the date, which each point has first. A broken point loses only itself, where the
    whole file is lost otherwise; ``broken_series_pieces`` counts it.
    """
    points = _point_pieces(spark, path).where("not broken")
    return land_series(points.select("record.data", "record.valor", "series_code"), catalogue, source)


def series_landing(spark: SparkSession, path: str, catalogue: DataFrame, source: str) -> Landing:
    """Series as :func:`read_series_pieces` reads them, with the points that are broken."""
    return Landing(read_series_pieces(spark, path, catalogue, source), broken_series_pieces(spark, path))


def broken_series_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Points per series that could not be parsed."""
    return _point_pieces(spark, path).where("broken").groupBy("series_code").agg(F.count(F.lit(1)).alias("points"))


def _point_pieces(spark: SparkSession, path: str) -> DataFrame:
    return parsed(read_pieces(spark, path, "data", "series_code int"), "data", SERIES_SCHEMA)


def _raw_points(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    reader = spark.read.schema(f"{SERIES_SCHEMA}, _broken string, series_code int")
    options = {"multiLine": str(not lines).lower(), "columnNameOfCorruptRecord": "_broken", "basePath": path}
    return reader.options(**options).json(path)


def land_series(raw: DataFrame, catalogue: DataFrame, source: str) -> DataFrame:
    """Tag raw points with their catalogue entry and add typed date, year, month and value.

    Points of series outside the catalogue are not landed.
    """
    # The catalogue is configuration, whose size Spark cannot know; a join by code would leave one task per series.
    tagged = raw.join(F.broadcast(catalogue), "series_code")
    typed = tagged.select(
        "series_code",
        "series_name",
        F.lit(source).alias("source"),
        F.col("data").alias("date_text"),
        F.col("valor").alias("value_text"),
        parse_date(F.lit(None).cast("date"), "data").alias("obs_date"),
        parse_decimal(F.lit(None).cast("decimal(18,4)"), "valor").alias("value"),
    )
    return year_month(typed, "obs_date")
