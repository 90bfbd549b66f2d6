"""Landing of aggregates responses: result sets of series, one value per locality and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import MISSING_MARKER, decode_period, decode_value, value_text
from tidemark.sources import JSON_ARRAY_FILE, Landing
from tidemark.sources.pieces import parsed, read_pieces, with_record

# Field names of the public aggregates format. A map value may be
# text or an object; read as text, an object keeps its JSON form.
SERIES_RECORD = "localidade struct<id: string, nome: string, nivel: struct<id: string>>, serie map<string, string>"
AGGREGATES_SCHEMA = f"id string, resultados array<struct<series: array<struct<{SERIES_RECORD}>>>>"
# The id of a variable: the last one before its results.
VARIABLE = r'(?s)"id"\s*:\s*"([^"]*)"(?:(?!"id"\s*:|"resultados").)*+"resultados"'


def read_aggregates(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Read landed response files (one JSON array each) and flatten them."""
    responses = spark.read.schema(AGGREGATES_SCHEMA).options(**JSON_ARRAY_FILE).json(path)
    return flatten_aggregates(responses, source)


def parse_aggregates(texts: DataFrame, column: str, source: str) -> DataFrame:
    """Flatten responses held as JSON text in ``column``, each an array of variables."""
    return flatten_aggregates(_parsed(texts, column), source)


def flatten_aggregates(responses: DataFrame, source: str) -> DataFrame:
    """One row per (locality, year); a year that is no number becomes null."""
    return _typed(_points(responses), source)


def _typed(points: DataFrame, source: str) -> DataFrame:
    return points.select(
        "entity_code",
        "entity_name",
        decode_period("year").alias("period"),
        decode_value("raw").alias("value"),
        "variable",
        F.lit(source).alias("source"),
        "level",
    )


def read_aggregate_lines(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Read landed files with one response on each line, which split, and flatten them; see ``rejected_lines``."""
    return parse_aggregates(spark.read.text(path), "value", source)


def read_aggregate_pieces(spark: SparkSession, path: str, source: str) -> DataFrame:
    """As :func:`read_aggregates`, but a response that is one large array is read by many tasks.

    The files are cut at the key of the locality, which each series has first. The variable stands once before all of
    its series: the last one before a series in its file is its own. Within a block, which one task reads, it is carried
    on by a window, so the parsed series are shuffled once, by block; over the blocks of a file one row each is carried
    on. The work grows with the text, however many variables a file holds. A broken series loses only itself;
    ``broken_aggregate_pieces`` counts it.
    """
    pieces = _series_pieces(spark, path)
    whole = with_record(pieces, "localidade", SERIES_RECORD).where(~F.col("broken") | F.col("variable").isNotNull())
    in_block = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    filled = whole.select("file", "block", "at", "broken", "record", "variable").withColumn("_own", F.last("variable", ignorenulls=True).over(in_block))
    last = F.max_by("variable", F.when(F.col("variable").isNotNull(), F.col("at")))
    blocks = pieces.groupBy(F.col("file").alias("_file"), F.col("block").alias("_block")).agg(last.alias("_last"))
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("_file", "_block", F.last("_last", ignorenulls=True).over(in_file).alias("_carried"))
    known = filled.where("not broken").join(carried, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")), "left")
    return _typed(_years(known.select(F.coalesce("_own", "_carried").alias("variable"), F.col("record").alias("s"))), source)


def aggregates_landing(spark: SparkSession, path: str, source: str) -> Landing:
    """Responses as :func:`read_aggregate_pieces` reads them, with the series that are broken."""
    return Landing(read_aggregate_pieces(spark, path, source), broken_aggregate_pieces(spark, path))


def broken_aggregate_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Series that ``read_aggregate_pieces`` leaves out, counted."""
    series = parsed(_series_pieces(spark, path), "localidade", SERIES_RECORD)
    return series.agg(F.count(F.lit(1)).alias("series"), F.count_if("broken").alias("broken_series"))


def _series_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces with the last ``variable`` that starts in them, if any."""
    pieces = read_pieces(spark, path, "localidade")
    found = F.regexp_extract_all("value", F.lit(VARIABLE), F.lit(1))
    return pieces.withColumn("variable", F.when(F.col("value").contains('"resultados"'), F.try_element_at(found, F.lit(-1))))


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """Responses and values that ``read_aggregate_lines`` leaves out, counted."""
    return rejected_values(spark.read.text(path), "value")


def rejected_values(texts: DataFrame, column: str) -> DataFrame:
    """Count responses that are no valid JSON, and values that are present, not the missing marker, and no number."""
    text = value_text("raw")
    bad = (F.trim(text) != "") & (text != MISSING_MARKER) & decode_value("raw").isNull()
    points = _points(_parsed(texts, column))
    values = points.agg(F.count(F.lit(1)).alias("values"), F.count_if(bad).alias("rejected"))
    # A broken response parses to an array with one row of nulls, or to null.
    parsed = F.from_json(column, f"array<struct<{AGGREGATES_SCHEMA}>>")
    broken = parsed.isNull() | F.exists(parsed, lambda r: r["id"].isNull() & r["resultados"].isNull())
    responses = texts.agg(F.count(F.lit(1)).alias("responses"), F.count_if(broken).alias("broken_responses"))
    names = ["values", "rejected", "responses", "broken_responses"]
    both = values.unionByName(responses, allowMissingColumns=True)
    return both.agg(*[F.sum(n).alias(n) for n in names])


def _parsed(texts: DataFrame, column: str) -> DataFrame:
    # For a plain inline Spark adds filters that parse the text again; the
    # outer one has none, and its rows of nulls end at the next explode.
    parsed = F.from_json(column, f"array<struct<{AGGREGATES_SCHEMA}>>")
    return texts.select(F.inline_outer(parsed))


def _points(responses: DataFrame) -> DataFrame:
    results = responses.select(F.col("id").alias("variable"), F.explode("resultados").alias("result"))
    return _years(results.select("variable", F.explode("result.series").alias("s")))


def _years(series: DataFrame) -> DataFrame:
    # Only flat columns go along with each year, not the whole series again.
    flat = series.select(
        "variable",
        F.col("s.localidade.id").alias("entity_code"),
        F.col("s.localidade.nome").alias("entity_name"),
        F.col("s.localidade.nivel.id").alias("level"),
        F.col("s.serie").alias("serie"),
    )
    return flat.select(
        "variable", "entity_code", "entity_name", "level", F.explode("serie").alias("year", "raw")
    )
