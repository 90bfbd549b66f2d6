"""Array files cut at a key, so that one large JSON array is read by many tasks.

A file that is one JSON array has no lines to split at. But every record of the
public formats has one key that no other object has, and text between two
places of it is a line to Spark's reader, which splits a file between lines. A
line starts behind the key: with brace and key put back before it the record is
whole again, and what follows its closing brace is not read by the JSON parser.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pieces(spark: SparkSession, path: str, key: str, columns: str = "") -> DataFrame:
    """The text behind each place of ``key`` up to the next one, and what stands before the first.

    ``file``, ``block`` and ``at`` give the place: within a file, pieces follow each other by block and number.
    ``is_record`` is false for the text before the first record. ``columns`` are partition columns of the folder.
    """
    reader = spark.read.schema("value string" + (f", {columns}" if columns else ""))
    pieces = reader.option("lineSep", f'"{key}"').option("basePath", path).text(path)
    place = ["_metadata.file_path AS file", "_metadata.file_block_start AS block"]
    return pieces.selectExpr("*", *place, "monotonically_increasing_id() AS at").withColumn("is_record", F.expr(r"value RLIKE '^\\s*:'"))


def parsed(pieces: DataFrame, key: str, schema: str) -> DataFrame:
    """Records as the struct ``record``; ``broken`` tells those that are no whole object, as where a file was cut off."""
    return with_record(pieces.where("is_record"), key, schema)


def with_record(pieces: DataFrame, key: str, schema: str) -> DataFrame:
    """As :func:`parsed`, but what stands before the first record stays, as a broken one."""
    options = {"columnNameOfCorruptRecord": "_broken"}
    text = F.concat(F.lit(f'{{"{key}"'), F.col("value"))
    records = pieces.withColumn("record", F.from_json(text, f"{schema}, _broken string", options))
    return records.withColumn("broken", ~F.col("is_record") | F.col("record").isNull() | F.col("record._broken").isNotNull())
