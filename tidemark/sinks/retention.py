"""Retention: rows past their time leave a table, and at every moment the table can be read."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks import folders
from tidemark.sinks.parquet import layout_of, retained, within_retention, write_table


def survey(df: DataFrame, layer: str, as_of: dt.date, column: str = "load_date") -> DataFrame:
    """One row per partition of a table: its columns, ``rows``, ``kept`` and a ``file`` of it; reads the load date alone.

    Rows are counted by file first: the least of a text would make every task sort all its rows.
    """
    keys = layout_of(layer, df)
    marked = df.select(*keys, within_retention(layer, as_of, column).alias("_kept"), F.col("_metadata.file_path").alias("_file"))
    files = marked.groupBy(*keys, "_file").agg(F.count("*").alias("rows"), F.count_if("_kept").alias("kept"))
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("rows", "kept")]
    return files.groupBy(*keys).agg(*sums, F.min("_file").alias("file"))


def expire(spark: SparkSession, path: str, layer: str, as_of: dt.date, column: str = "load_date") -> int | None:
    """Take the rows past their time out of the table at ``path``; the number of rows kept, or None if all are.

    Partitions that are past their time as a whole are deleted, and never read beyond their load date. Only where a
    partition keeps some rows and loses others is a new version of the table written: beside the old one, which
    readers see until the version's mark is created, and which is deleted last. So whichever step a run dies in,
    the table is whole, before or after, and the next run goes on. A table without any row left is deleted.
    """
    if not folders.exists(spark, path):
        return None
    folders.forget_others(spark, path)
    now = folders.current(spark, path)
    df = spark.read.parquet(now)
    # one row per partition, and these are folders that the driver lists anyway
    found = survey(df, layer, as_of, column).collect()
    losing = [r for r in found if r["kept"] < r["rows"]]
    if not losing:
        return None
    gone = [r for r in losing if not r["kept"] and "=" in folders.folder_of(r["file"]).rsplit("/", 1)[1]]
    left = sum(r["kept"] for r in found)
    if not left:
        folders.delete(spark, path)
    elif len(gone) == len(losing):
        for r in gone:
            folders.delete_uri(spark, folders.folder_of(r["file"]))
    else:
        keys = layout_of(layer, df)
        version = folders.next_version(spark, path)
        folders.delete(spark, version)
        staying = retained(df.where(~_one_of(gone, keys)), layer, as_of, column)
        write_table(staying, version, partition_by=keys, full=True)
        folders.publish(spark, version)
        folders.forget_others(spark, path)
    return left


def _one_of(partitions: list, keys: list[str]) -> Column:
    """Whether a row is in one of the partitions; a condition on partition columns, so their files are not opened."""
    same = [reduce(Column.__and__, [F.col(k).eqNullSafe(F.lit(p[k])) for k in keys]) for p in partitions if keys]
    return reduce(Column.__or__, same, F.lit(False))
