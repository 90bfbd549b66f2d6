"""Parquet tables: layouts, dynamic partition overwrite, retention times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Parts that the rows of a partition are dealt into before they are written.
SPREAD = 16
# Partition columns per layer. Measures have a period and series a year;
# localities have neither, and modelled tables are not partitioned.
LAYOUTS = {"bronze": ["period", "year", "source"], "silver": ["period", "year"], "gold": []}


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    compression: str = "snappy",
    full: bool = False,
) -> int | None:
    """Write a table and return the number of rows written; None for mode ``ignore``, which may write none.

    An overwrite replaces only the partitions present in ``df``; ``full``
    replaces the whole table. Rows are rebalanced by the partition columns, so
    that small partitions make few files and a very large one is split over
    several tasks instead of passing through a single one. A partition is dealt into ``SPREAD`` parts first: Spark
    cannot divide what one task before sends to one part, and small parts are read together.
    """
    columns = partition_by or []
    out = _spread(df, columns) if columns else df
    counted = None if mode == "ignore" else Observation()
    if counted:
        out = out.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode(mode).option("compression", compression)
    if columns:
        writer = writer.partitionBy(*columns)
        writer = writer.option("partitionOverwriteMode", "static" if full else "dynamic")
    writer.parquet(path)
    return counted.get["rows"] if counted else None


def _spread(df: DataFrame, columns: list[str]) -> DataFrame:
    values = [f.name for f in df.schema.fields if f.name not in columns and not f.dataType.simpleString().startswith(("map", "variant"))]
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in values]) if values else F.lit(0), F.lit(SPREAD))
    return df.withColumn("_spread", part).hint("rebalance", *columns, "_spread").drop("_spread")


def layout_of(layer: str, df: DataFrame) -> list[str]:
    """Partition columns of the layer that the table really has."""
    return [c for c in LAYOUTS[layer] if c in df.columns]


# Days to keep per layer; None keeps everything.
RETENTION_DAYS = {"bronze": 90, "silver": 365, "gold": None}


def within_retention(layer: str, as_of: dt.date, column: str = "load_date") -> Column:
    """Whether a row is still inside the retention time of its layer; one without a date is not."""
    days = RETENTION_DAYS[layer]
    if days is None:
        return F.lit(True)
    return F.coalesce(F.col(column) >= F.lit(as_of - dt.timedelta(days=days)), F.lit(False))


def retained(df: DataFrame, layer: str, as_of: dt.date, column: str = "load_date") -> DataFrame:
    """Rows still inside the retention time of their layer."""
    return df.filter(within_retention(layer, as_of, column))
