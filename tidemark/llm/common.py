"""Helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.staging import Staging

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    """Register a query of this package."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's text modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` as text, for the way through pandas, where a null beside large numbers would round them."""
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in columns})


def from_text(df: DataFrame, columns: list[str], like: DataFrame) -> DataFrame:
    """Undo :func:`as_text`: ``columns`` of ``df`` have the types that they have in ``like`` again."""
    return df.withColumns({c: F.col(f"`{c}`").cast(like.schema[c].dataType) for c in columns})


def tasks(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _stars(links: DataFrame) -> bool:
    """Whether each larger end has one link, to a node that is no larger end itself: then components are found."""
    ends = links.select(F.col("a").alias("end"), F.lit(1).alias("up")).unionByName(links.select(F.col("b").alias("end"), F.lit(0).alias("up")))
    seen = ends.groupBy("end").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return seen.where("ups > 1 OR (ups = 1 AND least = 0)").isEmpty()


def components(staging: Staging, edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, component), component the smallest node.

    Alternates two steps until every node links to the smallest one alone: every node hands its larger neighbours to its smallest one,
    then its smaller neighbours to its smallest one. Each step keeps at most as many edges as it got, and the
    smallest neighbour is an aggregate with map-side combining, and it is written, so that the join back is one
    between two plain exchanges: adaptive execution splits the rows of a node with very many edges. Every round is
    written to the shared folder, which cuts the lineage and survives lost executors, and the round before it is deleted.
    Self-links and nulls are ignored; no edges give no rows.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    held = staging.below("components")
    links = held.freeze(links, "links")
    while not _stars(links):
        last, held = held, staging.below("components")
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("hub")).agg(F.least(F.min("b"), F.first("a")).alias("low"))
        least = held.freeze(least, "least")
        large = both.where("b > a").join(least, F.col("a") == F.col("hub")).where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = held.freeze(large.distinct(), "large")
        least = large.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("low"))
        moved = large.join(least, F.col("a") == F.col("hub"))
        links = moved.select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        links = held.freeze(links.where("a <> b").distinct(), "links")
        last.clear()
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component")).distinct()
