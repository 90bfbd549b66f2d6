"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, table
from tidemark.operators.keys import dense_index, place_in_order
from tidemark.staging import Staging

SHARDS, SEED = 40, 11
#: Fixed value: bytes that a row costs beside its text.
ROW_BYTES = 16


def shuffle_key(id_col: str, seed: int) -> Column:
    """60 bits that put the rows of a source into a seeded random order; a null id counts as empty."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def narrow(docs: DataFrame, row: Column, id_col: str, text_col: str, source: str, seed: int) -> DataFrame:
    """What the sorts need of a row: never its text."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        row.alias("row"),
        F.col(id_col).alias("id"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("stratum"),
        F.col(source).isNull().alias("no_source"),
        shuffle_key(id_col, seed).alias("key"),
    )


def interleaved(staging: Staging, rows: DataFrame, shards: int) -> DataFrame:
    """``shard`` and ``slot`` of rows as :func:`narrow` makes them.

    The rows are sorted by (source, shuffle key) over ranges that cut through a large source. A row's rank in its
    source is its place in its cell (sort task, source) plus the rows of earlier cells, so no task ever holds a
    source, and a source of n rows puts its k-th row at (2 k - 1) / 2 n. A second sort by that fraction interleaves the
    sources; its position times ``shards`` over the number of rows is the shard. Up to any cut each source is within
    half a row of its exact share of that fraction, so a shard is off its proportional count by at most one row plus
    half the number of sources times its share, whatever the size.
    """
    tie = ["key", "text_crc32", "size", "row"]
    placed = place_in_order(staging.freeze(rows, "narrow"), ["stratum", "no_source", *tie], staging, "by_source")
    cell = ["_part", "stratum", "no_source"]
    cells = staging.freeze(placed.groupBy(*cell).agg(F.count("*").alias("n"), F.min("_pos").alias("first")), "cells")
    source = Window.partitionBy("stratum", "no_source")
    earlier = source.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*cell, "first", F.sum("n").over(source).alias("rows"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("_pos") - F.col("first") + 1
    ranked = placed.join(staging.freeze(cells, "ranks"), cell).withColumn("fraction", (2 * rank - 1) / (2 * F.col("rows")))
    ranked = staging.freeze(ranked.select(*rows.columns, "fraction"), "fractions")
    total = max(1, ranked.count())
    at = dense_index(ranked, ["fraction", "stratum", "no_source", *tie], staging, "at")
    at = at.withColumn("shard", F.expr(f"cast(at * {shards} div {total} as int)"))
    return at.withColumn("slot", F.expr(f"at - (shard * {total}L + {shards - 1}) div {shards}"))


def shard_rows(
    staging: Staging, docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", source: str = "source", seed: int = SEED
) -> DataFrame:
    """One row per input row: id, ``size``, ``text_crc32``, ``shard``, ``slot``; shard counts are at most one apart.

    Null and empty texts are rows of no bytes. A null source is a source of its own, beside the empty name. Ties of the
    shuffle (null or repeated ids) go by text hash, then size; rows equal in all of that change places freely, so the
    result is the same. Long texts count whole, an empty table gives an empty result, other columns are not read. With
    fewer rows than shards some shards stay empty.
    """
    rows = narrow(docs, F.monotonically_increasing_id(), id_col, text_col, source, seed)
    found = interleaved(staging, rows, shards)
    return found.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")


def with_shards(
    staging: Staging, docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", source: str = "source", seed: int = SEED
) -> DataFrame:
    """All columns of ``docs`` as the struct ``doc``, beside ``shard`` and ``slot`` as in :func:`shard_rows`."""
    kept = staging.freeze(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "rows")
    flat = kept.select("row", F.col(f"doc.`{id_col}`").alias("_id"), F.col(f"doc.`{text_col}`").alias("_text"), F.col(f"doc.`{source}`").alias("_source"))
    found = interleaved(staging, narrow(flat, F.col("row"), "_id", "_text", "_source", seed), shards)
    return kept.join(found.select("row", "shard", "slot"), "row").select("doc", "shard", "slot")


def write_shards(staging: Staging, docs: DataFrame, path: str, shards: int = SHARDS, **columns) -> None:
    """Write one folder per shard, rows in slot order; a shard larger than a task has several files, in order.

    The columns ``shard`` and ``slot`` replace columns of that name in ``docs``.
    """
    placed = with_shards(staging, docs, shards, **columns)
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    flat = placed.select(*[F.col(f"doc.`{c}`").alias(c) for c in names], "shard", "slot")
    flat = staging.freeze(flat, "placed")
    flat.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


#: The crc32 of a text, byte by byte over the table that the polynomial gives.
OP11_SQL = f"""
WITH poly AS (
    SELECT list(c ORDER BY n) AS steps FROM (
        SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) AS t(n))
), rows AS (
    SELECT doc_id, source, strlen(coalesce(text, '')) + {ROW_BYTES} AS size,
           ('0x' || md5('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:15])::BIGINT AS key,
           xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
               lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS text_crc32
    FROM documents, poly
), ranked AS (
    SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY key, text_crc32, size) - 1) / (2 * count(*) OVER (PARTITION BY source)) AS fraction
    FROM rows
), placed AS (
    SELECT *, count(*) OVER () AS n,
           row_number() OVER (ORDER BY fraction, coalesce(source, ''), source IS NULL, key, text_crc32, size) - 1 AS pos
    FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (pos * {SHARDS} // n)::INT AS shard,
       pos - ((pos * {SHARDS} // n) * n + {SHARDS - 1}) // {SHARDS} AS slot, NULL::INT AS grown_shard
FROM placed
"""


@query("op11_sharding", OP11_SQL)
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard_rows(Staging(spark), table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
