"""Exact deduplication in two passes over a Bloom filter."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import query, table
from tidemark.staging import Staging

SPACES = r"[\x20\x09-\x0D]+"
#: Filter bits per row, positions per row, and the most bits of a filter: 2**28 bits are at most some 200 MB as a broadcast
#: table. One position in twice the bits lets as few rows through by chance as two (3 %), and shuffles half as much.
BITS_PER_ROW, POSITIONS, MOST_BITS = 32, 1, 2**28


def text_key(text: Column) -> Column:
    """SHA-256 of the text with each run of ASCII white space as one space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "), 256)


def positions(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits)) for seed in range(POSITIONS)]


def repeat_filter(keys: DataFrame, bits: int) -> DataFrame:
    """First pass: bits that more than one row sets, as rows (word, bits) of 64 bits each.

    Every row sets ``POSITIONS`` bits. Counts are combined before the shuffle, so a task sends one row for each position that
    its texts set, one a document at most and fewer where texts repeat. The table has at most ``bits / 64`` rows.
    """
    hits = keys.select(F.explode(F.array(*positions(F.col("text_sha256"), bits))).alias("at"))
    again = hits.groupBy("at").agg(F.count("*").alias("n")).where("n > 1")
    words = again.groupBy(F.expr("at div 64").alias("word"))
    return words.agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits"))


def possibly_repeated(keys: DataFrame, flags: DataFrame, bits: int) -> DataFrame:
    """Second pass: add ``repeated``, true when all bits of a row are set in the filter, which is broadcast."""
    found = F.lit(True)
    for k, at in enumerate(positions(F.col("text_sha256"), bits)):
        part = F.broadcast(flags.select(F.col("word").alias(f"_word{k}"), F.col("bits").alias(f"_bits{k}")))
        keys = keys.withColumn(f"_at{k}", at)
        keys = keys.join(part, F.expr(f"_at{k} div 64 = _word{k}"), "left")
        found = found & F.expr(f"coalesce(getbit(_bits{k}, cast(_at{k} % 64 as int)), 0) = 1")
    return keys.withColumn("repeated", found)


def _decide(staging: Staging, shared: DataFrame, id_col: str) -> DataFrame:
    """Add ``keep_id``, ``group_size`` and ``kept`` to rows with ``row`` and ``text_sha256``.

    The groups are written, so the join back is one between two plain exchanges, whose hot keys adaptive execution
    splits over tasks.
    """
    first = F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("row").alias("first_row")))
    groups = shared.groupBy(F.col("text_sha256").alias("_key")).agg(first.alias("_first"), F.count("*").alias("group_size"))
    joined = shared.join(staging.freeze(groups, "groups"), F.col("text_sha256") == F.col("_key"))
    return joined.select(
        "row", id_col, F.col("_first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("_first.first_row")).alias("kept"), "text_sha256"
    )


def _two_passes(staging: Staging, keyed: DataFrame) -> DataFrame:
    """Written rows with ``repeated`` from a filter over their ``text_sha256``."""
    bits = min(MOST_BITS, 2 ** max(16, math.ceil(math.log2(max(1, keyed.count()) * BITS_PER_ROW))))
    flags = staging.freeze(repeat_filter(keyed, bits), "filter")
    return possibly_repeated(keyed, flags, bits)


def exact_duplicates(staging: Staging, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``row``, id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are the same after white space is normalised; SHA-256 stands for the text. The row
    with the smallest id stays; among rows of one id (repeated rows) the first written stays, and a null id comes
    after all others. Rows whose bits no other row sets pass straight through. Only the others shuffle, and as
    keys and ids only. A false positive shuffles and is found alone, so the result does not depend on the filter;
    beyond ``MOST_BITS / BITS_PER_ROW`` rows more rows take that way.
    An empty table gives an empty result; null and empty texts are one group; no other column is read.
    """
    keys = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), text_key(F.col(text_col)).alias("text_sha256"))
    tested = _two_passes(staging, staging.freeze(keys, "keys"))
    alone = tested.where(~F.col("repeated")).select(
        "row", id_col, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    return alone.unionByName(_decide(staging, tested.where("repeated").select("row", id_col, "text_sha256"), id_col))


def drop_exact_duplicates(staging: Staging, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_duplicates` would drop; all columns stay.

    The rows are written once with their key; texts of rows that are surely alone never shuffle.
    """
    whole = F.struct("*").alias("doc")
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), text_key(F.col(text_col)).alias("text_sha256"), F.col(id_col).alias("_id"), whole)
    tested = _two_passes(staging, staging.freeze(keyed, "keyed"))
    shared = tested.where("repeated")
    gone = _decide(staging, shared.select("row", "_id", "text_sha256"), "_id").where(~F.col("kept")).select(F.col("row").alias("_gone"))
    stay = shared.select("row", "doc").join(gone, F.col("row") == F.col("_gone"), "left_anti")
    return tested.where(~F.col("repeated")).select("doc.*").unionByName(stay.select("doc.*"))


OP6_SQL = r"""
WITH keyed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM keyed WINDOW same AS (PARTITION BY text_sha256)
"""


@query("op6_exact_dedup", OP6_SQL)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    return exact_duplicates(staging, table(spark, sf_dir, "documents")).drop("row")
