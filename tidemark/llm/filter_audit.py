"""Filter interaction audit with a counting-Bloom duplicate prepass."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import query, table, tasks
from tidemark.staging import Staging

#: The filters; a failing filter sets the bit of its place.
FILTERS = "ABCDE"
ORDERS = ["".join(letters) for letters in itertools.permutations(FILTERS)]
DUPLICATE = 1 << FILTERS.index("E")
SPACES = r"[\x20\x09-\x0D]+"
#: Counters per row, counters that a row raises, and the most counters: what is broadcast has at most ``MOST_COUNTERS / 64`` rows.
COUNTERS_PER_ROW, RAISED, MOST_COUNTERS = 16, 3, 2**28
#: Words of counters that a task sends on at once, and that one range of the merge holds.
HELD, RANGE = 2**20, 2**14
SKETCH = "word long, seen long, again long"


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, SPACES, -1), "")
    failed = {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }
    return sum((F.when(fails, 1 << FILTERS.index(name)).otherwise(0) for name, fails in failed.items()), F.lit(0)).cast("int")


def merged(word: np.ndarray, seen: np.ndarray, again: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counters of equal words added up, each stopping at two: ``seen`` has the bits of one or more, ``again`` of two or more.

    Neighbours of one word are added in pairs until every word is there once.
    """
    order = np.argsort(word, kind="stable")
    word, seen, again = word[order], seen[order], again[order]
    while len(word) > 1:
        same = word[1:] == word[:-1]
        if not same.any():
            break
        place = np.arange(len(word))
        rank = place - np.maximum.accumulate(np.where(np.r_[True, ~same], place, 0))
        left = np.flatnonzero((rank[:-1] % 2 == 0) & same)
        again[left] |= again[left + 1] | (seen[left] & seen[left + 1])
        seen[left] |= seen[left + 1]
        even = rank % 2 == 0
        word, seen, again = word[even], seen[even], again[even]
    return word, seen, again


def _batches(held: tuple[np.ndarray, ...], names: list[str]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(held[0]), 2**16):
        yield pa.RecordBatch.from_arrays([pa.array(part[k : k + 2**16]) for part in held], names=names)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of a task's rows (word, seen); sent on when ``HELD`` words are held, so memory is bounded."""
    names = ["word", "seen", "again"]
    held = tuple(np.zeros(0, np.int64) for _ in names)
    for batch in batches:
        word, seen = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
        held = merged(*(np.concatenate(pair) for pair in zip(held, (word, seen, np.zeros(len(word), np.int64)), strict=True)))
        if len(held[0]) > HELD:
            yield from _batches(held, names)
            held = tuple(part[:0] for part in held)
    yield from _batches(held, names)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with a counter of two or more, from the sketches of all tasks; holds the words of its ranges alone."""
    held = tuple(np.zeros(0, np.int64) for _ in range(3))
    for batch in batches:
        parts = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        held = merged(*(np.concatenate(pair) for pair in zip(held, parts, strict=True)))
    word, _, again = held
    yield from _batches((word[again != 0], again[again != 0]), ["word", "again"])


def raised(hashed: Column, words: int) -> list[Column]:
    """The word of a row's counters, and their bits in it, from a 64-bit hash of its text."""
    spread, bits = F.xxhash64(hashed), F.lit(0).cast("long")
    for k in range(RAISED):
        at = F.shiftrightunsigned(spread, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return [F.pmod(hashed, F.lit(words)).alias("word"), bits.alias("bits")]


def repeated_counters(staging: Staging, rows: DataFrame, words: int) -> DataFrame:
    """The merged sketch of the rows' ``hash``: rows (word, again), the counters that two or more rows raise.

    A task adds up its own rows first, so at most one entry a row is shuffled and a frequent text is one entry a task.
    The entries of a range of words meet in one task and are added up there as they come.
    """
    entries = rows.select(*raised(F.col("hash"), words)).mapInArrow(_sketch, SKETCH)
    ranges = entries.repartition(tasks(rows), F.expr(f"word div {RANGE}"))
    return staging.freeze(ranges.mapInArrow(_merge, "word long, again long"), "counters")


def with_duplicates(staging: Staging, rows: DataFrame, id_col: str) -> DataFrame:
    """Written ``rows`` with ``duplicate``: whether a row of smaller id has the same text, by ``hash`` and ``key``.

    A row with a counter that no other row raises is the only one of its text and passes straight through. The possible
    repeats, and these alone, are grouped by the SHA-256 of their whole text for its least id, then joined back by text
    and id, so a text in a third of all rows is spread over the tasks by its ids. False alarms are found alone.
    """
    words = min(MOST_COUNTERS, 2 ** max(16, math.ceil(math.log2(max(1, rows.count()) * COUNTERS_PER_ROW)))) // 64
    flags = repeated_counters(staging, rows, words).select(F.col("word").alias("_word"), "again")
    word, bits = raised(F.col("hash"), words)
    tested = rows.withColumns({"word": word, "bits": bits}).join(F.broadcast(flags), F.col("word") == F.col("_word"), "left")
    tested = tested.withColumn("possible", F.coalesce(F.col("again").bitwiseAND(F.col("bits")) == F.col("bits"), F.lit(False)))
    possible = tested.where("possible").select(*rows.columns)
    least = staging.freeze(possible.groupBy(F.col("key").alias("_key")).agg(F.min(id_col).alias("_least")), "least")
    first = (F.col("key") == F.col("_key")) & F.col(id_col).eqNullSafe(F.col("_least"))
    judged = possible.join(least, first, "left").select(*rows.columns, F.col("_key").isNull().alias("duplicate"))
    return tested.where("not possible").select(*rows.columns, F.lit(False).alias("duplicate")).unionByName(judged)


def mask_counts(staging: Staging, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per ``part`` and ``mask`` of failing filters: ``n``, ``good`` and ``toxic``.

    ``part`` is the source, null as the empty name. A document is good or toxic if any label of its id says so. Labels
    join documents that have one; all others are only counted, so the three counts are added up from two sides.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text_failures(text).alias("mask"),
        F.xxhash64(text).alias("hash"),
        F.sha2(text.cast("binary"), 256).alias("key"),
    )
    judged = with_duplicates(staging, staging.freeze(rows, "rows"), "doc_id")
    mask = F.col("mask") + F.when(F.col("duplicate"), DUPLICATE).otherwise(0)
    judged = staging.freeze(judged.select("doc_id", "part", mask.alias("mask")), "judged")
    told = labels.groupBy(F.col("doc_id").alias("_id")).agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    told = judged.join(told.where("good + toxic > 0"), F.col("doc_id") == F.col("_id"))
    nothing = F.lit(0).cast("long")
    counted = judged.groupBy("part", "mask").agg(F.count("*").alias("n")).select("part", "mask", "n", nothing.alias("good"), nothing.alias("toxic"))
    labelled = told.groupBy("part", "mask").agg(F.sum("good").alias("good"), F.sum("toxic").alias("toxic")).select("part", "mask", nothing.alias("n"), "good", "toxic")
    return counted.unionByName(labelled).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def audit(counts: DataFrame) -> DataFrame:
    """All orders of the filters per part, from its at most 32 masks; no document is read again."""
    masks = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = masks.select("part", "masks", F.explode(F.split(F.lit(",".join(ORDERS)), ",")).alias("filter_order"))
    steps = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = lambda at: f"shiftleft(1, instr('{FILTERS}', substr(filter_order, {at}, 1)) - 1)"
    earlier = " | ".join(f"if(step > {k}, {bit(k)}, 0)" for k in range(1, len(FILTERS)))
    steps = steps.withColumn("own", F.expr(bit("step"))).withColumn("earlier", F.expr(earlier))

    def total(value: str, condition: str, name: str) -> Column:
        return F.expr(f"aggregate(filter(masks, m -> {condition}), 0L, (total, m) -> total + {value})").alias(name)

    removed = "m.mask & earlier = 0 and m.mask & own <> 0"
    orderings = math.factorial(len(FILTERS))
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("m.n", "m.mask & (earlier | own) = 0", "kept"),
        total("m.n", removed, "removed"),
        total("m.n", "m.mask & earlier <> 0 and m.mask & own <> 0", "redundant"),
        total("m.n", "m.mask = own", "unique_fails"),
        total("m.good", removed, "good_lost"),
        total("m.toxic", removed, "toxic_lost"),
        # each of a document's failing filters comes first of them in an equal share of all orders
        total(f"m.n * ({orderings} div bit_count(m.mask))", "m.mask & own <> 0", "shapley"),
    )


def filter_audit(staging: Staging, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What every filter removes at every place of every order, per source: 600 rows each, zeros included.

    Null and empty texts are equal, have no words and fail A (and E, but for the least id). A null id comes after all
    others: it fails E if a row with an id has its text, and has no label. Rows that repeat an id count each; none is
    smaller than the other. A null source is the part of the empty name. Of repeated labels of an id any counts, null
    labels never. Long texts are judged whole, an empty table gives no rows, other columns are not read.
    """
    return audit(mask_counts(staging, docs, labels))


OP13_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents
), words AS (
    SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY body) AS least FROM texts
), failing AS (
    SELECT doc_id, part,
           (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
           + 4 * (100 * len(regexp_extract_all(body, '[A-Z]')) > 5 * length(body))::INT
           + 8 * regexp_matches(body, '[#$%&*|]')::INT + 16 * coalesce(least < coalesce(doc_id, least + 1), false)::INT AS mask
    FROM words
), told AS (
    SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic FROM labels GROUP BY doc_id
), counts AS (
    SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM failing LEFT JOIN told USING (doc_id) GROUP BY part, mask
), letters(letter, bit) AS (
    VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
    SELECT [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits, a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
    FROM orders, (SELECT unnest(range(1, 6)) AS step)
)
SELECT part, filter_order, step::INT AS step,
       sum(CASE WHEN mask & (earlier | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN mask & earlier > 0 AND mask & own > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN mask & own > 0 THEN n * (120 // bit_count(mask)) ELSE 0 END)::BIGINT AS shapley
FROM counts, steps GROUP BY part, filter_order, step
"""


@query("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(Staging(spark), table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
