"""Near-duplicate embeddings by random-hyperplane sign hashing in several tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import components, query, table
from tidemark.staging import Staging

#: Least cosine of a link, chance that a pair just at it meets in no table, vectors of a bucket on average.
COSINE, MISS, BUCKET, SEED = 0.93, 1e-4, 4096, 11
#: Vectors of a block that are compared by all components, and how many times more by sketch; signs of a sketch, and how
#: many standard deviations more of them than expected may differ.
BLOCK, SKETCHED, SIGNS, SURE = 1024, 8, 128, 5.5


def plan_tables(vectors: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Bits of a code and number of tables for so many vectors of one label.

    Two vectors at the given cosine share a bit with probability 1 - angle / pi. More vectors take longer codes,
    and longer codes take more tables, so that the chance to miss a pair stays the same.
    """
    bits = max(1, round(log2(max(1, vectors) / BUCKET))) if vectors > BUCKET else 1
    same = (1 - acos(min(1.0, cosine)) / pi) ** bits
    return bits, max(1, ceil(log(miss) / log(1 - same)))


def usable(vector: Column) -> Column:
    """No null, not all zero, and every component there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: pd.Series) -> np.ndarray:
    """Vectors of one length as rows of norm 1, in double precision and safe from overflow."""
    rows = np.array(vectors.tolist(), np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def most_differing(cosine: float) -> int:
    """Signs that a pair at the given cosine differs in at most, almost surely."""
    differ = acos(min(1.0, cosine)) / pi
    return min(SIGNS, ceil(SIGNS * differ + SURE * sqrt(SIGNS * differ * (1 - differ))))


def with_codes(reps: DataFrame, bits: int, tables: int) -> DataFrame:
    """Add ``codes``, for each table the signs of ``bits`` random projections in four bytes, and ``sketch``, ``SIGNS`` more signs."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            codes, sketch = (pd.Series([None] * len(part), index=part.index, dtype=object) for _ in range(2))
            for size, same in part.groupby("size"):
                planes = np.random.default_rng([SEED, int(size)]).standard_normal((int(size), tables * bits + SIGNS))
                signs = unit(same["vector"]) @ planes > 0
                found = (signs[:, : tables * bits].reshape(len(same), tables, bits) * (1 << np.arange(bits, dtype=np.int64))).sum(2)
                codes[same.index] = [row.tobytes() for row in found.astype("<u4")]
                sketch[same.index] = [row.tobytes() for row in np.packbits(signs[:, tables * bits :], axis=1)]
            yield part.assign(codes=codes, sketch=sketch)

    more = [T.StructField(name, T.BinaryType()) for name in ("codes", "sketch")]
    return reps.mapInPandas(run, T.StructType([*reps.schema.fields, *more]))


BUCKETED = ["label", "size", "t", "code"]
GROUP = [*BUCKETED, "low", "high"]


def in_tables(coded: DataFrame, tables: int, columns: list[str]) -> DataFrame:
    """One row per vector and table, with its code there."""
    each = coded.select(*columns, "label", "size", "codes", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("t"))
    return each.withColumn("code", F.expr("substring(codes, 4 * t + 1, 4)"))


def blocks(staging: Staging, rows: DataFrame, block: int) -> DataFrame:
    """Rows of :func:`in_tables`, once for each pair of blocks of their bucket.

    A bucket of more than ``block`` vectors is dealt into blocks by hash, and each pair of its blocks becomes a
    group of its own, so no group has more than some ``2 * block`` rows, however many vectors share a bucket.
    """
    large = staging.freeze(rows.groupBy(*BUCKETED).count().where(F.col("count") > block), "large").select(
        *[F.col(c).alias(f"_{c}") for c in BUCKETED], F.ceil(F.col("count") / block).cast("int").alias("parts")
    )
    joined = rows.join(large, [F.col(c) == F.col(f"_{c}") for c in BUCKETED], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = joined.withColumn("own", F.pmod(F.xxhash64("rep", "t"), F.col("parts")).cast("int"))
    paired = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return paired.select(*rows.columns, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") <= F.col("other")).alias("first"))


def halves(group: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The two blocks of a group; twice the same where it is one block."""
    if group["low"].iloc[0] == group["high"].iloc[0]:
        return group, group
    return group[group["first"]], group[~group["first"]]


def met_before(first: pd.DataFrame, second: pd.DataFrame, i: np.ndarray, j: np.ndarray, t: int) -> np.ndarray:
    """Whether the pairs (i, j) share a code in an earlier table."""
    codes_a, codes_b = (np.frombuffer(b"".join(half["codes"]), "<u4").reshape(len(half), -1) for half in (first, second))
    met = np.zeros(len(i), bool)
    for k in range(t):
        met |= codes_a[i, k] == codes_b[j, k]
    return met


def suspects_in(group: pd.DataFrame, most: int) -> pd.DataFrame | None:
    """Vectors of a group that have, by their sketches, a near one in it which they met in no earlier table."""
    first, second = halves(group)
    if not len(first) or not len(second):
        return None
    a, b = (np.frombuffer(b"".join(half["sketch"]), np.uint64).reshape(-1, SIGNS // 64) for half in (first, second))
    t, found_a, found_b = int(group["t"].iloc[0]), np.zeros(len(first), bool), np.zeros(len(second), bool)
    for k in range(0, len(a), 512):
        differ = sum(np.bitwise_count(a[k : k + 512, None, w] ^ b[None, :, w]).astype(np.int16) for w in range(SIGNS // 64))
        near = differ <= most
        if first is second:
            near[np.arange(len(near)), np.arange(k, k + len(near))] = False
        i, j = np.nonzero(near)
        if len(i):
            new = ~met_before(first.iloc[k : k + 512], second, i, j, t)
            found_a[k + i[new]] = True
            found_b[j[new]] = True
    reps = first["rep"].to_numpy()[found_a | found_b] if first is second else np.r_[first["rep"].to_numpy()[found_a], second["rep"].to_numpy()[found_b]]
    return pd.DataFrame({"rep": reps, "t": t}) if len(reps) else None


def compare(group: pd.DataFrame, cosine: float) -> pd.DataFrame | None:
    """Links in one group: per vector the weight it links with, and a star of every connected set.

    A pair counts only in the first table in which it meets, so counts of different tables add up.
    """
    first, second = halves(group)
    if not len(first) or not len(second):
        return None
    left = unit(first["vector"])
    close = (left @ (left if second is first else unit(second["vector"])).T) >= cosine
    if second is first:
        np.fill_diagonal(close, False)
    if not close.any():
        return None
    i, j = np.nonzero(close)
    new = ~met_before(first, second, i, j, int(group["t"].iloc[0]))
    a, b = first["rep"].to_numpy(), second["rep"].to_numpy()
    counts = [(a, np.bincount(i[new], second["weight"].to_numpy()[j[new]], len(a)))]
    if second is not first:
        counts.append((b, np.bincount(j[new], first["weight"].to_numpy()[i[new]], len(b))))
    # smallest neighbour again and again, until no label changes
    label_a, label_b = a.copy(), b if second is not first else None
    while True:
        far = label_a if second is first else label_b
        next_a = np.minimum(label_a, np.where(close, far[None, :], np.iinfo(np.int64).max).min(1))
        if second is first:
            changed, label_a = (next_a != label_a).any(), next_a
        else:
            next_b = np.minimum(label_b, np.where(close, next_a[:, None], np.iinfo(np.int64).max).min(0))
            changed = (next_a != label_a).any() or (next_b != label_b).any()
            label_a, label_b = next_a, next_b
        if not changed:
            break
    found = [pd.DataFrame({"a": ids, "b": pd.NA, "links": n.astype(np.int64)})[n > 0] for ids, n in counts]
    for ids, marks in ((a, label_a), (b, label_b)):
        if marks is not None:
            found.append(pd.DataFrame({"a": ids, "b": marks, "links": 0})[ids != marks])
    out = pd.concat(found)
    return out.assign(b=out["b"].astype("Int64")) if len(out) else None


def over_groups(grouped: DataFrame, each: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """``each`` over all groups; a group that spans two Arrow batches is held over."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in parts:
            part = part if held is None else pd.concat([held, part], ignore_index=True)
            number = np.cumsum(np.any([(part[k] != part[k].shift()).to_numpy() for k in GROUP], axis=0))
            last = int(np.searchsorted(number, number[-1])) if len(number) else 0
            held = part.iloc[last:]
            yield from found_in(part.iloc[:last], number[:last])
        if held is not None and len(held):
            yield from found_in(held, np.zeros(len(held), int))

    def found_in(part: pd.DataFrame, number: np.ndarray) -> Iterator[pd.DataFrame]:
        edges = np.flatnonzero(np.diff(number)) + 1
        made = [each(part.iloc[i:j]) for i, j in zip(np.r_[0, edges], np.r_[edges, len(part)], strict=True) if j - i > 1]
        made = [m for m in made if m is not None]
        if made:
            yield pd.concat(made)

    return grouped.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInPandas(run, schema)


def near_duplicates(staging: Staging, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Vectors of one label and length are compared. Equal vectors (by a 128-bit hash) become one weighted
    representative first. Representatives meet in the tables' buckets twice: with short sketches alone, which tell who
    has a near one there that it met in no earlier table, and then these with their vectors, where every pair that meets
    is verified by its exact cosine. So a vector is shipped only where it may have a new link. No bucket, partner or
    link is capped, and pairs never leave their task. A pair just at the
    threshold is missed with probability ``MISS``; closer pairs less. A component's id is its smallest id.
    A vector that is null, zero or holds a null or non-finite component, or whose label is null, links with
    nothing. Repeated rows count as vectors of their own. A null id is never kept. An empty table gives an empty
    result; other columns are not read.
    """
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    rows = rows.withColumn("usable", usable(F.col("vector")) & F.col("label").isNotNull())
    rows = rows.withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(SEED), "vector"), "size": F.size("vector")})
    rows = staging.freeze(rows, "vectors")
    reps = rows.where("usable").groupBy("label", "size", "k1", "k2").agg(F.min("row").alias("rep"), F.count("*").alias("weight"), F.min("id").alias("least"), F.first("vector").alias("vector"))
    reps = staging.freeze(reps, "representatives")
    most = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(most, cosine)
    coded = staging.freeze(with_codes(reps.select("rep", "weight", "label", "size", "vector"), bits, tables), "coded")
    sketched = blocks(staging, in_tables(coded, tables, ["rep", "sketch"]), SKETCHED * block)
    most_signs = most_differing(cosine)
    suspects = over_groups(sketched, lambda group: suspects_in(group, most_signs), "rep long, t int").distinct()
    suspects = staging.freeze(suspects.select(F.col("rep").alias("_rep"), F.col("t").alias("_t")), "suspects")
    held = in_tables(coded, tables, ["rep"]).select("rep", "t", "label", "size", "code")
    held = held.join(suspects, (F.col("rep") == F.col("_rep")) & (F.col("t") == F.col("_t"))).drop("_rep", "_t", "label", "size")
    held = held.join(coded.select("rep", "weight", "label", "size", "vector", "codes"), "rep")
    found = staging.freeze(over_groups(blocks(staging, held, block), lambda group: compare(group, cosine), "a long, b long, links long"), "links")
    parts = components(staging, found.where("b IS NOT NULL").select("a", "b"))
    links = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    info = reps.select("label", "size", "k1", "k2", "rep", "weight", "least")
    info = info.join(links, F.col("rep") == F.col("a"), "left").drop("a")
    info = info.join(parts, F.col("rep") == F.col("node"), "left").drop("node").withColumn("component", F.coalesce("component", "rep"))
    info = staging.freeze(info, "info")
    least = info.groupBy(F.col("component").alias("_component")).agg(F.min("least").alias("component_id"))
    info = info.join(least, F.col("component") == F.col("_component"))
    info = staging.freeze(info.select(*[F.col(c).alias(f"_{c}") for c in ("label", "size", "k1", "k2")], "weight", "links", "component_id"), "decided")
    same = [F.col(c) == F.col(f"_{c}") for c in ("label", "size", "k1", "k2")]
    linked = rows.where("usable").select("id", "label", "size", "k1", "k2").join(info, same)
    linked = linked.select("id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), "component_id")
    alone = rows.where(~F.col("usable")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


@query("op4_embedding_dedup")
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(Staging(spark), table(spark, sf_dir, "embeddings"))
