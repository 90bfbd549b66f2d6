"""MinHash near-deduplication with an LSH forest."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from math import ceil, log, log1p
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import as_text, components, from_text, query, table
from tidemark.operators.keys import dense_index
from tidemark.staging import Staging

#: Hashes of a signature, least number of orders, and the most of a level.
HASHES, TREES, MOST_ORDERS = 128, 12, 512
#: Documents of a region on average that the first depth is chosen for, most documents of a region that are all compared,
#: by sketch and by full sets, hashes that the next level goes deeper, chance at every level that a pair just at the
#: threshold shares no region.
REGION_ROWS, REGION, EXACT_REGION, DEEPER, MISS = 256, 4096, 512, 3, 1e-5
#: Neighbours compared at once, pairs of sketches held at once, rows of a block where no level is left, orders of the first
#: look at a large cluster.
NEAR, AT_ONCE, BLOCK, FIRST_LOOK = 16, 2**18, 4096, 2
#: How far below the wanted similarity an estimate may be: five standard deviations of one from two bits of each hash.
SLACK = 0.19
#: Most work of one verification group, documents times shingles, and postings gathered at once.
WORK, GATHER = 1_500_000_000, 4_000_000
#: Wanted texts for each 64-bit word of a filter, bits that one sets in its word, and the most words: 2**20 are some 50 MB as
#: a broadcast table.
TEXTS_PER_WORD, TEXT_BITS, MOST_WORDS = 4, 3, 2**20
#: Remembered words, seed.
MEMORY, SEED = 250_000, 20_011


class WordCodes(dict):
    """64-bit code of every word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word, SEED)
        return code


CODES = WordCodes()
FACTORS = np.random.default_rng(SEED).integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct word shingles.

    A-Z is lower-cased; words are parted by ASCII white space. A text with fewer words is one shingle, one without
    words or null has none.
    """
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(CODES.__getitem__, found), np.uint64, len(found))
    size = min(words, len(codes))
    total = np.full(len(codes) - size + 1, size, np.uint64)
    for k in range(size):
        total = mix(total + codes[k : len(codes) - size + 1 + k])
    return np.unique(total)


def signature(hashes: np.ndarray) -> np.ndarray:
    """One byte of each of ``HASHES`` smallest hash values."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        np.minimum(least, (FACTORS[:, None] * hashes[None, at : at + 4096]).min(1), out=least)
    return (mix(least) & np.uint64(0xFF)).astype(np.uint8)


def sketch(found: np.ndarray) -> bytes:
    """Two bits of each hash of a signature, in 32 bytes."""
    low = found & np.uint8(3)
    return (low[0::4] | low[1::4] << np.uint8(2) | low[2::4] << np.uint8(4) | low[3::4] << np.uint8(6)).tobytes()


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many hashes of sketches agree in their bits; ``a`` and ``b`` hold one number per 32 hashes along the first axis."""
    differ = np.uint8(0)
    for left, right in zip(a, b, strict=True):
        bits = left ^ right
        bits |= bits >> np.uint64(1)
        bits &= np.uint64(0x5555555555555555)
        differ = differ + np.bitwise_count(bits)
    return np.uint8(HASHES) - differ


def least_agreeing(percent: int) -> int:
    """Agreeing hashes that a pair at the threshold has almost surely; hashes that differ agree in a quarter of cases."""
    similarity = max(0.0, percent / 100 - SLACK)
    return ceil((similarity + (1 - similarity) / 4) * HASHES)


def described(docs: DataFrame, words: int) -> DataFrame:
    """Rows (row, id, h1, h2, text) to row, id, h1, h2, number of shingles, digest of the set, signature, sketch."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text in part["text"]:
                found = shingles(text, words)
                hashes = signature(found)
                rows.append((len(found), hashlib.md5(found.tobytes()).digest(), hashes.tobytes(), sketch(hashes)))
            yield pd.concat([part.drop(columns="text"), pd.DataFrame(rows, columns=["n", "digest", "signature", "sketch"], index=part.index)], axis=1)
        CODES.clear()

    made = as_text(docs, ["id"]).mapInPandas(run, "row long, id string, h1 long, h2 long, n long, digest binary, signature binary, sketch binary")
    return from_text(made, ["id"], docs)


class Level(NamedTuple):
    """Orders of one depth: a region is the texts that agree in the ``depth`` leading hashes of an order."""

    number: int
    depth: int
    orders: int


def orders_of(depth: int, percent: int) -> int:
    """So many orders that a pair at the threshold shares no region of this depth with chance ``MISS`` at most."""
    same = (percent / 100) ** depth
    return TREES if same >= 1 else max(TREES, ceil(log(MISS) / log1p(-same)))


def plan_levels(texts: int, percent: int) -> list[Level]:
    """The first depth follows the number of texts; every further level is deeper and has as many more orders as that takes.

    The first level takes its hashes out of the signature, so its depth gives way where these are too few.
    """
    wanted = max(2, ceil(log(max(1, texts) / REGION_ROWS, 256)))
    fitting = [d for d in range(wanted, 0, -1) if d * orders_of(d, percent) <= HASHES]
    if not fitting:
        raise ValueError(f"{HASHES} hashes are too few for {percent} %")
    levels = [Level(0, fitting[0], orders_of(fitting[0], percent))]
    while (orders := orders_of(levels[-1].depth + DEEPER, percent)) <= MOST_ORDERS and levels[-1].depth + DEEPER <= HASHES:
        levels.append(Level(len(levels), levels[-1].depth + DEEPER, orders))
    return levels


def in_first_regions(rows: DataFrame, level: Level) -> DataFrame:
    """One row per row and order of the first level: ``t`` and ``region``, from the order's own hashes of the signature."""
    t = F.explode(F.sequence(F.lit(0), F.lit(level.orders - 1))).alias("t")
    own = F.expr(f"substring(signature, t * {HASHES // level.orders} + 1, {level.depth})")
    return rows.select("*", t).withColumn("region", F.xxhash64("scope", own)).drop("signature", "scope", "h1", "h2")


def region_keys(hashes: np.ndarray, level: Level) -> np.ndarray:
    """A number for each order of a deeper level, the same for texts that agree in its ``depth`` least hash values."""
    factors = np.random.default_rng(SEED + level.number).integers(0, 2**63, level.orders * level.depth, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(factors), 256):
        for at in range(0, len(hashes), 4096):
            part = (factors[k : k + 256, None] * hashes[None, at : at + 4096]).min(1)
            np.minimum(least[k : k + 256], part, out=least[k : k + 256])
    key = np.zeros(level.orders, np.uint64)
    for column in least.reshape(level.orders, level.depth).T:
        key = mix(key * np.uint64(3) + column)
    return key.view(np.int64)


def possibly_wanted(contents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``contents`` (h1, h2, text) whose bits the ``wanted`` rows (h1, h2) set in a Bloom filter, which is broadcast.

    All wanted texts are among them, and of the others about one in a hundred, more if ``MOST_WORDS`` bounds the filter; nothing
    but the filter shuffles.
    """
    size = min(MOST_WORDS, wanted.count() // TEXTS_PER_WORD + 1)
    word = F.pmod(F.col("h1"), F.lit(size))
    mask = F.expr(" | ".join(f"shiftleft(1L, cast(shiftright(h2, {6 * k}) & 63 as int))" for k in range(TEXT_BITS)))
    words = wanted.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits"))
    tested = contents.join(F.broadcast(words), word == F.col("_word"))
    return tested.where(F.col("_bits").bitwiseAND(mask) == mask).select("h1", "h2", "text")


def same_content() -> Column:
    """Joins rows with a table of contents."""
    return (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))


def with_texts(rows: DataFrame, contents: DataFrame) -> DataFrame:
    """Rows (h1, h2, ...) with their text; of the texts of one content any will do, and only possibly wanted ones shuffle."""
    texts = possibly_wanted(contents, rows).groupBy(F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).agg(F.first("text").alias("text"))
    return rows.join(texts, same_content()).drop("h1", "h2", "_h1", "_h2")


def with_region_keys(rows: DataFrame, contents: DataFrame, level: Level, words: int) -> DataFrame:
    """Rows with the ``keys`` of a deeper level, made of their texts where these are read: keys shuffle, texts do not."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part = part.drop_duplicates(["h1", "h2"])
            yield pd.DataFrame({"_h1": part["h1"], "_h2": part["h2"], "keys": [region_keys(shingles(text, words), level) for text in part["text"]]})
        CODES.clear()

    made = possibly_wanted(contents, rows).mapInPandas(run, "_h1 long, _h2 long, keys array<long>")
    return rows.join(made.groupBy("_h1", "_h2").agg(F.first("keys").alias("keys")), same_content()).drop("h1", "h2", "_h1", "_h2")


def in_deeper_regions(keyed: DataFrame) -> DataFrame:
    """As :func:`in_first_regions` for the ``keys`` of a deeper level."""
    exploded = keyed.select("*", F.posexplode("keys").alias("t", "key"))
    return exploded.withColumn("region", F.xxhash64("scope", "key")).drop("key", "keys", "scope")


def forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked id with the smallest one it reaches, in place of all links (a, b): fewer links than ids."""
    order = np.argsort(ids)
    known = ids[order]
    i, j = np.searchsorted(known, a), np.searchsorted(known, b)
    marks = np.arange(len(known))
    while True:
        low = np.minimum(marks[i], marks[j])
        after = marks.copy()
        np.minimum.at(after, marks[i], low)
        np.minimum.at(after, marks[j], low)
        after = after[after]
        if (after == marks).all():
            break
        marks = after
    moved = marks != np.arange(len(known))
    return known[moved], known[marks[moved]]


AT = ["t", "region"]
GROUP = [*AT, "low", "high"]


def in_region() -> Column:
    """Joins rows with a table of regions."""
    return (F.col("t") == F.col("_t")) & (F.col("region") == F.col("_region"))


def whole_groups(rows: DataFrame) -> DataFrame:
    """Groups that are compared in full."""
    return rows.select(*AT, F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(True).alias("first"), "node", "sketch")


def neighbours(staging: Staging, rows: DataFrame, most: int) -> DataFrame:
    """Groups of ``most`` rows that follow each other in the sorted sketches of their region.

    Each order sorts the sketches from its own start on, so texts with the longest common prefixes stand together.
    The rows are sorted over ranges and numbered; every row is in two groups, whose borders lie half a group apart.
    """
    start = f"t * {DEEPER} % {HASHES // 4}"
    own = F.expr(f"concat(substring(sketch, {start} + 1), substring(sketch, 1, {start}))")
    placed = dense_index(rows.withColumn("own", own), [*AT, "own", "node"], staging, "at").drop("own", *AT)
    half = max(1, most // 2)
    twice = F.explode(F.array(*[F.struct(F.lit(-1 - k).alias("t"), F.expr(f"(at + {k * half}) div {most}").alias("region")) for k in (0, 1)])).alias("g")
    return whole_groups(placed.select("node", "sketch", twice).select("node", "sketch", "g.*"))


def across(mixed: DataFrame, rows: DataFrame, most: int) -> DataFrame:
    """Groups in which all rows outside a region's largest component meet all rows of it.

    The largest component is dealt into blocks of about ``most`` rows, the few others go into each of them. ``mixed`` has
    node, component, t, region and the region's ``top`` component and number of ``rows``; ``rows`` has the sketches.
    """
    parts = F.ceil(F.col("rows") / most).cast("int")
    own = F.when(F.col("component") == F.col("top"), F.array(F.pmod(F.xxhash64("node"), parts).cast("int"))).otherwise(F.sequence(F.lit(0), parts - 1))
    blocks = mixed.select(*AT, "node", F.explode(own).alias("low")).join(rows.select("node", "sketch"), "node")
    return blocks.select(*AT, "low", F.col("low").alias("high"), F.lit(True).alias("first"), "node", "sketch")


def dealt(mixed: DataFrame, rows: DataFrame, block: int) -> DataFrame:
    """Groups for regions that no level parts: dealt into blocks by hash, each pair of blocks a group, so every two rows meet."""
    parts = mixed.select(*AT, "node", F.ceil(F.col("rows") / block).cast("int").alias("parts"))
    return paired(parts).join(rows.select("node", "sketch"), "node").select(*GROUP, "first", "node", "sketch")


def paired(rows: DataFrame) -> DataFrame:
    """Rows with ``node`` and a number of ``parts``, each with every block that its own block meets."""
    own = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other"), "first": F.col("own") <= F.col("other")})
    return met.drop("parts", "own", "other")


def alike(ids: np.ndarray, keys: np.ndarray, first: np.ndarray, whole: bool, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between documents of one group with at least ``least`` equal hashes, as a forest.

    All of a ``whole`` group are compared, otherwise those of the first block with the others. Pairs that are connected
    already are left out.
    """
    left = np.arange(len(ids)) if whole else np.flatnonzero(first)
    right = left if whole else np.flatnonzero(~first)
    if not len(left) or not len(right):
        return ids[:0], ids[:0]
    others, marks = np.ascontiguousarray(keys[right].T), ids.copy()
    step = max(1, AT_ONCE // len(right))
    for k in range(0, len(left), step):
        rows, begin = left[k : k + step], k if whole else 0
        equal = agreeing(keys[rows].T[:, :, None], others[:, None, begin:])
        i, j = np.nonzero((equal >= least) & (marks[rows][:, None] != marks[right[begin:]][None, :]))
        if len(i):
            names = np.unique(marks)
            moved, to = forest(names, marks[rows[i]], marks[right[begin + j]])
            after = names.copy()
            after[np.searchsorted(names, moved)] = to
            marks = after[np.searchsorted(names, marks)]
    return ids[marks != ids], marks[marks != ids]


def candidates_in(ids: np.ndarray, keys: np.ndarray, number: np.ndarray, first: np.ndarray, whole: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in all groups of a batch, which ``number`` counts up; every pair of a group is compared.

    Groups of up to ``NEAR + 1`` documents are compared together, by places.
    """
    begin = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    size = np.diff(np.r_[begin, len(number)])
    small = np.repeat((size <= NEAR + 1) & whole[begin], size)
    a, b = [], []
    for s in range(1, NEAR + 1):
        i = np.flatnonzero(small[:-s] & (number[s:] == number[:-s]))
        if not len(i):
            break
        i = i[agreeing(keys[i].T, keys[i + s].T) >= least]
        a.append(ids[i])
        b.append(ids[i + s])
    for i, n in zip(begin, size, strict=True):
        if not small[i]:
            ends = alike(ids[i : i + n], keys[i : i + n], first[i : i + n], bool(whole[i]), least)
            a.append(ends[0])
            b.append(ends[1])
    return (np.concatenate(a), np.concatenate(b)) if a else (ids[:0], ids[:0])


def likely_links(groups: DataFrame, percent: int) -> DataFrame:
    """Links between texts of a group that agree in enough hashes; a group that spans two Arrow batches is held over."""
    least = least_agreeing(percent)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in parts:
            part = part if held is None else pd.concat([held, part], ignore_index=True)
            if len(part):
                number = counted(part)
                last = int(np.searchsorted(number, number[-1]))
                held = part.iloc[last:]
                yield from found_in(part.iloc[:last], number[:last])
        if held is not None:
            yield from found_in(held, np.zeros(len(held), np.int64))

    def counted(part: pd.DataFrame) -> np.ndarray:
        keys = part[GROUP]
        return (keys != keys.shift()).any(axis=1).cumsum().to_numpy()

    def found_in(part: pd.DataFrame, number: np.ndarray) -> Iterator[pd.DataFrame]:
        if len(part) > 1:
            keys = np.frombuffer(b"".join(part["sketch"]), np.uint64).reshape(-1, HASHES // 32)
            whole = (part["low"] == part["high"]).to_numpy()
            a, b = candidates_in(part["node"].to_numpy(np.int64), keys, number, part["first"].to_numpy(bool), whole, least)
            yield pd.DataFrame({"a": a, "b": b})

    return groups.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInPandas(run, "a long, b long")


def exact_links(sets: list[np.ndarray], ids: np.ndarray, percent: int, posted_only: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each document with the smallest id that it reaches by links of exact similarity.

    Shared shingles of a document with all others are counted at once over postings. With ``posted_only`` the first so
    many documents are compared with the others, and neither among themselves.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    listed = code if posted_only is None else code[owner < posted_only]
    order = np.argsort(listed, kind="stable")
    posted = owner[order]
    begin = np.r_[0, np.cumsum(np.bincount(listed, minlength=code.max(initial=-1) + 1))]
    first = np.cumsum(np.r_[0, sizes[:-1]])
    parent = np.arange(len(sets))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(posted_only or 0, len(sets)):
        at, size, others = first[i], sizes[i], i if posted_only is None else posted_only
        mine = code[at : at + size]
        shared, low = np.zeros(len(sets), np.int64), begin[mine]
        lengths = begin[mine + 1] - low
        step = max(1, GATHER // len(sets))
        for k in range(0, size, step):
            n, start = lengths[k : k + step], low[k : k + step]
            place = np.arange(n.sum()) + np.repeat(start - np.r_[0, np.cumsum(n)[:-1]], n)
            shared += np.bincount(posted[place], minlength=len(sets))
        linked = np.flatnonzero(100 * shared[:others] >= percent * (size + sizes[:others] - shared[:others]))
        for j in linked:
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(sets))])
    least = np.full(len(sets), np.iinfo(np.int64).max)
    np.minimum.at(least, roots, ids)
    marks = least[roots]
    return ids[marks != ids], marks[marks != ids]


def verified_whole(members: DataFrame, words: int, percent: int) -> DataFrame:
    """Exact components (node, component) in clusters small enough for one group; nodes that link with none are left out."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        nodes, low = exact_links([shingles(t, words) for t in group["text"]], group["node"].to_numpy(), percent)
        return pd.DataFrame({"node": nodes, "component": low})

    return members.select("cluster", "node", "text").groupBy("cluster").applyInPandas(run, "node long, component long")


def exact_group_links(groups: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between texts of a group by their full sets of shingles."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        halved = group["low"].iloc[0] != group["high"].iloc[0]
        group = group.sort_values("first", kind="stable") if halved else group
        a, b = exact_links([shingles(t, words) for t in group["text"]], group["node"].to_numpy(), percent, int((~group["first"]).sum()) if halved else None)
        return pd.DataFrame({"a": a, "b": b})

    return groups.drop("sketch").join(texts, "node").groupBy(*GROUP).applyInPandas(run, "a long, b long")


def merged(staging: Staging, known: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (node, component) of ``known`` ones and further links; only links between components are followed."""
    if known is None:
        return staging.freeze(components(staging, links), "components")
    side = lambda name: known.select(F.col("node").alias(f"_{name}"), F.col("component").alias(f"_{name}_component"))
    ends = links.join(side("a"), F.col("a") == F.col("_a"), "left").join(side("b"), F.col("b") == F.col("_b"), "left")
    ends = ends.select(F.coalesce("_a_component", "a").alias("a"), F.coalesce("_b_component", "b").alias("b")).where("a <> b").distinct()
    ends = staging.freeze(ends, "ends")
    if ends.isEmpty():
        return known
    moved = staging.freeze(components(staging, ends), "moved")
    to = moved.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    renamed = known.join(to, F.col("component") == F.col("_node"), "left").select("node", F.coalesce("_component", "component").alias("component"))
    alone = moved.join(known.select(F.col("node").alias("_known")), F.col("node") == F.col("_known"), "left_anti")
    return staging.freeze(renamed.unionByName(alone), "components")


def with_components(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with the component of their node, which is the node itself where nothing links it."""
    found = known.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    joined = rows.join(found, F.col("node") == F.col("_node"), "left")
    return joined.withColumn("component", F.coalesce("_component", "node")).drop("_node", "_component")


def descend(
    staging: Staging, rows: DataFrame, contents: DataFrame, levels: list[Level], words: int, compare: Callable[[DataFrame], DataFrame], most: int, looks: int | None = None, block: int = BLOCK
) -> DataFrame:
    """Components (node, component) of all texts that ``compare`` links: the LSH forest.

    ``rows`` hold node, h1 and h2 of a text, signature, sketch and a ``scope`` that regions do not cross; ``contents`` has the
    texts. At every level the rows fall into one
    region per order. Of a region of at most ``most`` rows all pairs are compared. Of a larger one, neighbours in the sorted
    order are compared, which connects most copies; then the rows outside its largest component are compared with all of it,
    if these are at most ``most``. Where they are more, the region's rows, and these alone, go on to the next level,
    whose regions are deeper and whose orders are as many more as keep the chance of a miss. Two rows that go on
    different ways never shared a region that was too large, so at their last common level they were compared, or share
    none with chance ``MISS``. What is too large at the last level is compared by all pairs of blocks. So a row is copied
    a few times per order, however large its regions are. With ``looks`` so many orders of the first level are compared first,
    and later ones skip regions of a single component.
    """
    known, active = None, rows
    if looks:
        regions = in_first_regions(rows, levels[0]).where(F.col("t") < looks)
        known, _ = level_components(staging, rows, regions, known, compare, most)
    for level in levels:
        placed = active if known is None else with_components(active, known)
        if not level.number:
            regions = in_first_regions(placed, level)
        else:
            regions = in_deeper_regions(staging.freeze(with_region_keys(placed, contents, level, words), "keyed"))
        known, mixed = level_components(staging, active, regions, known, compare, most)
        if mixed is None:
            return known
        if level != levels[-1]:
            active = staging.freeze(active.drop("signature").join(mixed.select("node").distinct(), "node", "left_semi"), "active")
    return merged(staging, known, staging.freeze(compare(dealt(mixed, rows, block)), "links"))


def level_components(
    staging: Staging, rows: DataFrame, regions: DataFrame, known: DataFrame | None, compare: Callable[[DataFrame], DataFrame], most: int
) -> tuple[DataFrame, DataFrame | None]:
    """Components after one level, and the rows of regions that are still too large for it, None without any.

    ``regions`` have the ``component`` of each node where components are known.
    """
    counted = [F.count("*").alias("rows")] if known is None else [F.count("*").alias("rows"), F.min("component").alias("least"), F.max("component").alias("most")]
    sizes = regions.groupBy(*[F.col(c).alias(f"_{c}") for c in AT]).agg(*counted)
    if known is None:
        sizes = staging.freeze(sizes.where(f"rows > {most}").drop("rows"), "sizes")
        small, large = regions.join(sizes, in_region(), "left_anti"), regions.join(sizes, in_region(), "left_semi")
    else:
        sizes = staging.freeze(sizes.where("least <> most").drop("least", "most"), "sizes")
        held = regions.join(sizes, in_region()).drop("_t", "_region")
        small, large = held.where(f"rows <= {most}"), held.where(f"rows > {most}").drop("rows")
    large = staging.freeze(large.select(*AT, "node", "sketch"), "large")
    crowded = not large.isEmpty()
    groups = whole_groups(small)
    if crowded:
        groups = groups.unionByName(neighbours(staging, large, most))
    known = merged(staging, known, staging.freeze(compare(groups), "links"))
    if not crowded:
        return known, None
    placed = staging.freeze(with_components(large.select(*AT, "node"), known), "placed")
    per = placed.groupBy(*[F.col(c).alias(f"_{c}") for c in AT], "component").agg(F.count("*").alias("n"))
    tops = per.groupBy("_t", "_region").agg(F.max_by("component", "n").alias("top"), F.sum("n").alias("rows"), (F.sum("n") - F.max("n")).alias("others"))
    tops = staging.freeze(tops.where("others > 0"), "tops")
    mixed = staging.freeze(placed.join(tops, in_region()).drop("_t", "_region"), "mixed")
    few = mixed.where(f"others <= {most}")
    known = merged(staging, known, staging.freeze(compare(across(few, rows, most)), "links"))
    left = mixed.where(f"others > {most}")
    return known, None if left.isEmpty() else left


def near_duplicates(staging: Staging, docs: DataFrame, words: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", work: int = WORK, row_col: str | None = None, block: int = BLOCK) -> DataFrame:
    """One row per text: ``row``, id, ``n_shingles``, ``component_id``, ``kept_row``.

    Texts with the same shingle set become one representative. Representatives that the forest brings together and
    whose signatures agree well enough form clusters (:func:`descend`). Within a cluster every pair is compared on its full
    shingle sets, and pairs with ``100 * intersection >= percent * union`` link; a cluster of more than ``work`` descends
    the forest a second time, now with the sets. Only texts of clusters shuffle, and the few that the filter lets through
    with them. No region, cluster or partner is capped. A pair at
    the threshold is missed with a chance of about ``MISS`` a level.
    ``component_id`` is the smallest id reachable, ``kept_row`` true for exactly one row of a component: the one
    with the smallest id, then the first written; a null id comes last. Texts without words and null texts link
    with nothing. Repeated rows are in one component. An empty table gives an empty result; other columns are not
    read. ``row_col`` names a column that numbers the rows; without it they are numbered here.
    """
    text = F.col(text_col)
    content = (F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(SEED), text).alias("h2"))
    number = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(number.alias("row"), F.col(id_col).alias("id"), *content, text.alias("text"))
    rows = staging.freeze(described(rows, words), "described")
    reps = rows.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("id").alias("least"), F.min(F.struct("h1", "h2")).alias("content"), F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("head"),
    )
    reps = staging.freeze(reps, "representatives")
    levels = plan_levels(reps.count(), percent)
    contents = docs.select(*[c.alias(n) for c, n in zip(content, ("h1", "h2"), strict=True)], text.alias("text"))
    in_forest = ["node", "content.h1", "content.h2", "signature", "sketch"]
    likely = lambda groups: likely_links(groups, percent)
    found = descend(staging, reps.select(*in_forest, F.lit(0).cast("long").alias("scope")), contents, levels, words, likely, REGION, block=block)
    clusters = found.select(F.col("node").alias("_node"), F.col("component").alias("cluster"))
    members = staging.freeze(reps.join(clusters, F.col("node") == F.col("_node")).select("node", "cluster", "content", "n", "signature", "sketch"), "members")
    sizes = members.groupBy(F.col("cluster").alias("_cluster")).agg((F.count("*") * F.sum("n")).alias("work"))
    members = staging.freeze(members.join(sizes, F.col("cluster") == F.col("_cluster")).drop("_cluster"), "members")
    small = F.col("work") <= work
    parts = verified_whole(with_texts(members.where(small).select("cluster", "node", "content.h1", "content.h2"), contents), words, percent)
    large = members.where(~small).select(*in_forest, F.col("cluster").alias("scope"))
    if not large.isEmpty():
        texts = staging.freeze(with_texts(large.select("node", "h1", "h2"), contents), "texts")
        exact = lambda groups: exact_group_links(groups, texts, words, percent)
        parts = parts.unionByName(descend(staging, large, contents, levels, words, exact, EXACT_REGION, FIRST_LOOK, block))
    info = reps.select("digest", "node", "least", "head").join(parts.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    info = staging.freeze(info.select("digest", "least", "head", F.coalesce("component", "node").alias("component")), "info")
    least = info.groupBy(F.col("component").alias("_component")).agg(F.min("least").alias("component_id"), F.min("head").alias("best"))
    info = info.join(least, F.col("component") == F.col("_component")).select(F.col("digest").alias("_digest"), "component_id", F.col("best.row").alias("best"))
    info = staging.freeze(info, "decided")
    known = rows.where("n > 0").select("row", "id", "n", "digest").join(info, F.col("digest") == F.col("_digest"))
    known = known.select("row", "id", "n", "component_id", (F.col("row") == F.col("best")).alias("kept_row"))
    empty = rows.where("n = 0").select("row", "id", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept_row"))
    return known.unionByName(empty).withColumnsRenamed({"id": id_col, "n": "n_shingles"})


def drop_near_duplicates(staging: Staging, docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component; all columns stay. Rows are written once, so their numbers hold."""
    numbered = staging.freeze(docs.select(F.monotonically_increasing_id().alias("_number"), F.struct("*").alias("_doc")), "numbered")
    plain = numbered.select(F.col(f"_doc.`{id_col}`").alias("_id"), F.col(f"_doc.`{text_col}`").alias("_text"), "_number")
    found = near_duplicates(staging, plain, words, percent, "_id", "_text", row_col="_number")
    gone = found.where(~F.col("kept_row")).select(F.col("row").alias("_gone"))
    return numbered.join(gone, F.col("_number") == F.col("_gone"), "left_anti").select("_doc.*")


@query("op5_minhash_dedup")
def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(Staging(spark), table(spark, sf_dir, "documents"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
