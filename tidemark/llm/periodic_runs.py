"""Periodic runs of words by string synchronising sets."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import query, table

#: Least length of a run, and how many times its period it is at least.
LEAST, TIMES = 6, 4
#: Bytes of texts that are searched together; a longer text is searched alone.
GATHER = 1 << 22
_NONE = np.uint64(2**64 - 1)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive entries, from running minima of blocks; entries past the end count as largest."""
    blocks = -(-(len(x) + width) // width)
    padded = np.full(blocks * width, _NONE)
    padded[: len(x)] = x
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(x)], ahead[width - 1 : width - 1 + len(x)])


def synchronising(names: np.ndarray, periodic: np.ndarray, scale: int) -> np.ndarray:
    """Positions that the words around them alone select.

    ``names`` holds a hash of the ``scale`` words from each position on. A position is selected if the least name from
    it to ``scale`` positions on is at one of the two ends, so equal stretches of 2 * ``scale`` words agree on it.
    Positions in highly periodic regions have no name; every other stretch of ``scale`` positions has a selected one.
    """
    named = np.where(periodic, _NONE, names)
    least = window_min(named, scale + 1)
    far = np.full(len(named), _NONE)
    far[:-scale] = named[scale:]
    return np.flatnonzero((least < _NONE) & ((least == named) | (least == far)))


def proposals(contexts: np.ndarray, at: np.ndarray, scale: int) -> list[tuple[int, int, int]]:
    """(period, first position, last position) of chains of selected positions whose equal contexts recur at one distance."""
    order = np.argsort(contexts, kind="stable")
    where, context = at[order], contexts[order]
    distance = np.diff(where)
    pair = np.flatnonzero((context[1:] == context[:-1]) & (distance >= scale) & (distance < 2 * scale))
    if not len(pair):
        return []
    start, period = where[pair], distance[pair]
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    # two pairs at most 2 * scale apart share a whole period, so they lie in one stretch
    cut = np.flatnonzero((period[1:] != period[:-1]) | (start[1:] - start[:-1] > 2 * scale)) + 1
    first, last = np.r_[0, cut], np.r_[cut, len(start)] - 1
    return list(zip(period[first].tolist(), start[first].tolist(), start[last].tolist(), strict=True))


def reach(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix, compared in growing blocks."""
    done, block, most = 0, 64, min(len(a), len(b))
    while done < most:
        unequal = np.flatnonzero(a[done : min(done + block, most)] != b[done : min(done + block, most)])
        if len(unequal):
            return done + int(unequal[0])
        done, block = min(done + block, most), 2 * block
    return most


def stretch(words: np.ndarray, period: int, first: int, last: int) -> tuple[int, int]:
    """The longest stretch around ``first`` to ``last`` in which words a period apart are equal."""
    end = last + period + reach(words[last:], words[last + period :])
    start = first - reach(words[:first][::-1], words[: first + period][::-1])
    return start, end


def smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Whether no smaller period holds; a smaller one divides it, as the stretch is at least twice as long."""
    once = words[start : start + 2 * period]
    rest, prime = period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            part = period // prime
            if np.array_equal(once[part:], once[:-part]):
                return False
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return True


def equal_words(words: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches of at least ``TIMES`` equal words: the periodic regions of period one, found apart."""
    change = np.flatnonzero(words[1:] != words[:-1]) + 1
    start, end = np.r_[0, change], np.r_[change, len(words)]
    long = end - start >= TIMES
    return [(s, e, 1) for s, e in zip(start[long].tolist(), end[long].tolist(), strict=True)]


def covered(n: int, runs: list[tuple[int, int, int]], scale: int, where: np.ndarray) -> np.ndarray:
    """Positions whose next ``scale`` words have a period of at most ``scale / TIMES``: they lie within a run of it."""
    change = np.zeros(n + 1, np.int64)
    for start, end, period in runs:
        if period * TIMES <= scale <= end - start:
            low, high = np.searchsorted(where, (start, end - scale + 1))
            change[low] += 1
            change[high] -= 1
    return np.cumsum(change[:-1]) > 0


def find_runs(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of at least ``TIMES`` periods in texts laid end to end.

    ``words`` are numbers, one per different word; each text is followed by a number of its own, so no two stretches
    across a border are equal. At scale t = 1, 2, 4, ... periods from t to 2 t are sought among the texts of at least
    ``TIMES`` t words. A run of period q there is at least 4 q long, so its first 3 t - 1 words have no period of t / 4 or
    less, some of their first t positions are selected, and the same positions one period on are selected with
    the same 2 t words behind them; nearer ones cannot have these, as 2 t > q. So every run is proposed. A proposal is
    checked word by word: it is stretched as far as it goes and kept if long enough and if no smaller period holds.
    """
    runs = equal_words(words)
    names, where, scale = mix(words.astype(np.uint64) + _ODD[0]), np.arange(len(words)), 2
    while True:
        # names of twice as many words, then only the texts that are long enough
        half = scale // 2
        shifted = np.full(len(names), _ODD[1])
        shifted[:-half] = names[half:]
        names = mix(names * _ODD[0] + mix(shifted + _ODD[1]))
        long = lengths >= TIMES * scale
        if not long.any():
            return runs
        keep = np.repeat(long, lengths + 1)
        if not keep.all():
            names, where = names[keep], where[keep]
            starts, lengths = starts[long], lengths[long]
        at = synchronising(names, covered(len(names), runs, scale, where), scale)
        at = at[at + 2 * scale <= len(names)]
        contexts = mix(names[at] * _ODD[0] + names[at + scale])
        for period, first, last in proposals(contexts, at, scale):
            first, last = int(where[first]), int(where[last])
            last_end = last + 2 * scale
            if not np.array_equal(words[first:last_end], words[first + period : last_end + period]):
                continue
            start, end = stretch(words, period, first, last)
            if end - start >= TIMES * period and smallest(words, start, period):
                runs.append((start, end, period))
        scale *= 2


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Per text of words its runs (start, length, period) by start, then period; the texts are searched together."""
    numbers: dict[bytes, int] = {}
    flat: list[int] = []
    for k, text in enumerate(texts, 1):
        flat.extend(numbers.setdefault(word, len(numbers)) for word in text)
        flat.append(-k)
    lengths = np.array([len(text) for text in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end, period in set(find_runs(np.array(flat, np.int64), starts, lengths)) if texts else ():
        if end - start >= LEAST:
            text = int(np.searchsorted(starts, start, "right")) - 1
            found[text].append((start - int(starts[text]), end - start, period))
    return [sorted(runs) for runs in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those after the first period of a run that holds them."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def planted(words: list[bytes], doc_id: object) -> list[bytes]:
    """Every tenth text, by the hash of its id, repeats a stretch up to its end; a null id leaves the text as it is."""
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


FIELDS = (
    [("n_runs", T.LongType())]
    + [(name, T.LongType()) for name in ("start", "length", "period", "exponent_milli")]
    + [("runs_sha256", T.StringType()), ("collapsed_sha256", T.StringType()), ("runs", T.ArrayType(T.ArrayType(T.LongType())))]
)


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``GATHER`` bytes of text, or one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    first = held = 0
    for k, size in enumerate(sizes):
        if k > first and held + size > GATHER:
            yield batch.slice(first, k - first)
            first = k
            held = 0
        held += size
    if first < len(sizes):
        yield batch.slice(first)


def _described(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    milli = best and 1000 * best[1] // best[2]
    rest = b" ".join(collapsed(words, runs))
    return len(runs), *(best or (None,) * 3), milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest).hexdigest(), runs


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """One row per text: id, ``n_runs``, the run of greatest exponent, both digests, and all ``runs``.

    Words are what ASCII white space parts. A run is a stretch of at least ``LEAST`` words and ``TIMES`` of its smallest
    period that no neighbouring word extends. ``runs`` holds (start, length, period) by start, then period; ties of the
    exponent go to the smallest start, then period. ``plant`` first makes every tenth text periodic, by its id.
    Null, empty and blank texts have no words and no run; repeated rows each give a row; a null id stays null, and any
    id comes back unchanged, as it never leaves Arrow; long texts are searched whole and alone; an empty table
    gives an empty result; other columns are not read.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *[T.StructField(n, t) for n, t in FIELDS]])
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(pa.list_(pa.int64()))]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(blocks, batches)):
            texts = [(text or b"").split() for text in batch.column(1).to_pylist()]
            if plant:
                texts = [planted(words, doc_id) for words, doc_id in zip(texts, batch.column(2).to_pylist(), strict=True)]
            rows = [_described(words, runs) for words, runs in zip(texts, runs_of(texts), strict=True)]
            made = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    columns = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("_text"), F.col(id_col).cast("string").alias("_key"))
    return columns.mapInArrow(find, schema)


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True).drop("runs")
