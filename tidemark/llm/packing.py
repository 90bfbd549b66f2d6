"""Best-fit packing of tokenised documents with a swap-based local search."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import as_text, from_text, query, table
from tidemark.staging import Staging

#: Tokens of a sequence, id behind every document, pieces packed together in one task, remembered words.
CAPACITY, END_ID, GROUP, MEMORY = 2048, 0, 8192, 1_200_000
#: Marks that the tokenizer surely parts from letters before them.
MARKS = ".,;:!?|*&%$#)"


class WordIds:
    """Ids of texts as little-endian 32-bit words; each word is encoded once and remembered, up to a bound.

    Words end at ASCII white space, which surely parts them for the tokenizer; other white space is left to it. The
    tokenizer's added tokens are found in the whole text first, as it does itself, so the words between them hold none.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError(f"{path} has added tokens that are not matched as they stand")
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        # words are lower-cased before they are looked up, which must not make an added token of one
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {b"": b""}
        self.memory = memory

    def encode(self, text: str) -> bytes:
        if not any(token in text for token in self.added):
            return self.plain(text)
        return b"".join(self.added[part] if k % 2 else self.plain(part) for k, part in enumerate(self.cuts.split(text)))

    def plain(self, text: str) -> bytes:
        words = text.encode("utf-8", "replace").split()
        new = set(words).difference(self.known)
        if new and len(self.known) + 2 * len(new) > self.memory:
            self.known, new = {b"": b""}, set(words)
        if new:
            self.learn(new)
        return b"".join(map(self.known.__getitem__, words))

    def learn(self, words: set[bytes]) -> None:
        """Encode new words in one call; a word that differs from a known one only by case or by marks behind it is put together."""
        split = {w: parted(w.decode()) for w in words}
        wanted = list({part for parts in split.values() for part in parts}.difference(self.known))
        if wanted:
            found = self.tokenizer.encode_batch([[w.decode() for w in wanted]], is_pretokenized=True, add_special_tokens=False)[0]
            ends = np.cumsum(np.bincount(np.array(found.word_ids, np.int64), minlength=len(wanted))) * 4
            ids = np.array(found.ids, "<u4").tobytes()
            self.known.update((w, ids[i:j]) for w, i, j in zip(wanted, [0, *ends[:-1].tolist()], ends.tolist(), strict=True))
        self.known.update([(w, self.known[a] + self.known[b]) for w, (a, b) in split.items()])


def parted(word: str) -> tuple[bytes, bytes]:
    """Lower-cased word, where that is plain ASCII, and the marks behind its last letter; the tokenizer parts there too."""
    plain = word.lower() if word.isascii() else word
    core = plain.rstrip(MARKS)
    if core and core[-1] < "\u0250" and core[-1].lower()[-1].isalpha():
        return core.encode(), plain[len(core) :].encode()
    return plain.encode(), b""


@cache
def word_ids(path: str, memory: int) -> WordIds:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path, memory)


def pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False, memory: int = MEMORY
) -> DataFrame:
    """Pieces of tokenised texts: ``row``, id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A text's ids end with ``END_ID``. Only a text of more than ``capacity`` ids is cut, into pieces of that length;
    the last one may be shorter. Null and empty texts are one piece of one id. Repeated rows are documents of their own,
    told apart by ``row``; null ids stay null; columns of any other name are not read. Every executor opens the file, and
    a task remembers the ids of up to ``memory`` words (some 150 bytes each).
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = word_ids(path, memory).encode, np.array([END_ID], "<u4").tobytes()
        for part in parts:
            rows = []
            for row, doc_id, text in zip(part["row"], part["id"], part["text"].fillna(""), strict=True):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    rows.append((row, doc_id, k, at // 4, len(cut) // 4, zlib.crc32(cut), cut if with_ids else None))
            yield pd.DataFrame(rows, columns=["row", "id", "piece", "start", "length", "ids_crc32", "ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut = as_text(rows, ["id"]).mapInPandas(run, "row long, id string, piece int, start long, length long, ids_crc32 long, ids binary")
    cut = from_text(cut, ["id"], rows)
    return cut.withColumnRenamed("id", id_col) if with_ids else cut.drop("ids").withColumnRenamed("id", id_col)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items, longest first, each into the fullest bin that still holds it."""
    bins: list[list[int]] = []
    gaps: list[tuple[int, int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[item]
        at = bisect_left(gaps, (size, -1))
        gap, home = gaps.pop(at) if at < len(gaps) else (capacity, len(bins))
        if home == len(bins):
            bins.append([])
        bins[home].append(item)
        if gap > size:
            insort(gaps, (gap - size, home))
    return bins


class Offers:
    """What a bin can give: its items by length, and the lengths of single items and of pairs, sorted.

    Lengths that differ add up to at most the capacity, so there are few of them (63 of 2048) and all pairs are looked at.
    """

    def __init__(self, items: list[int], lengths: list[int]):
        self.items: dict[int, list[int]] = {}
        for item in items:
            self.items.setdefault(lengths[item], []).append(item)
        self.singles = sorted(self.items)
        sizes = self.singles
        both = {a + b: (a, b) for k, a in enumerate(sizes) for b in sizes[k:] if a != b or len(self.items[a]) > 1}
        self.pairs, self.parts = sorted(both), both

    def single(self, most: int) -> tuple[int, list[int]]:
        """The largest item of at most ``most``: its length and itself."""
        at = bisect_right(self.singles, most)
        return (self.singles[at - 1], self.items[self.singles[at - 1]][:1]) if at else (0, [])

    def pair(self, most: int) -> tuple[int, list[int]]:
        """The largest two items of together at most ``most``."""
        at = bisect_right(self.pairs, most)
        if not at:
            return 0, []
        a, b = self.parts[self.pairs[at - 1]]
        return a + b, [self.items[a][0], self.items[b][-1]]


def exchange(target: Offers, donor: Offers, gap: int) -> tuple[list[int], list[int]] | None:
    """Items to take out of ``donor`` and ``target`` so that ``target`` grows most, by at most ``gap``.

    Tries a move, one for one, and two for one. ``donor`` must not be fuller than ``target``: then the sum of
    squared fills grows with every exchange.
    """
    best, out = donor.single(gap)
    found = (out, []) if out else None
    for size in target.singles:
        if best == gap:
            break
        for taken, out in (donor.single(size + gap), donor.pair(size + gap)):
            if taken - size > best:
                best, found = taken - size, (out, target.items[size][:1])
    return found


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search: the emptiest bins give to fuller ones by moves and swaps, until some are empty.

    Every exchange makes a fuller bin fuller, so the sum of squared fills grows and the search ends by itself, when no
    exchange is left. It stops earlier as soon as no packing with fewer bins can exist.
    """
    least = -(-sum(lengths) // capacity)
    fill = [sum(lengths[i] for i in b) for b in bins]
    offers = [Offers(b, lengths) if f < capacity else None for b, f in zip(bins, fill, strict=True)]
    changed = True
    while changed:
        open_ = sorted((k for k in range(len(bins)) if 0 < fill[k] < capacity), key=lambda k: -fill[k])
        if sum(f > 0 for f in fill) <= least or len(open_) < 2:
            break
        changed = False
        for donor in reversed(open_[1:]):
            for target in open_:
                if target == donor or not 0 < fill[donor] <= fill[target] < capacity:
                    continue
                if found := exchange(offers[target], offers[donor], capacity - fill[target]):
                    out, back = found
                    bins[target] = [i for i in bins[target] if i not in back] + out
                    bins[donor] = [i for i in bins[donor] if i not in out] + back
                    offers[target], offers[donor] = Offers(bins[target], lengths), Offers(bins[donor], lengths)
                    moved = sum(lengths[i] for i in out) - sum(lengths[i] for i in back)
                    fill[target], fill[donor], changed = fill[target] + moved, fill[donor] - moved, True
            if not fill[donor]:
                break
    return [b for b in bins if b]


def pack(staging: Staging, cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Rows of ``cut`` (needs ``row``, ``piece``, ``length``) with ``sequence_id`` and ``offset``.

    Pieces are dealt by hash into groups of about ``group`` rows, so no task ever holds more, and each group is
    packed: best fit with the longest first, then :func:`improve`. A group leaves about one sequence part full.
    Full pieces are sequences of their own. Equal lengths keep the order of row and piece, so the result is the
    same on every run. An empty table gives an empty result.
    """
    cut = staging.freeze(cut, "pieces")
    groups = max(1, -(-cut.count() // group))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "row", "piece"], ascending=[False, True, True], ignore_index=True)
        lengths = part["length"].tolist()
        bins = improve(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset = np.empty(len(part), np.int64), np.empty(len(part), np.int64)
        for number, items in enumerate(bins):
            sequence[items] = number
            offset[items] = np.cumsum([0, *(lengths[i] for i in items[:-1])])
        return part[["row", "piece"]].assign(sequence_id=int(part["deal"].iloc[0]) * 2**31 + sequence, offset=offset)

    dealt = cut.select("row", "piece", "length", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("deal"))
    placed = dealt.groupBy("deal").applyInPandas(run, "row long, piece int, sequence_id long, offset long")
    placed = placed.select(F.col("row").alias("_row"), F.col("piece").alias("_piece"), "sequence_id", "offset")
    return cut.join(placed, (F.col("row") == F.col("_row")) & (F.col("piece") == F.col("_piece"))).drop("_row", "_piece")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of packed pieces that carry their ids: little-endian 32-bit words in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    cut = pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pack(Staging(spark), cut).drop("row")
