"""Byte-level BPE encoding and decoding with pre-tokenisation by class arrays and transition scans."""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import as_text, from_text, query, table

#: Code point classes. The letters of the contractions are classes of their own.
SEP, SPACE, WHITE, LETTER, NUMBER, OTHER, QUOTE, S, T, R, V, M, L, D, E = range(15)
LETTERS = (LETTER, S, T, R, V, M, L, D, E)
#: States: no token open, a run of letters, of numbers, of others, a space that may join the next run, and the letters left of a contraction.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, LEFT_2, LEFT_1 = range(7)
STATES = 7
#: Symbol of each class before look-ahead.
SYMBOL_OF = np.array([0, 7, 8, 1, 2, 3, 6, 1, 1, 1, 1, 1, 1, 1, 1], np.uint8)
#: Code points scanned at once, positions per block of the scan, most remembered slices, and most bytes of a slice that is merged in plain lists.
CHUNK, BLOCK, MEMORY, SHORT = 1_000_000, 64, 400_000, 64


@cache
def class_table() -> np.ndarray:
    """Class of every code point; surrogates, which no text holds, count as others."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major in "LN":
            kinds[point] = LETTER if major == "L" else NUMBER
    white = [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    kinds[white] = WHITE
    kinds[32] = SPACE
    for letter, kind in zip("'strvmlde", (QUOTE, S, T, R, V, M, L, D, E), strict=True):
        kinds[ord(letter)] = kind
    return kinds


def symbols(kinds: np.ndarray) -> np.ndarray:
    """What a step of the automaton reads at each place: its class and as much of the next two as matters.

    0 separator, 1 letter, 2 number, 3 other, 4 quote of a one-letter contraction, 5 of a two-letter one,
    6 plain quote, 7 a space before a non-space, 8 any other white space.
    """
    read = SYMBOL_OF[kinds]
    spaces = np.flatnonzero(kinds == SPACE)
    following = kinds[np.minimum(spaces + 1, len(kinds) - 1)]
    blank = (following <= WHITE) | (spaces + 1 == len(kinds))
    read[spaces[blank]] = 8
    quotes = np.flatnonzero(kinds == QUOTE)
    if len(quotes):
        tail = np.append(kinds, [SEP, SEP])
        one, two = tail[quotes + 1], tail[quotes + 2]
        read[quotes[np.isin(one, (S, T, M, D))]] = 4
        read[quotes[((one == R) | (one == V)) & (two == E) | (one == L) & (two == L)]] = 5
    return read


@cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Tables by symbol and state: next state, and whether a token starts at this place.

    A white-space run is cut by look-ahead in :func:`starts`; here every white space leaves no open token.
    """
    step, begins = np.zeros((9, STATES), np.uint8), np.ones((9, STATES), bool)
    for state in range(STATES):
        inside = {LEFT_2: LEFT_1, LEFT_1: START}
        for read, run in ((1, IN_LETTERS), (2, IN_NUMBERS), (3, IN_OTHERS), (6, IN_OTHERS), (4, IN_OTHERS), (5, IN_OTHERS)):
            step[read, state] = run
            begins[read, state] = state not in (run, AFTER_SPACE)
            if read in (4, 5) and state not in (IN_OTHERS, AFTER_SPACE):
                step[read, state] = LEFT_1 if read == 4 else LEFT_2
        if state in inside:
            step[1, state], begins[1, state] = inside[state], False
        step[7, state] = AFTER_SPACE
    step[0], step[8] = START, START
    return step, begins


def states_before(read: np.ndarray) -> np.ndarray:
    """State before each place, by a scan of transition functions.

    Away from contractions every function is constant: the state after the place does not depend on the state
    before it. Only a contraction's quote and the two places behind it have others; these, each stretch behind
    its last constant one, are composed by :func:`_scan`.
    """
    step, _ = automaton()
    after = step[read, START]
    quotes = np.flatnonzero((read == 4) | (read == 5))
    if len(quotes):
        places = np.unique(np.concatenate([quotes - 1, quotes, quotes + 1, quotes + 2]))
        places = places[(places >= 0) & (places < len(read))]
        functions = step[read[places]]
        open_ = np.isin(places, np.concatenate([quotes, quotes + 1, quotes + 2]))
        functions[~open_] = after[places[~open_], None]
        before = _scan(functions, np.uint8(START))
        after[places] = functions[np.arange(len(places)), before]
    return np.append(np.uint8(START), after[:-1])


def _scan(functions: np.ndarray, first: np.uint8) -> np.ndarray:
    """State before each of ``functions`` (n, states), when ``first`` comes in.

    Composing functions is associative: blocks are composed side by side, one place of every block at a time; the
    totals of the blocks are scanned the same way; then every place applies its block's incoming state.
    """
    n = len(functions)
    if n <= BLOCK:
        found, state = np.empty(n, np.uint8), first
        for i in range(n):
            found[i], state = state, functions[i, state]
        return found
    blocks = -(-n // BLOCK)
    identity = np.arange(STATES, dtype=np.uint8)
    padded = np.tile(identity, (blocks * BLOCK, 1))
    padded[:n] = functions
    padded = padded.reshape(blocks, BLOCK, STATES)
    before = np.empty((blocks, BLOCK, STATES), np.uint8)
    total = np.tile(identity, (blocks, 1))
    for k in range(BLOCK):
        before[:, k] = total
        total = np.take_along_axis(padded[:, k], total, axis=1)
    incoming = _scan(total, first)
    return np.take_along_axis(before, incoming[:, None, None].astype(np.intp), axis=2)[:, :, 0].reshape(-1)[:n]


def starts(kinds: np.ndarray) -> np.ndarray:
    """True where a token starts. ``kinds`` are classes, texts apart by one separator each.

    A white-space run before a non-space gives up its last place: a space there joins the next token, any other
    white space there stands alone. The rest of a run is one token.
    """
    read = symbols(kinds)
    _, begins = automaton()
    found = begins.reshape(-1)[read.astype(np.intp) * STATES + states_before(read)]
    white = np.flatnonzero((kinds == SPACE) | (kinds == WHITE))
    before = np.append(SEP, kinds[:-1])[white]
    following = np.append(kinds[1:], SEP)[white]
    found[white] = (before == SEP) | (before > WHITE) | (following > WHITE)
    return found | (kinds == SEP)


class Codec:
    """Encoder and decoder by merge ranks, with a bounded memory of encoded slices."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pieces = {rank: piece for piece, rank in self.ranks.items()}
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one slice: merge the adjacent pair of the lowest rank, leftmost first, until none is left."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self._merge_short(piece) if len(piece) <= SHORT else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        rank, none = self.ranks.get, len(self.ranks)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            parts[i : i + 2] = [joined := parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(joined + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + joined, none)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with pairs in a heap and parts in a linked list, so a long slice takes n log n steps."""
        n = len(piece)
        ends, prev, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n

        def pair(i: int):
            j = after[i]
            return self.ranks.get(piece[i : ends[j]]) if j < n else None

        waiting = [(rank, i, ends[after[i]]) for i in range(n) if (rank := pair(i)) is not None]
        heapq.heapify(waiting)
        while waiting:
            rank, i, end = heapq.heappop(waiting)
            if not alive[i] or after[i] >= n or ends[after[i]] != end or pair(i) != rank:
                continue
            j = after[i]
            alive[j], ends[i], after[i] = False, ends[j], after[j]
            if after[i] < n:
                prev[after[i]] = i
            for k in (prev[i], i):
                if k >= 0 and (rank := pair(k)) is not None:
                    heapq.heappush(waiting, (rank, k, ends[after[k]]))
        found, i = [], 0
        while i < n:
            found.append(self.ranks[piece[i : ends[i]]])
            i = after[i]
        return found

    def slice(self, text: str) -> tuple[int, str, bytes]:
        """Number of ids, the ids in decimal, and the bytes that the ids decode to."""
        entry = self.known.get(text)
        if entry is None:
            ids = self.merge(text.encode("utf-8", "surrogatepass"))
            entry = len(ids), " ".join(map(str, ids)), self.decode(ids)
            if len(text) <= 64:
                if len(self.known) >= MEMORY:
                    self.known.clear()
                self.known[text] = entry
        return entry

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.pieces[i] for i in ids])


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Slices of each text. Texts share one class array, each behind a separator."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    lengths = np.array([len(p) for p in points])
    begin = np.cumsum(lengths + 1) - lengths
    kinds = np.zeros(int(lengths.sum()) + len(texts), np.uint8)
    for at, p in zip(begin, points, strict=True):
        kinds[at : at + len(p)] = class_table()[p]
    cuts = np.flatnonzero(starts(kinds))
    first = np.searchsorted(cuts, begin)
    last = np.searchsorted(cuts, begin + lengths)
    for t, at, n, i, j in zip(texts, begin, lengths, first, last, strict=True):
        edges = (cuts[i:j] - at).tolist()
        edges.append(int(n))
        yield [t[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def batches(texts: list[str]) -> Iterator[list[str]]:
    """Neighbouring texts of some ``CHUNK`` code points together; a longer text is a batch of its own."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > CHUNK:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def encode(texts: list[str], path: str) -> Iterator[list[tuple[int, str, bytes]]]:
    """Encoded slices of each text in order."""
    by_slice = codec(path).slice
    for batch in batches(texts):
        for cut in slices(batch):
            yield [by_slice(s) for s in cut]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, ``n_slices``.

    Null and empty texts have no ids and decode to nothing. Special tokens in a text are ordinary text. Repeated
    rows are encoded each; an empty table gives an empty result; other columns are not read. ``path`` names the
    rank file, which every executor opens for itself.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for found in encode(part["text"].fillna("").tolist(), path):
                ids, decoded = " ".join([ids for _, ids, _ in found]), b"".join([x for _, _, x in found])
                rows.append((sum([n for n, _, _ in found]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest(), len(found)))
            yield pd.concat([part[["id"]], pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "n_slices"], index=part.index)], axis=1)

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    made = as_text(narrow, ["id"]).mapInPandas(run, "id string, n_tokens long, ids_sha256 string, decoded_sha256 string, n_slices long")
    return from_text(made, ["id"], narrow).withColumnRenamed("id", id_col)


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
