"""Language identification by a byte convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import as_text, from_text, query, remainder, table

#: Bytes of a window, size of a byte's vector, filter widths, filters of each width.
WINDOW, SIZE, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 12
#: Training: labelled rows per language, windows of a row, passes, windows of a step, step size.
ROWS_PER_LANG, WINDOWS_PER_ROW, PASSES, STEP, RATE = 1500, 4, 8, 64, 4e-3
#: Windows scored together; small enough to stay in a core's cache.
TOGETHER = 16
UNKNOWN = "und"


@dataclass
class Network:
    """Byte vectors, one filter bank per width with max pooling, and a softmax layer."""

    langs: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, rng: np.random.Generator) -> None:
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.weights = {"bytes": draw(256, SIZE) * 4, "out": draw(FILTERS * len(WIDTHS), len(self.langs)), "bias": np.zeros(len(self.langs), np.float32)}
        for k in WIDTHS:
            self.weights[f"w{k}"], self.weights[f"b{k}"] = draw(k * SIZE, FILTERS), np.zeros(FILTERS, np.float32)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray], np.ndarray]:
        """Largest response of each filter, where it was, and the byte vectors."""
        n = len(windows)
        vectors = self.weights["bytes"][windows]
        flat = vectors.reshape(n, WINDOW * SIZE)
        parts, places = [], {}
        for k in WIDTHS:
            spans = WINDOW - k + 1
            view = np.lib.stride_tricks.as_strided(flat, (n, spans, k * SIZE), (flat.strides[0], 4 * SIZE, 4))
            response = (view.reshape(n * spans, k * SIZE) @ self.weights[f"w{k}"]).reshape(n, spans, FILTERS)
            places[k] = response.argmax(1) if self.training else None
            parts.append(response.max(1) + self.weights[f"b{k}"])
        return np.concatenate(parts, 1), places, flat

    training = False

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        found = []
        for at in range(0, len(windows), TOGETHER):
            pooled, _, _ = self.pooled(windows[at : at + TOGETHER])
            found.append(softmax(np.maximum(pooled, 0) @ self.weights["out"] + self.weights["bias"]))
        return np.concatenate(found)

    def gradients(self, windows: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        n = len(windows)
        pooled, places, flat = self.pooled(windows)
        hidden = np.maximum(pooled, 0)
        error = softmax(hidden @ self.weights["out"] + self.weights["bias"])
        error[np.arange(n), wanted] -= 1
        error /= n
        found = {"out": hidden.T @ error, "bias": error.sum(0), "bytes": np.zeros_like(self.weights["bytes"])}
        back = (error @ self.weights["out"].T) * (pooled > 0)
        for slot, k in enumerate(WIDTHS):
            part = back[:, slot * FILTERS : (slot + 1) * FILTERS]
            span = np.arange(k * SIZE)
            patches = flat[np.arange(n)[:, None, None], places[k][:, :, None] * SIZE + span]
            found[f"w{k}"] = np.einsum("nf,nfs->sf", part, patches)
            found[f"b{k}"] = part.sum(0)
            toward = (part[:, :, None] * self.weights[f"w{k}"].T[None]).reshape(n, FILTERS, k, SIZE)
            read = windows[np.arange(n)[:, None, None], places[k][:, :, None] + np.arange(k)]
            np.add.at(found["bytes"], read, toward)
        return found


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text's bytes, the last one filled up with zeros."""
    count = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(count * WINDOW, b"\0"), np.uint8).reshape(count, WINDOW)


def fit(windows: np.ndarray, wanted: np.ndarray, langs: list[str], seed: int = 7) -> Network:
    """Adam over shuffled windows; half of the windows are cut short, so that short texts are learned too."""
    rng, net = np.random.default_rng(seed), Network(langs)
    net.start(rng)
    net.training = True
    first, second, steps = {}, {}, 0
    for _ in range(PASSES):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), STEP):
            chosen = order[at : at + STEP]
            batch = windows[chosen].copy()
            short = np.where(rng.random(len(batch)) < 0.5, rng.integers(8, WINDOW + 1, len(batch)), WINDOW)
            batch[np.arange(WINDOW)[None] >= short[:, None]] = 0
            steps += 1
            for name, g in net.gradients(batch, wanted[chosen]).items():
                first[name] = 0.9 * first.get(name, 0) + 0.1 * g
                second[name] = 0.999 * second.get(name, 0) + 0.001 * g * g
                scale = RATE * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
                net.weights[name] = (net.weights[name] - scale * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    net.training = False
    return net


def train(
    docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id"
) -> Network | None:
    """Network from labelled rows; None where there are none.

    A hash of id and text, which does not depend on the layout of the files, picks about ``rows_per_lang`` rows of every language, spread over the table; of each,
    ``WINDOWS_PER_ROW`` windows at even distances, and at most twice as many in all. Only these windows go to the
    driver.
    """
    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("row"))
    labelled = labelled.where("lang IS NOT NULL AND length(text) > 0")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    langs = sorted(counts)
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, rows_per_lang / counts[lang]))])
    picked = labelled.where(F.pmod(F.xxhash64("row"), F.lit(2**30)) < share[F.col("lang")] * 2**30)

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for lang, text in zip(part["lang"], part["text"], strict=True):
                found = windows_of(text.encode("utf-8", "replace"))
                at = np.unique(np.linspace(0, len(found) - 1, WINDOWS_PER_ROW).astype(int))
                rows += [(lang, w.tobytes()) for w in found[at]]
            yield pd.DataFrame(rows, columns=["lang", "window"])

    most = 2 * rows_per_lang * len(langs) * WINDOWS_PER_ROW
    cut_windows = picked.select("lang", "text").mapInPandas(cut, "lang string, window binary").limit(most)
    sample = sorted((r["lang"], bytes(r["window"])) for r in cut_windows.collect())
    windows = np.frombuffer(b"".join(w for _, w in sample), np.uint8).reshape(-1, WINDOW)
    number = {lang: i for i, lang in enumerate(langs)}
    return fit(windows, np.array([number[lang] for lang, _ in sample]), langs)


def predict(docs: DataFrame, net: Network | None, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` of every row with ``lang_pred`` and ``score``.

    Every window of the whole text counts, by its number of bytes; the score is the mean probability of the
    language with the largest one. A text that is null or has no letter, and any text without a network, is
    ``und`` with score 0. Of languages with equal probability the first in order wins. Repeated rows get the same
    answer, an empty table an empty result; columns of any other name are not read. Windows are scored a few at a time,
    so a very long text takes little memory.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            named, scores, texts = [UNKNOWN] * len(part), np.zeros(len(part)), part["_text"].tolist()
            used = [i for i, t in enumerate(texts) if t is not None and net is not None and any(map(str.isalpha, t))]
            for held in bunches(used, texts):
                data = [texts[i].encode("utf-8", "replace") for i in held]
                cut = [windows_of(d) for d in data]
                shares = net.probabilities(np.concatenate(cut)).astype(np.float64)
                weight = np.concatenate([np.r_[np.full(len(c) - 1, WINDOW), len(d) - WINDOW * (len(c) - 1)] for c, d in zip(cut, data, strict=True)])
                first = np.cumsum([0, *(len(c) for c in cut[:-1])])
                mean = np.add.reduceat(shares * weight[:, None], first) / np.add.reduceat(weight, first)[:, None]
                for i, row in zip(held, mean, strict=True):
                    named[i], scores[i] = net.langs[int(row.argmax())], round(min(1.0, float(row.max())), 6)
            yield part.drop(columns="_text").assign(lang_pred=named, score=scores)

    narrow = docs.select(*columns, F.col(text_col).alias("_text"))
    schema = "".join(f"`{c}` string, " for c in columns)
    return from_text(as_text(narrow, columns).mapInPandas(run, f"{schema}lang_pred string, score double"), columns, docs)


def bunches(used: list[int], texts: list[str], most: int = 2_000_000) -> Iterator[list[int]]:
    """Neighbouring texts of some ``most`` characters together."""
    held, size = [], 0
    for i in used:
        if held and size + len(texts[i]) > most:
            yield held
            held, size = [], 0
        held.append(i)
        size += len(texts[i])
    if held:
        yield held


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)))
    net = train(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return predict(docs, net, ["doc_id", "held_out"])
