"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import as_text, from_text, query, remainder, table
from tidemark.staging import Staging

#: Labelled rows of each label to learn from, at most; entries of the learned word list, at most.
ROWS_PER_LABEL, ENTRIES = 8000, 4000
#: Least texts of a learned entry, log-odds of a mild and of a strong one, lengths of stems.
SUPPORT, MILD_ODDS, STRONG_ODDS, STEMS = 4, 1.5, 3.0, (4, 5, 6, 7)
THRESHOLD = 0.3
WORD, CLAUSE = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*"), re.compile(r"[.!?;:|\n]+")
#: Most words whose symbol is remembered.
MEMORY = 300_000

INSULT, MILD, THREAT, TARGET, NEGATION, REPORT, INTENT, OTHER = range(8)
#: Words of the grammar in the languages of the corpus; insults also come from the labels.
WORDS = {
    INSULT: "idiot idiots stupid moron morons loser losers trash scum pathetic worthless disgusting clown dumb imbecile",
    THREAT: "kill hurt destroy beat burn shoot stab strangle töten tuer matar",
    TARGET: "you your you're u du dich dir dein ihr euch tu te toi vous vos tú ti usted ustedes he she they him her them",
    NEGATION: "not no never isn't aren't wasn't don't nicht kein keine nie pas jamais nunca jamás",
    REPORT: "said says say wrote writes claimed called quoted told sagte schrieb dit écrit dijo escribió",
    INTENT: "will going gonna shall werde wirst vais voy must should",
}
#: Insults and threats of several words; a word of a class above stands for its whole class there.
PHRASES = {
    INSULT: ("piece of trash", "piece of garbage", "waste of space", "good for nothing", "shut up", "halt die klappe", "bon à rien", "pedazo de basura"),
    THREAT: ("make you pay", "come after you", "watch your back", "go to hell", "burn in hell", "mach dich fertig"),
}
#: What a clause can give, as numbers that the scorer weighs.
EVENTS = ("insult", "targeted", "negated", "reported", "mild", "threat", "softened")


@dataclass
class Transducer:
    """Finite-state transducer: ``arcs[state][symbol]`` is (next state, tag or None); anything else stays."""

    arcs: dict[int, dict[int, tuple[int, str | None]]]

    def step(self, state: int, symbol: int) -> tuple[int, str | None]:
        known = self.arcs.get(state, {})
        return known.get(symbol) or known.get(-1) or (state, None)


def class_of() -> dict[str, int]:
    """Symbols of the fixed words, and further ones of the words that only phrases know."""
    symbols = {w: symbol for symbol, words in WORDS.items() for w in words.split()}
    for phrase in (p for phrases in PHRASES.values() for p in phrases):
        for word in phrase.split():
            symbols.setdefault(word, 1 + max(OTHER, *symbols.values()))
    return symbols


FIXED = class_of()
SYMBOLS = 1 + max(FIXED.values())


def spelled(symbol: int, tag: str, phrase_tag: str) -> Transducer:
    """Gives ``tag`` at the symbol itself and ``phrase_tag`` where one of its phrases ends.

    A state is the longest beginning of a phrase that has just been read, as in a search for several words at once.
    """
    phrases = {tuple(FIXED[w] for w in phrase.split()) for phrase in PHRASES[symbol]}
    begun = sorted({p[:k] for p in phrases for k in range(len(p))}, key=lambda b: (len(b), b))
    number = {b: k for k, b in enumerate(begun)}

    def after(read: tuple[int, ...]) -> tuple[int, str | None]:
        ends = any(read[-len(p) :] == p for p in phrases)
        state = next(number[read[k:]] for k in range(len(read) + 1) if read[k:] in number)
        return state, phrase_tag if ends else tag if read[-1] == symbol else None

    return Transducer({number[b]: {**{s: after((*b, s)) for s in range(SYMBOLS)}, -1: (0, None)} for b in begun})


#: A tag per symbol tells what holds there. Negation reaches three words; report and target hold to the clause's end.
NEGATED = Transducer({0: {NEGATION: (3, None)}, **{k: {NEGATION: (3, "neg"), -1: (k - 1, "neg")} for k in (1, 2, 3)}})
REPORTED = Transducer({0: {REPORT: (1, None)}, 1: {-1: (1, "rep")}})
AIMED = Transducer({0: {TARGET: (1, None)}, 1: {-1: (1, "aim")}})
INTENDED = Transducer({0: {INTENT: (1, None)}, 1: {-1: (1, "int")}})
INSULTING, THREATENING = spelled(INSULT, "insult", "insult"), spelled(THREAT, "threat", "vow")
GRAMMAR = (NEGATED, REPORTED, AIMED, INTENDED, INSULTING, THREATENING)
#: Symbols without which a clause gives nothing.
TELLING = frozenset({INSULT, MILD, THREAT} | {FIXED[p.split()[-1]] for phrases in PHRASES.values() for p in phrases})


def compose(parts: tuple[Transducer, ...]) -> tuple[np.ndarray, list[list[frozenset]]]:
    """Product automaton: next state by state and symbol, and the tags that all parts give there."""
    numbers, rows, tags = {(0,) * len(parts): 0}, [], []
    waiting = list(numbers)
    while waiting:
        states = waiting.pop(0)
        row, tagged = [], []
        for symbol in range(SYMBOLS):
            steps = [part.step(state, symbol) for part, state in zip(parts, states, strict=True)]
            after = tuple(state for state, _ in steps)
            if after not in numbers:
                numbers[after] = len(numbers)
                waiting.append(after)
            row.append(numbers[after])
            tagged.append(frozenset(tag for _, tag in steps if tag))
        rows.append(row)
        tags.append(tagged)
    return np.array(rows), tags


def event_of(symbol: int, held: frozenset) -> int:
    """Number of the event that a symbol makes under the tags of all transducers, -1 for none."""
    if "insult" in held:
        return 2 if "neg" in held else 3 if "rep" in held else 1 if "aim" in held else 0
    if symbol == MILD:
        return 4
    if "vow" in held or ("threat" in held and held & {"aim", "int"}):
        return 6 if held & {"neg", "rep"} else 5
    return -1


def weight_of(symbol: int, weight: float) -> float:
    """Weight of an event: its word's own, or that of a strong word for a phrase."""
    return weight if symbol in (INSULT, MILD, THREAT) else STRONG_ODDS


@cache
def outputs() -> tuple[list[list[int]], list[list[int]]]:
    """Next state and event (-1: none) by state and symbol."""
    step, tags = compose(GRAMMAR)
    return step.tolist(), [[event_of(symbol, held) for symbol, held in enumerate(row)] for row in tags]


@dataclass
class Grammar:
    """Learned entries with their log-odds; an entry that ends in ``*`` is a stem."""

    entries: dict[str, float]
    known: dict[str, tuple[int, float]] = field(default_factory=dict)

    def symbol(self, word: str) -> tuple[int, float]:
        found = self.known.get(word)
        if found is None:
            found = self._look_up(word)
            if len(self.known) >= MEMORY:
                self.known.clear()
            self.known[word] = found
        return found

    def _look_up(self, word: str) -> tuple[int, float]:
        odds = max([self.entries.get(f, 0.0) for f in forms(word)])
        fixed = FIXED.get(word, OTHER)
        if odds >= STRONG_ODDS or fixed == INSULT:
            return INSULT, max(odds, STRONG_ODDS)
        if fixed < OTHER:
            return fixed, 1.0
        return (MILD, odds) if odds >= MILD_ODDS else (fixed, 0.0)

    def features(self, text: str) -> list[float]:
        """Weight of each event over all clauses, best clause, and events per clause."""
        step, events = outputs()
        sums, best, clauses = [0.0] * len(EVENTS), 0.0, 0
        for clause in CLAUSE.split(text.lower()):
            words = WORD.findall(clause)
            clauses += bool(words)
            symbols = [self.known.get(w) or self.symbol(w) for w in words]
            if not any(s in TELLING for s, _ in symbols):
                continue
            state, score = 0, 0.0
            for symbol, weight in symbols:
                event = events[state][symbol]
                state = step[state][symbol]
                if event >= 0:
                    weight = weight_of(symbol, weight)
                    sums[event] += weight
                    score += weight if event in (0, 1, 4, 5) else weight / 2
            best = max(best, score)
        return [*np.log1p(sums), np.log1p(best), np.log1p(20 * sum(sums) / max(1, clauses))]


def forms(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)]


@dataclass
class Scorer:
    """Grammar and a logistic layer over its features."""

    grammar: Grammar
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        return round(float(1 / (1 + np.exp(-(np.dot(self.weights, self.grammar.features(text)) + self.bias)))), 6)


def learn_entries(counts: pd.DataFrame, totals: np.ndarray) -> dict[str, float]:
    """Log-odds of words and stems with support, from texts per form and label."""
    clean, toxic = counts["clean"].to_numpy(float), counts["toxic"].to_numpy(float)
    odds = np.log((toxic + 0.5) / (totals[1] + 1)) - np.log((clean + 0.5) / (totals[0] + 1))
    found = counts.assign(odds=odds)[(toxic >= SUPPORT) & (odds >= MILD_ODDS)]
    found = found.sort_values(["odds", "form"], ascending=[False, True]).head(ENTRIES)
    return dict(zip(found["form"], found["odds"], strict=True))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps with a small ridge."""
    x1, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    ridge = np.diag([0.1] * x.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        w = w + np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + ridge, x1.T @ (y - p) - ridge @ w)
    return w[:-1], float(w[-1])


def pick(marks: DataFrame, rows_per_label: int = ROWS_PER_LABEL, id_col: str = "doc_id", label_col: str = "toxic") -> tuple[DataFrame, dict[int, int]]:
    """About ``rows_per_label`` ids of each label, by a hash of the id, and how many there are of each.

    ``marks`` has one label an id. Labels other than 0 and 1 are left out. At most ``4 * rows_per_label`` rows
    come out, so they can be broadcast.
    """
    marks = marks.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).where("_id IS NOT NULL AND label IN (0, 1)")
    counts = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    if not counts:
        return marks, counts
    share = F.create_map(*[F.lit(x) for label, n in counts.items() for x in (label, min(1.0, rows_per_label / n))])
    return marks.where(F.pmod(F.xxhash64("_id"), F.lit(2**30)) < share[F.col("label")] * 2**30).limit(4 * rows_per_label), counts


def train(staging: Staging, docs: DataFrame, marks: DataFrame, rows_per_label: int = ROWS_PER_LABEL, id_col: str = "doc_id", text_col: str = "text") -> Scorer:
    """Scorer from texts and ``marks``, one label 0 or 1 an id (``doc_id``, ``toxic``).

    A bounded sample of the labels picks the texts (:func:`pick`), which stay on the executors; of equal texts one is
    used. Spark counts in how
    many texts each word and stem stands, by label and by two folds. The logistic layer learns on features whose
    entries were counted without the row's own fold. Without both labels only the fixed words count, with fixed
    weights.
    """
    picked, counts = pick(marks, rows_per_label)
    plain = Scorer(Grammar({}), np.array([1.5, 2.0, 0.2, 0.4, 0.0, 1.5, 0.2, 0.5, 0.0]), -3.0)
    if len(counts) < 2:
        return plain
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(picked), F.col("id") == F.col("_id"))
    rows = rows.withColumn("key", F.sha2("text", 256)).groupBy("key").agg(F.max("label").alias("label"), F.first("text").alias("text"))
    rows = staging.freeze(rows.select("label", "text", (F.crc32("key") % 2).cast("int").alias("fold")), "sample")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, int], Counter] = {}
        for part in parts:
            for label, text, fold in zip(part["label"], part["text"], part["fold"], strict=True):
                words = set(WORD.findall(text.lower()))
                seen.setdefault((label, fold), Counter()).update({f for w in words for f in forms(w)})
        for (label, fold), held in seen.items():
            yield pd.DataFrame({"form": list(held), "label": label, "fold": fold, "n": list(held.values())})

    parts = rows.mapInPandas(count, "form string, label int, fold int, n long")
    cell = lambda label, fold: F.sum(F.when((F.col("label") == label) & (F.col("fold") == fold), F.col("n")).otherwise(0)).alias(f"n{label}{fold}")
    table_ = parts.groupBy("form").agg(*[cell(label, fold) for label in (0, 1) for fold in (0, 1)])
    sizes = {(r["label"], r["fold"]): r["count"] for r in rows.groupBy("label", "fold").count().collect()}
    totals = np.array([[sizes.get((label, fold), 0) for fold in (0, 1)] for label in (0, 1)])
    odds = f"ln((n10 + n11 + 0.5) / {totals[1].sum() + 1}) - ln((n00 + n01 + 0.5) / {totals[0].sum() + 1})"
    wanted = table_.where(f"n10 + n11 >= {SUPPORT} AND {odds} >= {MILD_ODDS - 1}").orderBy(F.expr(odds).desc(), "form").limit(4 * ENTRIES).toPandas()
    made = lambda folds: Grammar(
        learn_entries(
            pd.DataFrame({"form": wanted["form"], "clean": sum(wanted[f"n0{f}"] for f in folds), "toxic": sum(wanted[f"n1{f}"] for f in folds)}),
            totals[:, list(folds)].sum(1),
        )
    )
    without = {0: made((1,)), 1: made((0,))}

    def describe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [without[fold].features(text) for fold, text in zip(part["fold"], part["text"], strict=True)]
            yield pd.DataFrame({"label": part["label"], "x": found})

    learned = rows.mapInPandas(describe, "label int, x array<double>").toPandas()
    if not totals.sum(1).all():
        return plain
    weights, bias = logistic(np.array(learned["x"].tolist()), learned["label"].to_numpy(float))
    # the picked share of the two labels differs from that of all rows
    picked, true = totals.sum(1), np.array([counts[0], counts[1]])
    bias += float(np.log(true[1] / true[0]) - np.log(picked[1] / picked[0]))
    return Scorer(made((0, 1)), weights, bias)


def score(docs: DataFrame, scorer: Scorer, columns: list[str], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``columns`` of every row with ``score`` and ``predicted``.

    Every clause of the whole text is matched, in time in proportion to its length. A null text counts as empty;
    an empty one gets the score of a text without any match. Repeated rows get the same score, null ids stay null, a
    score at the threshold counts as toxic, an empty table gives an empty result, and columns of any other name are not
    read.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            scores = np.array([scorer.score(t) for t in part["_text"].fillna("")], float)
            yield part.drop(columns="_text").assign(score=scores, predicted=(scores >= threshold).astype("int32"))

    narrow = docs.select(*columns, F.col(text_col).alias("_text"))
    schema = "".join(f"`{c}` string, " for c in columns)
    return from_text(as_text(narrow, columns).mapInPandas(run, f"{schema}score double, predicted int"), columns, docs)


def drop_toxic(docs: DataFrame, scorer: Scorer, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score at or above the threshold; all columns and all other rows stay."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(scorer.score)

    return docs.where(scored(F.col(text_col)) < threshold)


def known_labels(labels: DataFrame) -> DataFrame:
    """Labels to learn from: those whose id's remainder by 4 is not 2, one an id."""
    return labels.where(remainder(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = train(Staging(spark), docs, known_labels(table(spark, sf_dir, "labels")))
    held = docs.select("doc_id", "text", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"))
    return score(held, scorer, ["doc_id", "held_out"])
