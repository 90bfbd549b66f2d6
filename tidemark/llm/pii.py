"""Personal data by base patterns and by bootstrapped contexts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_text, from_text, query, table
from tidemark.staging import Staging

#: Kinds in their fixed order; what a context finds is named after the kind it resembles.
KINDS = ("email", "ip", "card", "phone")
#: Rounds of scoring, least confidence of a pattern, least sure instances of it, least score of a found identifier.
ROUNDS, CONFIDENCE, SURE_INSTANCES, SCORE = 3, 0.8, 5, 0.9
#: Characters first looked at on both sides of an instance for its neighbouring words; more where these are longer.
AROUND = 60

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT, NOT_DIGIT = re.compile("[0-9]"), re.compile("[^0-9]+")
SPACE, MARK = re.compile(r"\s"), re.compile(r"[0-9@]|\([aA][tT]\)|\[[aA][tT]\]")
#: Groups of digits joined by single spaces, dots, dashes, slashes or brackets.
RUN = re.compile(r"\+?\(?[0-9]++(?:(?:\)[\x20./-]?|[\x20./-]?\(|[\x20./-])[0-9]++)++")
EDGE = ".,;:!?\"'()[]{}<>|*&%$#"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, ``@`` and dotted domain, found from the ``@`` outwards in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four base kinds by kind, then start; ends are exclusive. A match that fails its test is dropped."""
    found = [("email", i, j) for i, j in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(part.lstrip("0")) < 4 and int(part[-4:]) < 256 for part in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def shape(token: str) -> str | None:
    """Kind that a token resembles by a looser rule than the base patterns."""
    digits = NOT_DIGIT.sub("", token)
    rest = set(token) - set("0123456789")
    if "@" in token or "(at)" in token.lower() or "[at]" in token.lower():
        return "email"
    if token.count(".") >= 3 and rest <= {"."}:
        return "ip"
    if 12 <= len(digits) <= 20 and rest <= set(" -"):
        return "card"
    return "phone" if 7 <= len(digits) <= 15 and rest <= set("+()./- ") else None


def other_tokens(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Words that hold a digit, an at sign, ``(at)`` or ``[at]`` and touch no base span."""
    spans, k, at = sorted((i, j) for _, i, j in taken), 0, 0
    while found := MARK.search(text, at):
        end = SPACE.search(text, found.end())
        end = end.start() if end else len(text)
        start = found.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        at = end
        while start < end and text[start] in EDGE:
            start += 1
        while end > start and text[end - 1] in EDGE:
            end -= 1
        while k < len(spans) and spans[k][1] <= start:
            k += 1
        if end - start >= 5 and not any(i < end for i, _ in spans[k : k + 1]):
            yield start, end


def digit_runs(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of digit groups over several words that resemble a kind, are no part of a word and touch no base span."""
    spans, k = sorted((i, j) for _, i, j in taken), 0
    for m in RUN.finditer(text):
        start, end = m.span()
        while k < len(spans) and spans[k][1] <= start:
            k += 1
        joined = text[start - 1 : start].isalnum() or text[end : end + 1].isalnum() or "@" in (text[start - 1 : start], text[end : end + 1])
        if " " in m[0] and not joined and shape(m[0]) and not any(i < end for i, _ in spans[k : k + 1]):
            yield start, end


def words_before(text: str, start: int) -> list[str]:
    """The two words before a place, without the marks around them; fewer at the start of a text."""
    width = AROUND
    while True:
        low = max(0, start - width)
        pieces = text[low:start].split()
        found = [w for w in (p.strip(EDGE + "=").lower() for p in pieces[low > 0 :]) if w]
        if len(found) >= 2 or not low:
            return found[-2:]
        width *= 2


def word_after(text: str, end: int) -> str:
    """What stands behind a place up to the end of the next word, without the marks around it."""
    width = AROUND
    while True:
        pieces = text[end : end + width].split()
        if len(pieces) > 1 or end + width >= len(text):
            return pieces[0].strip(EDGE).lower() if pieces else ""
        width *= 2


def words_around(text: str, start: int, end: int) -> tuple[str, str]:
    """Two patterns: the two words before, and the words on both sides."""
    before = ["", *words_before(text, start)][-2:]
    return f"{' '.join(before)} _", f"{before[-1]} _ {word_after(text, end)}"


def instances(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Every seed, every other word and every run of digit groups with its value, kind or resembled kind, and its two context patterns."""
    spots = [(k, k, i, j) for k, i, j in base] + [(None, shape(text[i:j]), i, j) for i, j in (*other_tokens(text, base), *digit_runs(text, base))]
    return [dict(seed=seed, kind=kind, start=i, end=j, value=text[i:j].lower(), patterns=list(words_around(text, i, j))) for seed, kind, i, j in spots]


INSTANCE = "struct<seed: string, kind: string, start: long, end: long, value: string, patterns: array<string>>"


def extract(docs: DataFrame) -> DataFrame:
    """Rows (row, id, text) to row, id, base counts, base spans as text and all instances."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text in part["text"].fillna(""):
                base = base_spans(text)
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append((*counts, ",".join(f"{k}:{i}:{j}" for k, i, j in base), instances(text, base)))
            made = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base", "found"], index=part.index)
            yield pd.concat([part[["row", "id"]], made], axis=1)

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    made = as_text(docs, ["id"]).mapInPandas(run, f"row long, id string, {counts}, base string, found array<{INSTANCE}>")
    return from_text(made, ["id"], docs)


def bootstrap(staging: Staging, seen: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Values that confident contexts reveal: ``value``, ``kind``, ``score``.

    ``seen`` has one row per occurrence: value, seed, kind, patterns. The graph links each pattern with its distinct
    values, counted once however often they repeat. In every round a pattern's confidence in a kind is the mean
    score of its values, damped by two unknown ones; it needs ``SURE_INSTANCES`` surely known values and
    ``CONFIDENCE``. A value that resembles the kind and has no score yet speaks neither for nor against the pattern; all
    others that are not of the kind speak against it. A value's score is the chance that not all of its confident patterns err; seeds keep score 1.
    Only values that resemble the kind can be found. All steps are grouped sums with map-side combining and joins
    against tables with one row a key, which adaptive execution splits where a key is hot.
    """
    values = seen.groupBy("value").agg(F.max("seed").alias("seed"), F.max("kind").alias("kind"))
    edges = seen.select("value", F.explode("patterns").alias("pattern")).distinct()
    edges = staging.freeze(edges.join(values.withColumnRenamed("value", "_value"), F.col("value") == F.col("_value")).drop("_value"), "edges")
    alike = edges.groupBy(F.col("pattern").alias("_pattern"), F.col("kind").alias("_kind")).agg(F.count("*").alias("alike"))
    sizes = alike.groupBy("_pattern").agg(F.sum("alike").alias("size"), F.map_from_entries(F.collect_list(F.struct(F.coalesce("_kind", F.lit("")), "alike"))).alias("alike"))
    sizes = staging.freeze(sizes.where(f"size >= {SURE_INSTANCES}"), "sizes")
    seeds = values.where("seed IS NOT NULL").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score"))
    scores = staging.freeze(seeds, "scores")
    for _ in range(rounds):
        known = edges.select("value", "pattern").join(scores.withColumnRenamed("value", "_value"), F.col("value") == F.col("_value"))
        trust = known.groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), F.sum((F.col("score") >= SCORE).cast("int")).alias("sure"), F.count("*").alias("scored"))
        against = F.col("size") - F.coalesce(F.try_element_at("alike", F.col("kind")), F.lit(0))
        trust = trust.join(sizes, F.col("pattern") == F.col("_pattern")).withColumn("trust", F.col("sum") / (F.col("scored") + against + 2))
        trust = trust.where((F.col("sure") >= SURE_INSTANCES) & (F.col("trust") >= CONFIDENCE)).select(F.col("pattern").alias("_pattern"), F.col("kind").alias("_kind"), "trust")
        trust = staging.freeze(trust, "trust")
        fresh = edges.where("seed IS NULL AND kind IS NOT NULL").join(trust, (F.col("pattern") == F.col("_pattern")) & (F.col("kind") == F.col("_kind")))
        fresh = fresh.groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("score"))
        scores = staging.freeze(seeds.unionByName(fresh), "scores")
    return scores.where(f"score >= {SCORE}").join(seeds.select(F.col("value").alias("_value")), F.col("value") == F.col("_value"), "left_anti")


def find(staging: Staging, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: id, ``n_*``, ``base`` and ``spans`` (kind:start:end, by kind and start), ``n_found``.

    Base spans always stay; spans that the contexts reveal follow as ``found_`` kinds, without those inside another. Null and empty texts have no
    spans; long texts are read whole; repeated rows have equal spans and count once as values; an empty table gives
    an empty result; other columns are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = staging.freeze(extract(rows), "instances")
    seen = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.*")
    revealed = bootstrap(staging, seen).select(F.col("value").alias("_value"), F.col("kind").alias("_kind"))
    hits = seen.where("seed IS NULL AND kind IS NOT NULL").join(revealed, (F.col("value") == F.col("_value")) & (F.col("kind") == F.col("_kind")))
    before = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    hits = hits.withColumn("reached", F.max("end").over(before)).where("reached IS NULL OR end > reached")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = hits.groupBy(F.col("row").alias("_row")).agg(F.array_sort(F.collect_list(F.struct(order.alias("no"), "start", "end", "kind"))).alias("more"))
    text = F.array_join(F.transform("more", lambda s: F.concat_ws(":", F.concat(F.lit("found_"), s["kind"]), s["start"], s["end"])), ",")
    joined = rows.join(spans, F.col("row") == F.col("_row"), "left")
    return joined.select(
        F.col("id").alias(id_col),
        *(f"n_{k}" for k in KINDS),
        "base",
        F.array_join(F.array_remove(F.array("base", F.coalesce(text, F.lit(""))), ""), ",").alias("spans"),
        F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_found"),
    )


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(Staging(spark), table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans", "n_found")
