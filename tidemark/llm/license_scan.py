"""Licence scan by a positional index of rare words."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, lower_ascii, query, table

#: Separators between words, after A-Z is lower-cased.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence line as words, and the part of it that must be there word for word."""

    label: str
    words: tuple[str, ...]
    start: int
    end: int

    @property
    def key(self) -> tuple[str, ...]:
        return self.words[self.start : self.end]


def template(label: str, text: str, key: str) -> Template:
    words, phrase = tuple(text.split()), tuple(key.split())
    start = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
    return Template(label, words, start, start + len(phrase))


#: The phrases and labels that are always looked for.
BASE = (
    template("cc-by", "cc by", "cc by"),
    template("gpl", "general public license", "general public license"),
    template("reserved", "all rights reserved", "all rights reserved"),
)
#: Common licence texts, as the sentences that name or grant them, and the phrase of each that must not be missing.
TEMPLATES = (
    template("agpl-3", "gnu affero general public license version 3", "affero general public license"),
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    template("boost", "boost software license version 1 0", "boost software license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    template("cc0", "cc0 1 0 universal", "cc0 1 0"),
    template("epl-2.0", "eclipse public license v 2 0", "eclipse public license"),
    template("gpl-2", "gnu general public license version 2", "general public license version 2"),
    template("gpl-3", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee is hereby granted"),
    template("lgpl", "gnu lesser general public license", "lesser general public license"),
    template("mit", "released under the mit license", "the mit license"),
    template(
        "mit",
        "mit license permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ),
    template("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
    template("zlib", "this software is provided as is without any express or implied warranty", "provided as is without any express or implied warranty"),
)
#: Rarest words of a file whose postings in a template are intersected.
ANCHORS = 2


def words_of(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    pieces = F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAPS, -1)
    return F.filter(pieces, lambda w: w != "")


def rarity(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each template word over all texts; as many rows as templates have words."""
    held = F.array_intersect("words", F.array(*map(F.lit, vocabulary)))
    counts = words.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counts.collect()}
    total = found.get("", 0)
    return {w: log((total + 1) / (found.get(w, 0) + 1)) + 1 for w in vocabulary}


def postings(t: Template) -> Column:
    """The index of one template: its key phrase's words with their first place."""
    places = {w: t.start + i for i, w in reversed(list(enumerate(t.key)))}
    return F.create_map(*[F.lit(x) for w, place in places.items() for x in (w, place)])


def scan(docs: DataFrame, templates: tuple[Template, ...] = BASE + TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: id, ``n_words``, and ``places``, an array of (label, start, coverage).

    Two passes. The first counts in how many texts each template word stands. The second notes where licence words
    stand in a file and ranks them, the file's rarest first. For each template the file's ``ANCHORS`` rarest words that the
    template posts are looked up; their places, moved by the places posted, are intersected to starts, and the whole
    key phrase is verified at each. A template that posts a word which the file does not hold cannot stand there
    and is passed over. As a phrase holds all of its words, no place is lost. ``start`` is where the key phrase starts;
    ``coverage`` is the share of the template's weight (inverse document frequency) whose words stand at their places
    around it, 1 for the whole line.
    All of it is local to a row: the only shuffle is that of the word counts, combined per task first.
    Null and empty texts give no words and no places; long texts are scanned whole, in time in proportion to their
    length; repeated rows are scanned each; an empty table gives an empty result; other columns are not read.
    """
    words = docs.select(F.col(id_col), words_of(F.col(text_col)).alias("words"))
    idf = rarity(words, sorted({w for t in templates for w in t.words}))
    rarest_first = sorted({w for t in templates for w in t.key}, key=lambda w: (-idf[w], w))
    spot = F.struct(F.lit(0).alias("at"), F.lit("").alias("word"))
    noted = F.transform("words", lambda w, i: F.when(w.isin(rarest_first), F.struct(i.alias("at"), w.alias("word"))).otherwise(F.when(F.lit(False), spot)))
    words = words.select(id_col, "words", F.filter(noted, lambda s: s.isNotNull()).alias("spots"))
    held = F.array_distinct(F.transform("spots", lambda s: s["word"]))
    words = words.withColumn("ranked", F.array_intersect(F.array(*map(F.lit, rarest_first)), held))

    def starts(t: Template, word: Column) -> Column:
        place = F.element_at(postings(t), word)
        return F.transform(F.filter("spots", lambda s: s["word"] == word), lambda s: s["at"] - place)

    def at(start: Column, k: int) -> Column:
        return F.when(start + k >= 0, F.get(F.col("words"), start + k))

    def found(t: Template) -> Column:
        posted = sorted(set(t.key))
        own = F.array_intersect("ranked", F.array(*map(F.lit, posted)))
        begin = starts(t, F.get(own, 0))
        for k in range(1, min(ANCHORS, len(posted))):
            begin = F.array_intersect(begin, starts(t, F.get(own, k)))
        whole = F.filter(begin, lambda s: _all(at(s, k) == t.words[k] for k in range(t.start, t.end)))
        weight = sum(idf[w] for w in t.words)
        cover = lambda s: sum((F.when(at(s, k) == w, idf[w]).otherwise(0.0) for k, w in enumerate(t.words)), F.lit(0.0))
        placed = F.transform(whole, lambda s: F.struct(F.lit(t.label).alias("label"), (s + t.start).alias("start"), F.round(cover(s) / weight, 6).alias("coverage")))
        return F.when(F.size(own) == len(posted), placed).otherwise(F.lit(None))

    found_in = F.flatten(F.filter(F.array(*[found(t) for t in templates]), lambda places: places.isNotNull()))
    places = F.when(F.size("spots") > 0, found_in).otherwise(F.array().cast("array<struct<label:string,start:int,coverage:double>>"))
    return words.select(id_col, F.size("words").cast("long").alias("n_words"), places.alias("places"))


def _all(conditions) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def _sql_rows() -> str:
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = [f"({k}, '{t.label}', {t in BASE}, {quoted(t.words)}, {quoted(t.key)}, {t.start})" for k, t in enumerate(BASE + TEMPLATES)]
    return ", ".join(rows)


OP10_SQL = rf"""
WITH w AS (
    SELECT doc_id, row_number() OVER () AS r, list_filter(string_split_regex(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAPS}'), lambda x: x <> '') AS words FROM documents
), t(no, label, base, words, phrase, lead_words) AS (VALUES {_sql_rows()}),
tw AS (SELECT no, unnest(words) AS word, generate_subscripts(words, 1) AS j FROM t),
counts AS (
    SELECT v.word, count(*) FILTER (WHERE list_contains(w.words, v.word)) AS n, count(*) AS total
    FROM (SELECT DISTINCT word FROM tw) v CROSS JOIN w GROUP BY 1
), idf AS (SELECT word, ln((total + 1) / (n + 1)) + 1 AS idf FROM counts),
hits AS (
    SELECT r, no, label, base, lead_words, unnest(list_filter(range(1, len(w.words) + 1),
        lambda i: w.words[i:i + len(phrase) - 1] = phrase)) AS place FROM w CROSS JOIN t
    WHERE list_contains(w.words, phrase[1])
), cover AS (
    SELECT r, no, label, base, place, round(sum(CASE WHEN place - lead_words + j - 1 >= 1 AND w.words[place - lead_words + j - 1] = word
        THEN idf ELSE 0 END) / sum(idf), 6) AS coverage
    FROM hits JOIN w USING (r) JOIN tw USING (no) JOIN idf USING (word) GROUP BY ALL
), found AS (
    SELECT r, count(*) FILTER (WHERE base) AS n_base, min(place - 1) FILTER (WHERE base) AS first_word,
           max(place - 1) FILTER (WHERE base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
    FROM cover GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM w LEFT JOIN found USING (r)
"""


@query("op10_license_scan", OP10_SQL)
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [t.label for t in BASE]
    base = F.filter("places", lambda p: p["label"].isin(names))
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    start = F.transform(base, lambda p: p["start"].cast("long"))
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"),
        F.array_max(start).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["coverage"])), F.lit(0.0)).alias("score"),
    )
