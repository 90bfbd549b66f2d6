"""Corpus pipeline: from raw documents to packed training sequences.

Toxic documents go, of equal and of nearly equal documents one stays, live-looking credentials are masked, and
what is left is tokenised and packed. Every stage reads all rows that its predecessor kept. Its result is written
as Parquet and read again, so a lost executor never sends the run back beyond the stage that was running; what it
wrote on the way is deleted then.

In every stage a row with a null or empty text is a document like any other; they are equal to each other, so one
of them stays. A null id comes after all others, equal rows are documents of their own until one of them is kept,
and ties go to the first written. Long texts are read whole. An empty table gives an empty result. Columns beside
those of ``documents`` pass through up to packing, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.exact_dedup import drop_exact_duplicates
from tidemark.llm.minhash_dedup import drop_near_duplicates
from tidemark.llm.packing import pack, pieces
from tidemark.llm.secret_scan import mask_live
from tidemark.llm.toxicity import drop_toxic, known_labels, train
from tidemark.staging import Staging, collected


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the clause grammar, learned from ``labels``, rejects.

    A null text scores as an empty one. Equal rows score the same. Without labels of both kinds the fixed words decide.
    """
    return drop_toxic(docs, train(Staging(spark), docs, known_labels(table(spark, sf_dir, "labels"))))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, keep the smallest ``doc_id``, of equal ids the first written."""
    return drop_exact_duplicates(Staging(spark), docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more on shingles of five words, keep the smallest ``doc_id``.

    Texts without words link with nothing, so all of them stay.
    """
    return drop_near_duplicates(Staging(spark), docs, words=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask credentials that only one source holds; every document stays.

    Sources are counted over the whole ``documents`` table as well: its copies are gone by now, and an example that
    many sources copied must not look like the secret of the one that is left.
    """
    return mask_live(Staging(spark), docs, census=table(spark, sf_dir, "documents"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and offset; a text without words is a piece of one id.

    All stages share the Python workers of an executor, so fewer words are remembered here.
    """
    return pack(Staging(spark), pieces(docs, public_tokenizers.path("word_bpe_49k.json"), memory=400_000)).drop("row")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("minhash_dedup", minhash_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL cannot express the learned grammar or the tokenizer; tests/llm/test_pipeline.py runs the stages in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    staging, docs = Staging(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with collected() as opened:
            docs = staging.freeze(stage(spark, docs, sf_dir), name)
        for folder in opened:
            folder.clear()
    return docs
