"""Ids come back as they went in, beside nulls and of any type, from every operator and the pipeline's stages."""

import public_tokenizers
import pytest

import corpus_pipeline
from tidemark.llm import byte_bpe, exact_dedup, filter_audit, language_id, license_scan, minhash_dedup, packing, pii, secret_scan, sharding, toxicity

SF = "/root/testdata/sf0.001"
FIRST = 2**53 + 1
TEXTS = ["Write to jane@example.com or 10.0.0.1 today.", "All rights reserved, token = abcdefghijkl9.", None, "plain words " * 40, "plain words " * 40]


def packed(docs, staging):
    return packing.pack(staging, packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


def licensed(docs, staging):
    return license_scan.scan(docs)


def named(docs, staging):
    return language_id.predict(docs, None, ["doc_id"])


def scored(docs, staging):
    import numpy as np

    return toxicity.score(docs, toxicity.Scorer(toxicity.Grammar({}), np.zeros(9), 0.0), ["doc_id"])


OPERATORS = {
    "pii": lambda docs, staging: pii.find(staging, docs),
    "secrets": lambda docs, staging: secret_scan.scan(staging, docs),
    "languages": named,
    "near": lambda docs, staging: minhash_dedup.near_duplicates(staging, docs),
    "exact": lambda docs, staging: exact_dedup.exact_duplicates(staging, docs),
    "packing": packed,
    "toxicity": scored,
    "bpe": lambda docs, staging: byte_bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")),
    "licences": licensed,
    "shards": lambda docs, staging: sharding.shard_rows(staging, docs),
    "duplicates": lambda docs, staging: filter_audit.mask_counts(staging, docs, docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")),
}


@pytest.fixture(scope="module", params=["long", "string"])
def docs(spark, request):
    """Neighbouring ids that a double cannot tell apart, and a null, in one partition."""
    rows = [(FIRST + 2 * k if k != 2 else None, text, "en", "a") for k, text in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    return df.withColumn("doc_id", df.doc_id.cast(request.param)).cache()


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_keeps_ids(docs, staging, name):
    found = OPERATORS[name](docs, staging)
    if name == "duplicates":
        assert sum(r.n for r in found.collect()) == len(TEXTS)
        return
    assert found.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    order = lambda rows: sorted((r.doc_id for r in rows), key=str)
    assert order(found.collect()) == order(docs.collect())
    if name == "near":
        lowest = docs.collect()[3].doc_id
        assert {r.component_id for r in found.collect() if r.n_shingles > 1 and r.doc_id and str(r.doc_id) >= str(lowest)} == {lowest}


def test_stages_keep_ids(spark, docs, staging):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = staging.freeze(stage(spark, kept, SF), name)
    found = corpus_pipeline.packing(spark, kept, SF)
    ids = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in found.collect()} <= ids and found.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert {r.doc_id for r in docs.collect()[:2]} <= {r.doc_id for r in found.collect()}
