"""The corpus pipeline, stage by stage, and the registered queries."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = queries.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    relation = connection.sql(queries.SQL[name])
    assert sorted(relation.columns) == columns
    rows = lambda made: sorted(made, key=str)
    assert rows(map(tuple, found.select(*columns).collect())) == rows(relation.select(*columns).fetchall())


def test_all_operators_are_registered():
    names = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{k}" for k in range(1, 14)} <= names
    assert "pipeline" in entry.queries()


def test_stages_keep_columns_and_only_drop_rows(spark, awkward, staging):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = staging.freeze(stage(spark, docs, SF), name)
        assert made.columns == awkward.columns
        assert made.count() <= docs.count()
        docs = made
    assert sorted((r.doc_id or 0) for r in docs.collect()) == [1, 2, 4, 6, 7, 8]
    packed = corpus_pipeline.packing(spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {1, 2, 4, 6, 7, 8}


def test_stages_of_nothing(spark, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0


def test_run_over_the_smallest_tables(spark):
    """At most one of equal texts is left; test_plain.py holds the whole result against plain stages."""
    found = corpus_pipeline.run(spark, SF)
    kept = {r.doc_id for r in found.select("doc_id").distinct().collect()}
    texts = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        texts.setdefault(" ".join((r.text or "").split()), []).append(r.doc_id)
    assert all(sum(i in kept for i in ids) <= 1 for ids in texts.values())
