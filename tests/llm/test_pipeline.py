"""The pipeline and the registered queries on the smallest tables."""

from __future__ import annotations

import inspect

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from variantloom.llm import queries

TABLES = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, TABLES)
        if name != "pack":
            assert out.columns == columns
            docs = corpus_pipeline.stage(out, f"test-{name}")
            left = {r["doc_id"] for r in docs.select("doc_id").collect()}
            assert left <= ids and len(left) == docs.count() > 100
            ids = left
        else:
            assert {r["doc_id"] for r in out.collect()} == ids


def test_pipeline_is_registered(spark):
    registered = __spark_entry__.queries()
    assert registered["pipeline"] is corpus_pipeline.run
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert all(inspect.isfunction(f) for f in queries.QUERIES.values())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    own = queries.QUERIES[name](spark, TABLES)
    with duckdb.connect() as db:
        for table in ("documents", "embeddings"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
        expected = db.execute(queries.ORACLES[name])
        columns = [c[0] for c in expected.description]
        rows = expected.fetchall()
    assert sorted(own.columns) == sorted(columns)
    assert sorted(map(tuple, own.select(*columns).collect()), key=str) == sorted(rows, key=str)
