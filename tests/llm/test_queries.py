"""Registered queries against their oracles, and the pipeline against its stages."""

import duckdb
import pytest

import corpus_pipeline
from siltbed.llm.queries import R

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(R.oracles))
def test_oracles(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    frame = R.queries[name](spark, DATA)
    cursor = con.execute(R.oracles[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    want = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in sorted(names)) for r in frame.collect()), key=str) == want


def test_pipeline_stages_chain(spark, documents):
    """Every stage takes what the one before returns; repeated and empty rows do not stop it."""
    docs = documents([None, "", "a b c d e f", "a b c d e f", *(f"text number {i} is here" for i in range(20))])
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == columns
    assert docs.filter("text = 'a b c d e f'").select("doc_id").distinct().count() <= 1
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert {"doc_id", "n_tokens", "ids_sha256"} <= set(last.columns) and last.count() == docs.count()
