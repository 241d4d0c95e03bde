"""The registered corpus queries: those with SQL against it, the others for one row per row."""

from __future__ import annotations

import pytest

import corpus_pipeline
from sluice.llm.queries import ORACLES, QUERIES
from tests.compare import connect, table_of

ROWS = {"op1": "documents", "op4": "documents", "op5": "documents", "op6": "documents", "op8": "documents", "op9": "pages"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    result = connect(sf_dir).execute(ORACLES[name])
    want = table_of([c[0] for c in result.description], result.fetchall())
    found = QUERIES[name](spark, sf_dir)
    assert table_of(found.columns, found.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline"}))
def test_query_has_its_rows(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).count()
    table = ROWS.get(name.split("_")[0])
    assert rows == spark.read.parquet(f"{sf_dir}/{table}.parquet").count() if table else rows > 0


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir).cache()
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= before.count()
        before = after
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in before.collect()}
