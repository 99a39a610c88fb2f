"""The queries: against DuckDB where SQL can express them, and all of them for their rows."""

import corpus_pipeline
import pytest
from compare import difference, duck

from conceptree.llm.queries import llm_oracles, llm_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query(spark, con, name):
    assert difference(llm_queries()[name](spark, FOLDER), con, llm_oracles()[name]) is None


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.dtypes == docs.dtypes
        docs = corpus_pipeline.materialize(after, "stage")
        assert 0 < docs.count() <= 200
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    kept = pieces.select("doc_id").distinct().count()
    assert kept == docs.count()
