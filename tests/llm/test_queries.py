"""Registered queries next to their SQL, and the pipeline's stages."""

import os

import pytest
from compare import connect, differences

import corpus_pipeline
from gridzonal.llm.queries import ORACLE, REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("key", list(ORACLE))
def test_matches_oracle(spark, key):
    assert differences(REGISTRY[key](spark, SF_DIR), connect(SF_DIR), ORACLE[key]) == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run(spark):
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert packed.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").isEmpty()
    assert packed.count() > 0
