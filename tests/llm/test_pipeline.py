"""The classifier's scores, and what each stage of the pipeline keeps, next to plain Python on whole tables."""

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import plain
from gridzonal.llm import mixing, quality
from gridzonal.llm.quality import classify
from gridzonal.llm.queries import CAPACITY, TOKENIZER
from test_dedup import brute_components

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    order = {r.doc_id: r.o for r in docs.select("doc_id", F.xxhash64("doc_id").alias("o")).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    scores = plain.quality_scores(texts, {r.doc_id: r.quality for r in labels.collect()}, order)
    return docs, labels, texts, scores


def test_scores_are_those_of_plain_ftrl(spark, tables):
    docs, labels, texts, scores = tables
    found = {r.doc_id: r for r in classify(docs, labels).collect()}
    assert set(found) == set(texts)
    for i, score in scores.items():
        assert found[i].score == pytest.approx(score, abs=2e-3), i
    assert all(found[i].predicted == (found[i].score >= quality.THRESHOLD) for i in texts)
    # No score lies so near the threshold that rounding decides.
    assert {i for i in texts if found[i].predicted} == {i for i, s in scores.items() if s >= quality.THRESHOLD}


def test_every_stage_keeps_what_plain_python_keeps(spark, tables):
    docs, _labels, texts, scores = tables
    source = {r.doc_id: r.source for r in docs.collect()}
    rows = {r.doc_id: tuple(r) for r in docs.collect()}
    kept = {i for i, s in scores.items() if s >= quality.THRESHOLD}
    expected = {"quality": Counter(kept)}
    kept = plain.exact_kept({i: texts[i] for i in kept})
    expected["exact"] = Counter(kept)
    order = sorted(kept)
    kept = {i for (i, _n, component) in brute_components([(i, texts[i]) for i in order]) if i == component}
    expected["near"] = Counter(kept)
    expected["mixture"] = Counter(plain.copies({i: texts[i] for i in kept}, source, mixing.SEED, mixing.TEMPERATURE))
    staged = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        staged = spark.createDataFrame(stage(spark, staged, SF_DIR).collect(), docs.schema)
        found = staged.collect()
        assert Counter(r.doc_id for r in found) == +expected[name], name
        assert all(tuple(r) == rows[r.doc_id] for r in found), name
    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    packed = corpus_pipeline.STAGES[-1][1](spark, staged, SF_DIR).collect()
    held = Counter()
    for row in packed:
        held[row.doc_id] += row.length
    sizes = {i: len(tokenizer.encode(texts[i] or "", add_special_tokens=False).ids) + 1 for i in texts}
    assert held == Counter({i: n * sizes[i] for i, n in expected["mixture"].items() if n})
    by_sequence = Counter()
    for row in packed:
        by_sequence[row.sequence_id] += row.length
    assert max(by_sequence.values()) <= CAPACITY
