"""Columns of the input that are named as operators name their own come through unharmed."""

import pytest
from pyspark.sql import functions as F

from cases import INNER, documents
from gridzonal.llm.exact_dedup import keep_exact
from gridzonal.llm.jaccard import keep_one_of_each
from gridzonal.llm.mixing import ADDED, mix
from gridzonal.llm.quality import keep_good


def rows_of(df, columns):
    return sorted((str(tuple(r[c] for c in columns)) for r in df.collect()))


@pytest.mark.parametrize("stage", ["quality", "exact", "near", "mix"])
def test_names_of_operators(spark, stage):
    plain = documents(spark).filter("doc_id >= 0 AND doc_id <> 7")
    clashing = plain.withColumns({name: F.concat_ws("-", F.lit(name), "doc_id") for name in INNER})
    labels = plain.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS quality")
    run = {
        "quality": lambda docs: keep_good(docs, labels),
        "exact": keep_exact,
        "near": keep_one_of_each,
        "mix": lambda docs: mix(docs).drop(*ADDED),
    }[stage]
    want, found = run(plain), run(clashing)
    assert found.columns == clashing.columns
    assert rows_of(found, plain.columns) == rows_of(want, plain.columns)
    assert all(row[name] == f"{name}-{row.doc_id}" for row in found.collect() for name in INNER)
