"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and works on every document that the one before kept. All but the last return the columns
of ``docs``; the last returns a row per token piece. Nulls, empty texts, repeated rows and empty tables are handled as the
operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridzonal.llm.exact_dedup import keep_exact
from gridzonal.llm.jaccard import keep_one_of_each
from gridzonal.llm.mixing import ADDED, mix
from gridzonal.llm.packing import pack
from gridzonal.llm.quality import keep_good
from gridzonal.llm.queries import CAPACITY, TOKENIZER
from gridzonal.llm.shipping import ship_package
from gridzonal.storage import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship_package(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return keep_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return keep_one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, so that sources reach their target weights; their order is shuffled."""
    return mix(docs).drop(*ADDED)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with the sequence and offset of each."""
    return pack(docs, public_tokenizers.path(TOKENIZER), end_id=0, capacity=CAPACITY)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixture", mixture), ("packing", packing)]

# Training and tokenising have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
