"""K-d tree shards: every row once, near-equal bytes, gapless slots, boxes that separate."""

import zlib

import pytest
from pyspark.sql import functions as F

from cases import DOCS, as_rows, documents, rows
from gridzonal.llm import sharding
from gridzonal.llm.sharding import read_shards, shard_tree, write_shards
from gridzonal.storage import fresh_path


def place(spark, docs, **how):
    tree, path = shard_tree(docs, **how), fresh_path(spark, "shards")
    write_shards(docs, tree, path)
    return tree, read_shards(spark, path, docs.schema)


def weight(text):
    return len((text or "").encode()) + 16


def test_keeps_every_row_and_numbers_slots(spark):
    docs = documents(spark, True).withColumns({"shard": F.lit(9), "slot": F.lit("s"), "_tie": F.lit(1), "document": F.lit(0)})
    tree, found = place(spark, docs, shards=7)
    assert as_rows(found.select("document.*"), "doc_id", "text", "source") == as_rows(docs, "doc_id", "text", "source")
    assert found.select("document.*").columns == docs.columns
    for _shard, group in found.select("shard", "slot").toPandas().groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))
    held = {row["shard"]: row["held"] for row in found.groupBy("shard").agg(F.sum(sharding.row_bytes("document.text")).alias("held")).collect()}
    assert {shard: size for shard, size, *_ in tree.bounds() if size} == held
    assert sum(held.values()) == sum(weight(r[1]) for r in rows())


def corpus(spark, count=3000):
    """A third of all rows from one source, a third with one text; sizes from 16 bytes to 4 KB."""
    return spark.range(count).selectExpr(
        "id AS doc_id",
        "CASE WHEN id % 3 = 1 THEN 'same text' ELSE repeat('x', CAST(4000 * pow(pmod(xxhash64(id), 1000) / 1000.0, 6) AS int)) END AS text",
        "element_at(array('en', 'de', NULL), 1 + CAST(id % 3 AS int)) AS lang",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('src', id % 11) END AS source",
        "id % 100 AS n_chars",
    )


@pytest.mark.parametrize("shards", [1, 13])
def test_near_equal_bytes(spark, shards):
    tree, found = place(spark, corpus(spark), shards=shards)
    sizes = [row["held"] for row in found.groupBy("shard").agg(F.sum(sharding.row_bytes("document.text")).alias("held")).collect()]
    mean = sum(sizes) / shards
    assert len(sizes) == shards and max(sizes) <= 1.03 * mean and min(sizes) >= 0.97 * mean


def test_target_bytes_and_few_bins(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BINS", 3)
    docs = corpus(spark, 900)
    total = docs.agg(F.sum(sharding.row_bytes())).first()[0]
    tree, found = place(spark, docs, target_bytes=total // 5 + 1, edge_rows=8)
    assert tree.shards == 5 and found.count() == 900
    assert max(size for _s, size, *_ in tree.bounds()) < 1.1 * total / 5


def test_one_widest_dimension_separates_the_shards(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('x', 100) AS text", "id * 1.0 AS day")
    tree, found = place(spark, docs, shards=4, dimensions=("day",), edge_rows=16)
    ends = found.groupBy("shard").agg(F.min("document.day").alias("low"), F.max("document.day").alias("high")).orderBy("shard").collect()
    for before, after in zip(ends, ends[1:]):
        assert after["low"] - before["high"] > -40


def test_ties_are_cut_by_the_hash(spark):
    same = spark.range(2000).selectExpr("id AS doc_id", "repeat('y', 50) AS text", "1 AS one")
    tree, _found = place(spark, same, shards=8, dimensions=("one",), edge_rows=4)
    sizes = [size for _s, size, *_ in tree.bounds()]
    assert max(sizes) - min(sizes) <= 3 * 66


def test_equal_rows_stay_together_and_odd_numbers_take_part(spark):
    table = [(1, "a", "l", "s", 1)] * 30 + [(None, None, None, None, None)] * 5
    docs = spark.createDataFrame(table, DOCS).withColumn("x", F.expr("CASE WHEN doc_id = 1 THEN double('NaN') ELSE double('-Infinity') END"))
    _tree, found = place(spark, docs, shards=3, dimensions=("x", "source"))
    assert found.count() == 35 and found.filter("document.doc_id = 1").select("shard").distinct().count() == 1
    dated = docs.withColumns({"day": F.current_date(), "at": F.current_timestamp(), "flag": F.lit(True)})
    assert place(spark, dated, shards=2, dimensions=("day", "at", "flag"))[1].count() == 35


def test_empty(spark):
    tree, found = place(spark, documents(spark, empty=True), shards=4)
    assert found.collect() == [] and len(tree.bounds()) == 4
    assert shard_tree(documents(spark, empty=True), target_bytes=10).shards == 1


def test_registered_query(spark):
    from gridzonal.llm.queries import op11_kd_sharding

    base = "/root/testdata/sf0.001"
    table = op11_kd_sharding(spark, base).toPandas()
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").toPandas()
    want = {i: (weight(t), zlib.crc32((t or "").encode())) for i, t in zip(docs.doc_id, docs.text)}
    assert {r.doc_id: (r.size, r.text_crc32) for r in table.rename(columns={"size": "size"}).itertuples()} == want
    assert set(table.shard) <= set(range(40)) and set(table.law) == {"bytes"} and table.grown_shard.isna().all()
