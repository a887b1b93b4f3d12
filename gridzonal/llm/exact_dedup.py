"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. New rows are reduced to one per digest, anti-joined with
the index by a sort-merge join that needs no shuffle of the index, and appended. Nulls count as empty text,
so all null and empty rows form one group; texts differ unless identical byte for byte; repeated rows and
equal ids are legal; an empty table leaves the index as it is. Columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzonal.llm.skew import attach_group, free_name
from gridzonal.storage import fresh_path, materialise

BUCKETS = 64


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest): SHA-256 of every whole text in lowercase hex."""
    return docs.select(id_col, F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("digest"))


def create_index(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> None:
    """An empty index at ``path``, or the one that is there already, known to the session as ``name``."""
    spark.sql(
        f"CREATE TABLE {name} (digest STRING, keep_id BIGINT) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def append_new(keys: DataFrame, name: str, id_col: str = "doc_id", buckets: int = BUCKETS) -> None:
    """Add the digests that the index lacks, each with the largest id among the new rows."""
    spark = keys.sparkSession
    new = keys.groupBy("digest").agg(F.max(id_col).cast("long").alias("keep_id"))
    missing = new.hint("merge").join(spark.table(name).select("digest").hint("merge"), "digest", "left_anti")
    # The anti-join is finished and written before the table it reads grows.
    found = materialise(missing, "digests")
    path = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]
    # A bucket is dealt out whole, so it gets one file however many tasks write; dealt by digest, each task could hold rows of each bucket.
    bucket = F.pmod(F.hash("digest"), F.lit(buckets))
    (
        found.repartition(buckets, bucket)
        .write.mode("append")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, "digest")
        .sortBy("digest")
        .saveAsTable(name)
    )


def drop_index(spark: SparkSession, name: str) -> None:
    """Forget the name; the files of the index stay at their path."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 2, buckets: int = BUCKETS
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per input row.

    Ids are loaded in ``parts`` ranges from the largest down, so the id in the index is the largest of its
    digest. A null id never beats another; with a repeated (id, text) row every copy of it is marked kept.
    """
    spark = docs.sparkSession
    keys = materialise(digests(docs, id_col, text_col), "keys")
    name = f"digest_index_{fresh_path(spark, 'i').rpartition('-')[2]}"
    create_index(spark, name, fresh_path(spark, "digest-index"), buckets)
    low, high = keys.agg(F.min(id_col), F.max(id_col)).first()
    if low is None:
        append_new(keys, name, id_col, buckets)
    else:
        for part in range(parts, 0, -1):
            upper, lower = low + (high - low + 1) * part // parts, low + (high - low + 1) * (part - 1) // parts
            inside = (F.col(id_col) >= lower) & (F.col(id_col) < upper)
            append_new(keys.filter(inside | F.col(id_col).isNull() if part == 1 else inside), name, id_col, buckets)
    sizes = keys.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = materialise(sizes.join(spark.table(name), "digest"), "groups")
    drop_index(spark, name)
    return attach_group(keys, groups, "digest", "group_size").select(
        id_col,
        "keep_id",
        "group_size",
        F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; of repeated (id, text) rows one stays."""
    groups = materialise(exact_groups(docs, id_col, text_col), "exact-groups")
    own, keep, digest = (free_name(docs, name) for name in ("_own", "_keep", "_digest"))
    kept = groups.filter("kept").select(F.col(id_col).alias(keep), F.col("text_sha256").alias(digest))
    text = F.coalesce(docs[text_col], F.lit("")).cast("binary")
    marked = docs.withColumn(own, F.sha2(text, 256))
    same = F.col(own).eqNullSafe(F.col(digest)) & F.col(id_col).eqNullSafe(F.col(keep))
    left = marked.join(kept, same, "left_semi")
    if kept.groupBy(keep, digest).count().filter("count > 1").isEmpty():
        return left.drop(own)
    return left.dropDuplicates([own]).drop(own)
