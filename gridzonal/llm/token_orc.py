"""Token ids as ORC: integer run-length encoding, row indexes and Bloom filters on document ids.

A data set is a folder of ORC files in ascending id order, one per range of ids. ``ids`` is an array of
integers (run-length encoded by the format), ``local_start`` the ids of the file before the row and
``file_no`` the file. Readers cut files into stripes, so one file is read by many tasks, and a lookup by id skips files,
stripes and row groups by statistics and Bloom filter. Null and empty texts hold the end id alone; repeated ids are
kept, in no set order among themselves; a null id comes first; an empty table gives an empty data set. Columns other than
id and text are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzonal.llm.tokens import encoder, groups

STORED = "doc_id bigint, n_tokens bigint, local_start bigint, file_no int, ids array<int>"

ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.dictionary.key.threshold": "0",
}


def _encode_sorted(tokenizer: str, end_id: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        held = encoder(tokenizer)
        try:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                for first, last in groups(texts):
                    parts = [ids + end for ids in held.encode(texts[first:last])]
                    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
                    edges = np.concatenate([[0], np.cumsum(sizes)])
                    values = pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(first, last - first),
                            pa.array(sizes),
                            pa.array(before + edges[:-1]),
                            batch.column("file_no").slice(first, last - first),
                            pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values),
                        ],
                        names=["doc_id", "n_tokens", "local_start", "file_no", "ids"],
                    )
                    before += int(edges[-1])
        finally:
            held.forget()

    return run


def write_token_orc(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every whole text, append ``end_id`` and write the ids below ``path`` in ascending order of ``id_col``."""
    placed = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
        .withColumn("file_no", F.spark_partition_id())
    )
    stored = placed.mapInArrow(_encode_sorted(tokenizer, end_id), STORED)
    stored.write.format("orc").options(**ORC_OPTIONS).save(path)


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """The stored columns; filters on ``doc_id`` reach the reader."""
    return spark.read.schema(STORED).orc(path)


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        edges = ids.offsets.to_numpy()
        values = memoryview(ids.values.to_numpy().astype("<u4")).cast("B")
        crc = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "n_tokens", "local_start", "file_no")), pa.array(crc, pa.int64())],
            names=["doc_id", "n_tokens", "local_start", "file_no", "ids_crc32"],
        )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files: ``start`` counts the ids of all documents before."""
    stored = read_token_orc(spark, path)
    files = stored.groupBy("file_no").agg(F.sum("n_tokens").alias("held"))
    # One row per file, so the running sum over all of them is small.
    offsets = files.selectExpr("file_no", "sum(held) OVER (ORDER BY file_no) - held AS file_start")
    digest = "doc_id bigint, n_tokens bigint, local_start bigint, file_no int, ids_crc32 bigint"
    rows = stored.mapInArrow(_crc, digest)
    return rows.join(F.broadcast(offsets), "file_no").selectExpr(
        "doc_id", "file_start + local_start AS start", "n_tokens", "ids_crc32"
    )
