"""Best-fit packing of token pieces, bulk-synchronous.

A document's ids and an end id are cut into pieces of at most ``capacity`` tokens. The pieces are range-sorted by length in a
distributed pass that gives each its rank among equal ones. Since pieces of one length are interchangeable, and so are
sequences with one gap, a superstep matches whole runs of them: the longest run of pieces still waiting sweeps
to the run of the smallest gaps that take it and fills one gap after the other, ranks settle who gets which, gaps are updated, and the
sweep repeats. The sweep is a loop on the driver over runs, not over tables of pieces or gaps. The runs number
at most one per length, whatever the input, so the supersteps cost nothing at scale; every piece then finds
its sequence by its rank in a distributed join. The sequences are filled as by best-fit decreasing, up to the order of equal pieces
and of equal gaps.

Null and empty texts are one end id. Repeated rows and ids are packed each on its own. An empty table gives an
empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridzonal.llm.tokens import Encoder, encoder, groups
from gridzonal.storage import materialise

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut_batch(batch: pa.RecordBatch, held: Encoder, end: bytes, capacity: int) -> Iterator[pa.RecordBatch]:
    texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
    for first, last in groups(texts):
        out: tuple[list, ...] = ([], [], [], [], [])
        for doc, coded in zip(ids[first:last], held.encode(texts[first:last])):
            coded += end
            for piece, at in enumerate(range(0, len(coded), 4 * capacity)):
                part = coded[at : at + 4 * capacity]
                for column, value in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(out, kinds)],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def _cut(tokenizer: str, end_id: int, capacity: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = encoder(tokenizer)
        try:
            for batch in batches:
                yield from _cut_batch(batch, held, end, capacity)
        finally:
            held.forget()

    return run


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every whole text."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(_cut(tokenizer, end_id, capacity), PIECES)


def _number_equals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``local_rank``, the number of the row among the rows of its length in the sorted partition."""
    length, seen = None, 0
    for batch in batches:
        sizes = batch.column("length").to_numpy()
        if not len(sizes):
            continue
        heads = np.flatnonzero(np.concatenate([[True], sizes[1:] != sizes[:-1]]))
        ranks = np.arange(len(sizes)) - np.repeat(heads, np.diff(np.append(heads, len(sizes))))
        if sizes[0] == length:
            first = heads[1] if len(heads) > 1 else len(sizes)
            ranks[:first] += seen
        length, seen = sizes[-1], int(ranks[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranks)], names=[*batch.schema.names, "local_rank"])


def _rank_by_length(pieces: DataFrame) -> DataFrame:
    """Range-sort the pieces by length and add ``rank`` among those of equal length, in two passes.

    The first numbers the rows within each range partition, the second adds what the partitions before hold. A range-sorted
    table has fewer (partition, length) runs than partitions and lengths together, so the runs are broadcast.
    """
    order = ["length", "doc_id", "piece", "ids_crc32"]
    placed = pieces.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    local = materialise(
        placed.mapInArrow(_number_equals, f"{PIECES}, part int, local_rank bigint"), "ranked"
    )
    runs = local.groupBy("part", "length").agg(F.count(F.lit(1)).alias("held"))
    before = F.sum("held").over(Window.partitionBy("length").orderBy("part")) - F.col("held")
    runs = runs.select("part", "length", before.alias("earlier"))
    ranked = local.join(F.broadcast(runs), ["part", "length"])
    return ranked.withColumn("rank", F.col("local_rank") + F.col("earlier")).drop("part", "local_rank", "earlier")


MATCHES = "length bigint, first_rank bigint, end_rank bigint, first_sequence bigint, offset bigint"


def match_runs(held: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Supersteps of best fit over runs of equal pieces and runs of equal gaps, longest pieces first.

    A run of pieces goes to the run of the smallest gaps that take it (its successor). A gap that has taken a piece is the smallest
    that fits until it takes no more, so as many gaps as the run fills get all the pieces they hold, one more gets the
    remainder, and the other gaps stay as they are. When no gap is left that fits, new sequences are opened. Rank r of a match goes to sequence
    ``first_sequence + r - first_rank``. The input has a row per length, so its size and that of the result depend on the
    capacity, never on the number of pieces.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    matches, opened = [], 0

    def leave(size: int, first: int, end: int) -> None:
        if size > 0 and end > first:
            if size not in gaps:
                gaps[size] = []
                insort(sizes, size)
            gaps[size].append((first, end))

    for length in sorted(held, reverse=True):
        rank, end = 0, held[length]
        while rank < end:
            place = bisect_left(sizes, length)
            if place < len(sizes):
                size = sizes[place]
                first, stop = gaps[size].pop()
                if not gaps[size]:
                    del gaps[size], sizes[place]
            else:
                size, first = capacity, opened
                stop = opened = opened + -(-(end - rank) // (capacity // length))
            fit = size // length
            full = min(stop - first, (end - rank) // fit)
            rest = end - rank - full * fit if first + full < stop else 0  # under fit
            for layers, begin, upto in ((fit, first, first + full), (rest, first + full, first + full + 1)):
                for layer in range(layers if upto > begin else 0):
                    matches.append((length, rank, rank + upto - begin, begin, capacity - size + layer * length))
                    rank += upto - begin
            leave(size - fit * length, first, first + full)
            if rest:
                leave(size - rest * length, first + full, first + full + 1)
            leave(size, first + full + (rest > 0), stop)
    return matches


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    spark = docs.sparkSession
    ranked = _rank_by_length(materialise(token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces"))
    ranked = materialise(ranked, "pieces-ranked")
    # One row per length that occurs, so at most ``capacity`` rows.
    held = {row["length"]: row["held"] for row in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("held")).collect()}
    matches = spark.createDataFrame(match_runs(held, capacity) or [(0, 0, 0, 0, 0)], MATCHES)
    matches = matches.withColumnRenamed("length", "_length")
    inside = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank"))
    placed = ranked.join(F.broadcast(matches), inside)
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"),
        "offset",
    )
