"""Exact top-k by inner product with one KD-tree per shard.

Vectors become integers, floor(1024 * x). Rows are dealt to shards of about ``SHARD_ROWS``, and each shard builds a tree by median splits
of the widest dimension, with tight bounding boxes. A query visits boxes best first, by the largest inner product that its
box allows, and stops when the next box can't reach its kth score. First every query searches its home shard; the
kth score found there goes with it to all other shards, in blocks of queries, so that these open only boxes that
can still matter. The results of all shards are merged by rank.

Vectors that are null, hold a null or non-finite component, or differ in length from most take no part, neither do null ids.
A vector whose entries could give a score beyond 64 bits stops the job with its id. A query's own id is no candidate; ties go to the smaller id; repeated rows are candidates
each, and a repeated query row gives its ranks again. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridzonal.storage import materialise

SHARD_ROWS = 8192
LEAF_ROWS = 64
BLOCK_QUERIES = 2048
UNIT = 1024
LARGEST_SCORE = (1 << 63) - 1

FOUND = "tag bigint, query_id bigint, vec_id bigint, score bigint"


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out, kept = batch.column("vec_id").to_pylist(), [], []
        for number, vector in zip(ids, batch.column("vector").to_pylist()):
            if number is None or vector is None or any(x is None for x in vector):
                continue
            entries = np.array(vector, dtype=np.float64)
            if np.isfinite(entries).all():
                values = np.floor(entries * UNIT)
                if len(values) and np.abs(values).max() > math.isqrt(LARGEST_SCORE // len(values)):
                    raise ValueError(f"vector {number} has an entry so large that its scores may not fit in 64 bits")
                kept.append(number)
                out.append(values.astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])


class Tree:
    """Nodes in arrays: bounding boxes, children of inner nodes, row ranges of leaves."""

    def __init__(self, low, high, left, right, ids, rows):
        self.low, self.high, self.left, self.right, self.ids, self.rows = low, high, left, right, ids, rows

    @classmethod
    def build(cls, ids: np.ndarray, rows: np.ndarray, leaf_rows: int = LEAF_ROWS) -> "Tree":
        order = np.arange(len(ids))
        low, high, left, right = [], [], [], []
        waiting = [(0, len(ids), -1)]
        while waiting:
            first, last, parent = waiting.pop()
            node = len(low)
            part = rows[order[first:last]]
            low.append(part.min(axis=0))
            high.append(part.max(axis=0))
            if parent >= 0:
                (left if left[parent] == -2 else right)[parent] = node
            if last - first <= leaf_rows or (low[-1] == high[-1]).all():
                left.append(-first - 3)
                right.append(last)
            else:
                wide = int(np.argmax(high[-1] - low[-1]))
                middle = (last - first) // 2
                order[first:last] = order[first:last][np.argpartition(part[:, wide], middle)]
                left.append(-2)
                right.append(-2)
                waiting += [(first + middle, last, node), (first, first + middle, node)]
        return cls(np.array(low), np.array(high), np.array(left), np.array(right), ids[order], rows[order])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, low=self.low, high=self.high, left=self.left, right=self.right, ids=self.ids, rows=self.rows)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "Tree":
        with np.load(io.BytesIO(data)) as held:
            return cls(**{name: held[name] for name in held.files})

    def bound(self, query: np.ndarray, node: int) -> int:
        """The largest inner product that the box of ``node`` allows."""
        return int(np.maximum(query * self.low[node], query * self.high[node]).sum())

    def search(self, query: np.ndarray, own: int, k: int, least: int | None) -> list[tuple[int, int]]:
        """(score, id) of the k best that reach ``least``, best first; ties to the smaller id."""
        best: list[tuple[int, int]] = []  # a heap whose top is the worst: (score, -id)
        heap = [(-self.bound(query, 0), 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            reach = best[0][0] if len(best) == k else least
            if reach is not None and -bound < reach:
                break
            if self.left[node] <= -3:
                first, last = -int(self.left[node]) - 3, int(self.right[node])
                scores = self.rows[first:last] @ query
                able = np.flatnonzero(scores >= reach) if reach is not None else range(last - first)
                for row in able:
                    number = int(self.ids[first + row])
                    if number == own:
                        continue
                    item = (int(scores[row]), -number)
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
            else:
                for child in (self.left[node], self.right[node]):
                    heapq.heappush(heap, (-self.bound(query, child), int(child)))
        return [(s, -n) for s, n in sorted(best, key=lambda x: (-x[0], x[1] * -1))]


def _plant(table: pa.Table) -> pa.Table:
    data = table.column("v").to_pylist()
    rows = np.frombuffer(b"".join(data), "<i8").reshape(len(data), -1)
    tree = Tree.build(table.column("vec_id").to_numpy(), rows)
    return pa.table({"shard": table.column("shard").slice(0, 1), "tree": pa.array([tree.dump()], pa.binary())})


def _search(k: int):
    def run(queries: pa.Table, trees: pa.Table) -> pa.Table:
        out: list[list[int]] = [[], [], [], []]
        for data in trees.column("tree").to_pylist():
            tree = Tree.load(data)
            rows = [queries.column(c).to_pylist() for c in ("tag", "query_id", "v", "least")]
            for tag, number, vector, least in zip(*rows):
                for score, other in tree.search(np.frombuffer(vector, "<i8"), number, k, least):
                    for column, value in zip(out, (tag, number, other, score)):
                        column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["tag", "query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, vector_col: str = "embedding", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for every row of ``queries``, both (vec_id, vector)."""

    def whole(rows: DataFrame, label: str) -> DataFrame:
        chosen = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
        coded = chosen.mapInArrow(_quantise, "vec_id bigint, v binary")
        return materialise(coded.withColumn("tag", F.monotonically_increasing_id()), label)

    stored, asked = whole(vectors, "vectors"), whole(queries, "queries")
    width = stored.groupBy(F.length("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if width is None:
        return stored.selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "vec_id AS score").limit(0)
    stored, asked = (rows.filter(F.length("v") == width["size"]) for rows in (stored, asked))
    shards = max(1, -(-width["count"] // shard_rows))
    deal = lambda n: F.pmod(F.xxhash64("tag"), F.lit(n)).cast("int")
    planted = stored.withColumn("shard", deal(shards)).groupBy("shard").applyInArrow(_plant, "shard int, tree binary")
    trees = materialise(planted, "trees")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    asked = asked.select("tag", F.col("vec_id").alias("query_id"), "v", deal(blocks).alias("block"), deal(shards).alias("home"))

    def searched(rows: DataFrame) -> DataFrame:
        # Every tree meets every block of queries that comes to its shard; a block bounds what a task holds.
        spread = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        keyed = rows.groupBy("shard", "block").cogroup(spread.groupBy("shard", "block"))
        return keyed.applyInArrow(_search(k), FOUND)

    home = asked.withColumn("shard", F.col("home")).withColumn("least", F.lit(None).cast("long"))
    near = materialise(searched(home), "home")
    by_score = Window.partitionBy("tag").orderBy(F.desc("score"), "vec_id")
    reach = near.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") == k)
    others = asked.join(reach.select("tag", F.col("score").alias("least")), "tag", "left")
    others = others.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("shard <> home")
    found = near.unionByName(searched(others.select("tag", "query_id", "v", "block", "shard", "least")))
    return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
