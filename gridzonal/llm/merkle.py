"""A Merkle manifest of a dataset, stored in blocks with van Emde Boas layout.

A leaf is the digest of a row; per source, leaves ascend by id, and every ``ARITY`` consecutive nodes become their digest until one
is left, the source's subroot. Subroots, ordered by source, make a tree of the same kind, whose top is the root.

A tree is cut into aligned blocks of ``HEIGHT`` levels above their leaves. A block is one row of the stored manifest: its nodes lie
in one array, recursively split at half height, the top subtree first and the bottom subtrees after it from left to right
(``address``), with no room for nodes that a last, partial block lacks. Address arithmetic serves construction and the retrieval of siblings, and
blocks need no pointers. The roots of a layer's blocks are the leaves of the next layer's, until each tree has one block. No task
sees more of a source than one block; positions come from a range sort and counts of its partitions.

A null id sorts first and is never tampered with; rows of equal id are ordered by their digest, and repeated rows are leaves each; a null source is a
source of its own, before the others; null columns count as ``-``, other than empty ones; an empty table gives an empty result. Columns
other than the five hashed ones are not read. Very long texts are hashed in the JVM, whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridzonal.operators.joins import join_checked
from gridzonal.storage import fresh_path, materialise

ARITY = 3
HEIGHT = 6
# Rows of paths that may be broadcast: some 3 KB each.
BROADCAST_PATHS = 10_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

BLOCK = "source string, block bigint, size bigint, levels int, nodes binary, ids array<bigint>, tampered array<binary>, root string"
_BLOCK_TYPES = (
    pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.string(),
)
_BLOCK_NAMES = ("source", "block", "size", "levels", "nodes", "ids", "tampered", "root")
PROVED = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def counts_of(size: int, levels: int) -> list[int]:
    """Nodes of each level of a tree over ``size`` leaves, the leaves first."""
    return [-(-size // ARITY**level) for level in range(levels)]


def levels_of(size: int) -> int:
    """Levels of the tree over ``size`` leaves, from the leaves to one node."""
    levels = 1
    while ARITY ** (levels - 1) < size:
        levels += 1
    return levels


def address(level: int, index: int, levels: int, size: int) -> int:
    """Where the node ``index`` of ``level`` lies in the array of a tree of ``levels`` over ``size`` leaves.

    The upper half of the levels is stored first, in this layout, then each tree of the lower half.
    """
    base = 0
    while levels > 1:
        top = levels // 2
        bottom = levels - top
        if level >= bottom:
            level, levels, size = level - bottom, top, -(-size // ARITY**bottom)
            continue
        tree, index = divmod(index, ARITY ** (bottom - 1 - level))
        base += sum(counts_of(-(-size // ARITY**bottom), top)) + tree * sum(ARITY**k for k in range(bottom))
        levels, size = bottom, min(size - tree * ARITY ** (bottom - 1), ARITY ** (bottom - 1))
    return base


@lru_cache(maxsize=256)
def _addresses(size: int, levels: int) -> list[list[int]]:
    return [[address(level, i, levels, size) for i in range(count)] for level, count in enumerate(counts_of(size, levels))]


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def build_block(leaves: list[str], levels: int) -> list[str]:
    """The nodes of a block in the layout."""
    at = _addresses(len(leaves), levels)
    nodes = [""] * sum(map(len, at))
    for place, leaf in zip(at[0], leaves):
        nodes[place] = leaf
    for below, level in zip(at, at[1:]):
        for i, place in enumerate(level):
            nodes[place] = _digest("".join([nodes[k] for k in below[ARITY * i : ARITY * i + ARITY]]))
    return nodes


def siblings(nodes: list[str], index: int, levels: int, size: int) -> list[tuple[str, str]]:
    """(left siblings, right siblings) of a leaf and of each node above it, below the block's root."""
    at, found = _addresses(size, levels), []
    for level in range(levels - 1):
        first = index - index % ARITY
        run = at[level]
        found.append(
            ("".join([nodes[k] for k in run[first:index]]), "".join([nodes[k] for k in run[index + 1 : first + ARITY]]))
        )
        index //= ARITY
    return found


def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _leaf(text: Column) -> Column:
    fields = [text if name == "text" else F.col(name) for name in FIELDS]
    return F.sha2(F.concat(*map(_field, fields)).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, tampered): digests of all rows as they are, and of those with an even checksum as tampered with.

    ``tampered`` is null where nothing was done to the row.
    """
    even = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
    changed = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    return docs.select(*FIELDS).select(
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("long").alias("doc_id"),
        _leaf(F.col("text")).alias("leaf"),
        F.when(even, _leaf(changed)).alias("tampered"),
    )


def _positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the rank from 0 within ``group``, and ``n``, the rows of the group.

    Partitions of the range sort count their rows; the counts are summed per group.
    """
    by = [F.asc_nulls_first(name) for name in [group, *order]]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # The lower 33 bits of the id number the rows of a partition.
    numbered = ordered.withColumns(
        {"_file": F.spark_partition_id(), "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    ).withColumn("_group", F.coalesce(F.concat(F.lit("s:"), group), F.lit("null")))
    written = materialise(numbered, "sorted")
    parts = written.groupBy("_group", "_file").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_held"))
    whole = Window.partitionBy("_group")
    starts = parts.select(
        "_group",
        "_file",
        (F.sum("_held").over(whole.orderBy("_file")) - F.col("_held") - F.col("_first")).alias("_shift"),
        F.sum("_held").over(whole).alias("n"),
    )
    starts = materialise(starts, "starts")
    placed = join_checked(written, starts, ["_group", "_file"], starts.count())
    return placed.select(*rows.columns, (F.col("_row") + F.col("_shift")).alias("pos"), "n")


def _build(height: int):
    size_of_block = ARITY**height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the rows of the block at hand

        def block() -> pa.RecordBatch:
            source, number, n = held[0][0], held[0][1], held[0][2]
            # A tree of several blocks has all its levels in each.
            levels = height + 1 if n > size_of_block else levels_of(n)
            nodes = build_block([row[5] for row in held], levels)
            tampered = [None if row[6] is None else bytes.fromhex(row[6]) for row in held]
            values = (
                source, number, len(held), levels, bytes.fromhex("".join(nodes)), [row[4] for row in held], tampered,
                nodes[address(levels - 1, 0, levels, len(held))],
            )
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, _BLOCK_TYPES)], names=_BLOCK_NAMES)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("source", "block", "n", "pos", "doc_id", "leaf", "tampered")]
            for row in zip(*columns):
                if held and row[:2] != held[0][:2]:
                    yield block()
                    held.clear()
                held.append(row)
        if held:
            yield block()

    return run


def _blocks(placed: DataFrame, height: int) -> DataFrame:
    """One row per aligned block of ``placed`` (source, doc_id, leaf, tampered, pos, n)."""
    cut = placed.withColumn("block", F.floor(F.col("pos") / F.lit(ARITY**height)).cast("long"))
    together = cut.repartition("source", "block").sortWithinPartitions("source", "block", "pos")
    chosen = together.select("source", "block", "n", "pos", "doc_id", "leaf", "tampered")
    return chosen.mapInArrow(_build(height), BLOCK)


class Manifest:
    """The stored layers of all source trees, those of the tree over subroots, and the root (None if there are no rows)."""

    def __init__(self, layers: list[DataFrame], tops: list[DataFrame], root: str | None):
        self.layers, self.tops, self.root = layers, tops, root


def _store(spark: SparkSession, placed: DataFrame, path: str, name: str, height: int) -> list[DataFrame]:
    """Write the blocks of ``placed`` and then of the roots of each layer, until every tree has one block."""
    layers = []
    while True:
        where = f"{path}/{name}-{len(layers)}"
        _blocks(placed, height).write.parquet(where)
        blocks = spark.read.schema(BLOCK).parquet(where)
        layers.append(blocks)
        several = blocks.groupBy("source").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        key = F.coalesce(F.concat(F.lit("s:"), "source"), F.lit("null"))
        roots = blocks.select("source", key.alias("_key"), F.col("block").alias("pos"), F.col("root").alias("leaf"))
        upper = roots.join(several.select(key.alias("_key"), "n"), "_key").selectExpr(
            "source", "CAST(NULL AS BIGINT) AS doc_id", "leaf", "CAST(NULL AS STRING) AS tampered", "pos", "n"
        )
        placed = materialise(upper, "block-roots")
        if placed.isEmpty():
            return layers


def _tops(layers: list[DataFrame]) -> DataFrame:
    """(source, leaf) of the trees' tops: block 0 of a source that has no other block in the layer."""
    found = None
    for layer in layers:
        alone = layer.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("leaf")).filter("n = 1")
        alone = alone.select("source", "leaf")
        found = alone if found is None else found.unionByName(alone)
    return found


def build_manifest(docs: DataFrame, path: str, height: int = HEIGHT) -> Manifest:
    """Hash every row of ``docs`` and store the manifest's blocks below ``path``."""
    spark = docs.sparkSession
    hashed = materialise(leaves(docs), "leaves")
    layers = _store(spark, _positions(hashed, "source", ["doc_id", "leaf"]), path, "sources", height)
    # The tree over subroots: its group is one, and the source is what orders it.
    subroots = _tops(layers).selectExpr(
        "CAST(NULL AS STRING) AS whole", "source AS own", "CAST(NULL AS BIGINT) AS doc_id", "leaf", "CAST(NULL AS STRING) AS tampered"
    )
    placed = _positions(subroots, "whole", ["own"])
    placed = materialise(placed, "subroots")
    tops = _store(spark, placed.selectExpr("whole AS source", "doc_id", "leaf", "tampered", "pos", "n"), path, "root", height)
    top = tops[-1].first()
    placed.select(F.col("own").alias("source"), "leaf", "pos").write.parquet(f"{path}/subroots")
    return Manifest(layers, tops, None if top is None else top["root"])


def _down(height: int):
    """Blocks with the path above them to (source, block of the layer below, path of that block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, above = _unpacked(row["nodes"]), row["path"] or ""
                paths = [
                    _written(siblings(nodes, i, row["levels"], row["size"])) + above for i in range(row["size"])
                ]
                first = row["block"] * ARITY**height
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["source"]] * row["size"], pa.string()),
                        pa.array(np.arange(first, first + row["size"])),
                        pa.array(paths, pa.string()),
                    ],
                    names=["source", "block", "path"],
                )

    return run


def _unpacked(nodes: bytes) -> list[str]:
    text = nodes.hex()
    return [text[k : k + 64] for k in range(0, len(text), 64)]


def _written(path: list[tuple[str, str]]) -> str:
    """A path as text: levels end in ';', with ',' between the siblings on the left and those on the right."""
    return "".join([f"{left},{right};" for left, right in path])


def _read(path: str) -> list[tuple[str, str]]:
    return [tuple(level.split(",")) for level in path.split(";")[:-1]]


def _with_paths(blocks: DataFrame, paths: DataFrame | None) -> DataFrame:
    if paths is None:
        return blocks.withColumn("path", F.lit(""))
    key = F.coalesce(F.concat(F.lit("s:"), "source"), F.lit("null"))
    known = paths.select(key.alias("_key"), F.col("block"), "path")
    small = paths.count() <= BROADCAST_PATHS
    joined = blocks.withColumn("_key", key).join(F.broadcast(known) if small else known, ["_key", "block"], "left")
    return joined.drop("_key")


def _prove(root: str):
    def fold(node: str, path: list[tuple[str, str]]) -> str:
        for left, right in path:
            node = _digest(left + node + right)
        return node

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, levels, size = _unpacked(row["nodes"]), row["levels"], row["size"]
                above, upper = _read(row["path"] or ""), _read(row["upper"] or "")
                rest = "".join([left + right for left, right in above + upper])
                # The top of the source's tree is what the path inside the source folds to.
                subroot = fold(row["root"], above)
                at, out = _addresses(size, levels)[0], []
                for i, (number, tampered) in enumerate(zip(row["ids"], row["tampered"])):
                    own = siblings(nodes, i, levels, size)
                    proof = hashlib.sha256(("".join([left + right for left, right in own]) + rest).encode()).hexdigest()
                    leaf = nodes[at[i]]
                    folded = fold(leaf if tampered is None else tampered.hex(), own + above + upper)
                    out.append((number, leaf, subroot, root, proof, folded, folded == root))
                kinds = (pa.int64(), *[pa.string()] * 5, pa.bool_())
                names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def proofs(manifest: Manifest, spark: SparkSession, path: str, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per leaf.

    Paths go from the root down: a layer's blocks hand each block of the layer below the siblings above it.
    """
    if manifest.root is None:
        return spark.createDataFrame([], PROVED)
    paths = None
    for layer in reversed(manifest.tops):
        below = _with_paths(layer, paths).select("source", "block", "size", "levels", "nodes", "path")
        paths = materialise(below.mapInArrow(_down(height), "source string, block bigint, path string"), "paths")
    subroots = spark.read.parquet(f"{path}/subroots")
    upper = join_checked(subroots, paths.select(F.col("block").alias("pos"), F.col("path").alias("upper")), ["pos"], None)
    key = F.coalesce(F.concat(F.lit("s:"), "source"), F.lit("null"))
    upper = materialise(upper.select(key.alias("_key"), "upper"), "upper-paths")
    paths = None
    for layer in reversed(manifest.layers[1:]):
        below = _with_paths(layer, paths).select("source", "block", "size", "levels", "nodes", "path")
        found = below.mapInArrow(_down(height), "source string, block bigint, path string")
        paths = materialise(found, "paths")
    blocks = _with_paths(manifest.layers[0], paths).withColumn("_key", key)
    small = upper.count() <= BROADCAST_PATHS
    whole = blocks.join(F.broadcast(upper) if small else upper, "_key")
    chosen = whole.select("size", "levels", "nodes", "ids", "tampered", "root", "path", "upper")
    return chosen.mapInArrow(_prove(manifest.root), PROVED)


def merkle_proofs(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Build the manifest of ``docs`` below the shared folder and prove every row by it."""
    spark = docs.sparkSession
    path = fresh_path(spark, "merkle")
    return proofs(build_manifest(docs, path, height), spark, path, height)
