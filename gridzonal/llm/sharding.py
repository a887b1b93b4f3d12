"""Shards of near-equal bytes by K-d tree partitioning of the metadata.

Every document is a point: its metadata columns scaled to [0, 1] over the whole table. A node of the tree that must still hold several
shards is split along the dimension in which its bounding box is widest, at the weighted median of that dimension, bytes being the
weights; if its shards don't halve, at the quantile that gives each side its part. The median is found by distributed
histograms: up to ``BINS`` bins over the node's box, then over the bin that the median lies in, until that bin holds at most ``EDGE_ROWS``
rows. Those are dealt one by one, the heaviest first, to the side that still lacks more, so that large documents at a cut don't make
shards unequal. A value that many rows share, such as a source with a third of all rows, is cut
by a hash of the row. All nodes of a level share a job, which sends the driver one row per node, and the edge rows in the end. Every shard
is one leaf, so its documents are neighbours in the metadata, and with it come the bounds by which a reader can skip it.

The tree is all that is kept between passes: the shard of a document is an expression over its columns and the tree, one broadcast
row of at most ``EDGE_ROWS`` numbers a shard. Documents are
exchanged once, by shard and a hashed bucket of some ``BUCKET_BYTES``, and numbered inside buckets, so that no task holds a whole shard.

A null coordinate, or one that is not a number, lies below all others and infinite ones at the ends; a null or empty text weighs
``ROW_BYTES``. A text heavier than a shard gets one that is heavier than the others by that much. Ties are cut by the hash; rows
equal in every column read (id, text and dimensions) stay together, and equal texts as such don't. An empty table gives an empty
result. All columns of the input are stored inside one struct, so their names can't clash; repeated rows are kept each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridzonal.operators.joins import join_checked
from gridzonal.storage import materialise

ROW_BYTES = 16
DIMENSIONS = ("source", "lang", "n_chars", "doc_id")
BINS = 4096
EDGE_ROWS = 256
BIN_ROWS = 32  # on average, where there are fewer than BINS times as many
BUCKET_BYTES = 64 << 20

_PREFIX = 6  # bytes of a string, behind what all strings share, that make its coordinate
_BELOW = -1.0 / 16  # where nulls lie
_LAST = (1 << 63) - 1


@dataclass
class Node:
    """A leaf of the growing tree, or an inner node with the cut that its left rows are at or below.

    ``edge`` holds the hashes of the rows above the cut, up to the coordinate ``upto``, that belong to the left all the same.
    """

    first: int
    shards: int
    bytes: int = 0
    rows: int = 0
    low: list[float] = field(default_factory=list)
    high: list[float] = field(default_factory=list)
    dimension: int | None = None
    cut: tuple[float, int] | None = None
    upto: float = -math.inf
    edge: list[int] = field(default_factory=list)
    left: "Node | None" = None
    right: "Node | None" = None

    def depth(self) -> int:
        return 0 if self.left is None else 1 + max(self.left.depth(), self.right.depth())

    def leaves(self) -> list["Node"]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()


@dataclass
class ShardTree:
    """The tree and how columns become coordinates."""

    dimensions: tuple[str, ...]
    scales: list[tuple]
    root: Node

    @property
    def shards(self) -> int:
        return self.root.shards

    def bounds(self) -> list[tuple[int, int, list[float], list[float]]]:
        """(shard, bytes, lowest coordinates, highest coordinates) of every shard."""
        return [(leaf.first, leaf.bytes, leaf.low, leaf.high) for leaf in self.root.leaves()]


def row_bytes(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def _is_text(docs: DataFrame, name: str) -> bool:
    return isinstance(docs.schema[name].dataType, (T.StringType, T.BinaryType))


def _number(docs: DataFrame, name: str) -> Column:
    days = isinstance(docs.schema[name].dataType, T.DateType)
    value = (F.unix_date(name) if days else F.col(name)).cast("double")
    return F.when(~F.isnan(value), value)


def _scales(docs: DataFrame, dimensions: Sequence[str]) -> list[tuple]:
    """Per dimension: ("text", bytes all share) or ("number", lowest, highest) of the finite values."""
    ends = []
    for at, name in enumerate(dimensions):
        if _is_text(docs, name):
            value = F.col(name).cast("binary")
        else:
            value = F.when(F.abs(_number(docs, name)) < float("inf"), _number(docs, name))
        ends += [F.min(value).alias(f"low{at}"), F.max(value).alias(f"high{at}")]
    found = docs.agg(*ends).first()
    scales = []
    for at, name in enumerate(dimensions):
        low, high = found[f"low{at}"], found[f"high{at}"]
        if not _is_text(docs, name):
            scales.append(("number", low if low is not None else 0.0, high if high is not None else 0.0))
            continue
        low, high = bytes(low or b""), bytes(high or b"")
        same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        ends = [int.from_bytes(end[same : same + _PREFIX].ljust(_PREFIX, b"\0"), "big") for end in (low, high)]
        scales.append(("text", same, *ends))
    return scales


def _coordinate(docs: DataFrame, name: str, scale: tuple) -> Column:
    if scale[0] == "text":
        _kind, same, low, high = scale
        part = F.substring(F.col(name).cast("binary"), same + 1, _PREFIX)
        value = F.conv(F.rpad(F.hex(part), 2 * _PREFIX, "0"), 16, 10).cast("double")
        low, high = float(low), float(high)
    else:
        _kind, low, high = scale
        value = F.when(_number(docs, name).isNotNull(), F.greatest(F.least(_number(docs, name), F.lit(high)), F.lit(low)))
    scaled = (value - F.lit(low)) / F.lit(high - low) if high > low else F.when(value.isNotNull(), F.lit(0.0))
    return F.coalesce(scaled, F.lit(_BELOW))


def _points(docs: DataFrame, dimensions: Sequence[str], scales: list[tuple], id_col: str, text_col: str) -> list[Column]:
    """A row's coordinates, the hash that cuts ties, and its bytes."""
    tie = F.xxhash64(F.lit("shard"), id_col, text_col, *dimensions)
    coordinates = F.array(*[_coordinate(docs, name, scale) for name, scale in zip(dimensions, scales)])
    return [coordinates.alias("_u"), tie.alias("_tie"), row_bytes(text_col).alias("_size")]


TREE = (
    "_dims array<int>, _cuts array<double>, _ties array<bigint>, _upto array<double>, _edges array<array<bigint>>, "
    "_lefts array<int>, _rights array<int>, _firsts array<int>"
)
_STEP = """CASE WHEN _u[_dims[node]] < _cuts[node] OR (_u[_dims[node]] = _cuts[node] AND _tie <= _ties[node])
    OR (_u[_dims[node]] <= _upto[node] AND array_contains(_edges[node], _tie)) THEN _lefts[node] ELSE _rights[node] END"""


def _with_leaf(points: DataFrame, root: Node, name: str = "_leaf") -> DataFrame:
    """``points`` with the first shard of the leaf that each is in: as many steps down the tree as it has levels."""
    nodes = [root]
    for node in nodes:
        if node.left is not None:
            nodes += [node.left, node.right]
    at = {id(node): number for number, node in enumerate(nodes)}
    rows = []
    for number, node in enumerate(nodes):
        if node.left is None:
            rows.append((0, math.inf, _LAST, math.inf, [], number, number, node.first))
        else:
            rows.append((node.dimension, *node.cut, node.upto, node.edge, at[id(node.left)], at[id(node.right)], node.first))
    tree = points.sparkSession.createDataFrame([tuple(map(list, zip(*rows)))], TREE)
    end = f"_firsts[aggregate(sequence(1, {max(1, root.depth())}), 0, (node, _level) -> {_STEP})]"
    return points.join(F.broadcast(tree)).select(*[F.col(f"`{c}`") for c in points.columns], F.expr(end).alias(name))


@dataclass
class _Search:
    """Where the cut of a node may still lie: an interval of the coordinate, then of the hash at one coordinate."""

    node: Node
    dimension: int
    wanted: float
    low: float
    high: float
    rows: int
    below: float = 0.0
    tied: float | None = None
    tie_low: int = -(1 << 63)
    tie_high: int = _LAST
    done: bool = False
    lacks: list[float] | None = None


SEARCHES = (
    "_leaf int, dimension int, wanted double, low double, high double, is_tied boolean, tie_low bigint, tie_high bigint, "
    "halved boolean, step bigint, bins int"
)


def _search_row(search: _Search) -> tuple:
    width = search.tie_high - search.tie_low
    # Halves keep the distance of two 64-bit hashes within 64 bits.
    halved = width >= _LAST
    bins = min(BINS, max(2, search.rows // BIN_ROWS))
    step = -(-((width // 2 if halved else width) + 1) // bins)
    ends = (search.low, search.high, search.tied is not None, search.tie_low, search.tie_high)
    return (search.node.first, search.dimension, search.wanted - search.below, *ends, halved, step, bins)


#: The bin of a row: of its coordinate, or of its hash where all rows in question have the same coordinate.
_BIN = """CASE WHEN NOT is_tied THEN least(floor((value - low) / (high - low) * bins), bins - 1)
    WHEN halved THEN floor((shiftright(_tie, 1) - shiftright(tie_low, 1)) / step) ELSE floor((_tie - tie_low) / step) END"""


def _in_question(placed: DataFrame, searches: list[_Search]) -> DataFrame:
    """The rows among which the cuts of ``searches`` lie."""
    # One row per node that is being split, so fewer rows than shards.
    table = placed.sparkSession.createDataFrame([_search_row(s) for s in searches], SEARCHES)
    rows = placed.join(F.broadcast(table), "_leaf").withColumn("value", F.get("_u", "dimension"))
    return rows.filter("value BETWEEN low AND high AND (NOT is_tied OR _tie BETWEEN tie_low AND tie_high)")


def _narrow(search: _Search, found: Row, edge_rows: int) -> None:
    """Go on inside the bin ``found``, or settle the cut at its lower end."""
    prior, node = found["earlier"], search.node
    search.below += found["upto"] - found["held"]
    search.rows = found["number"]
    alone = found["low"] == found["high"] and found["tie_low"] == found["tie_high"]
    if alone or found["number"] <= edge_rows:
        if prior is not None:
            cut = (prior["high"], _LAST) if search.tied is None else (search.tied, prior["tie_high"])
        elif search.tied is not None and search.tie_low > -(1 << 63):
            cut = (search.tied, search.tie_low - 1)
        else:
            cut = (math.nextafter(search.low, -math.inf), _LAST)
        node.dimension, node.cut, node.upto, search.done = search.dimension, cut, found["high"], True
    if search.tied is None and (search.done or found["low"] < found["high"]):
        search.low, search.high = found["low"], found["high"]
    else:
        search.tied = search.low = search.high = found["low"]
        search.tie_low, search.tie_high = found["tie_low"], found["tie_high"]


def _find_cuts(points: DataFrame, root: Node, searches: list[_Search], edge_rows: int) -> None:
    """Narrow all searches together, a job for every round, until each has its cut; then deal the rows at the edges."""
    by_first = {s.node.first: s for s in searches}
    placed = _with_leaf(points, root)
    by_bin, node = Window.partitionBy("_leaf").orderBy("_bin"), Window.partitionBy("_leaf")
    while not all(s.done for s in searches):
        rows = _in_question(placed, [s for s in searches if not s.done])
        # At most BINS rows for each of the nodes.
        bins = rows.groupBy("_leaf", "wanted", F.expr(_BIN).cast("int").alias("_bin")).agg(
            F.sum("_size").alias("held"),
            F.count(F.lit(1)).alias("number"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.min("_tie").alias("tie_low"),
            F.max("_tie").alias("tie_high"),
        )
        summed = bins.select(
            "*",
            F.sum("held").over(by_bin).alias("upto"),
            F.lag(F.struct("high", "tie_high")).over(by_bin).alias("earlier"),
            F.max("_bin").over(node).alias("_last"),
        )
        shown = F.struct("held", "number", "upto", "low", "high", "tie_low", "tie_high", "earlier")
        past = summed.filter("upto >= wanted OR _bin = _last")
        for row in past.groupBy("_leaf").agg(F.min_by(shown, "_bin").alias("hit")).collect():
            _narrow(by_first[row["_leaf"]], row["hit"], edge_rows)
    edges = _in_question(placed, searches).groupBy("_leaf", "_tie").agg(F.sum("_size").alias("held")).collect()
    for row in sorted(edges, key=lambda row: (-row["held"], row["_tie"])):
        search = by_first[row["_leaf"]]
        if search.lacks is None:
            held = sum(other["held"] for other in edges if other["_leaf"] == row["_leaf"])
            search.lacks = [search.wanted - search.below, held - (search.wanted - search.below)]
        side = 0 if search.lacks[0] >= search.lacks[1] else 1
        search.lacks[side] -= row["held"]
        if side == 0:
            search.node.edge.append(row["_tie"])


def _measure(points: DataFrame, root: Node, count: int) -> None:
    """Bytes and bounding box of every leaf."""
    ends = [F.expr(f"{name}(_u[{at}])").alias(f"{name}{at}") for at in range(count) for name in ("min", "max")]
    found = _with_leaf(points, root).groupBy("_leaf").agg(F.sum("_size").alias("held"), F.count(F.lit(1)).alias("number"), *ends).collect()
    rows = {row["_leaf"]: row for row in found}
    for leaf in root.leaves():
        row = rows.get(leaf.first)
        leaf.bytes, leaf.rows = (row["held"], row["number"]) if row else (0, 0)
        leaf.low = [row[f"min{at}"] for at in range(count)] if row else []
        leaf.high = [row[f"max{at}"] for at in range(count)] if row else []


def shard_tree(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Sequence[str] = DIMENSIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
    edge_rows: int = EDGE_ROWS,
) -> ShardTree:
    """The tree whose leaves are the shards: ``shards`` of them, or as many as ``target_bytes`` asks for.

    Texts are read once, for their size and hash.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either the number of shards or their target bytes")
    scales = _scales(docs, dimensions)
    points = materialise(docs.select(*_points(docs, dimensions, scales, id_col, text_col)), "points")
    total = points.agg(F.sum("_size")).first()[0] or 0
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    root = Node(0, shards)
    while True:
        _measure(points, root, len(dimensions))
        open_leaves = [leaf for leaf in root.leaves() if leaf.shards > 1]
        if not open_leaves:
            return ShardTree(tuple(dimensions), scales, root)
        searches = []
        for leaf in open_leaves:
            if leaf.bytes == 0:
                leaf.dimension, leaf.cut = 0, (_BELOW, _LAST)
                continue
            widths = [high - low for low, high in zip(leaf.low, leaf.high)]
            widest = widths.index(max(widths))
            wanted = leaf.bytes * (leaf.shards // 2) / leaf.shards
            search = _Search(leaf, widest, wanted, leaf.low[widest], leaf.high[widest], leaf.rows)
            if search.low == search.high:
                search.tied = search.low
            searches.append(search)
        _find_cuts(points, root, searches, edge_rows)
        for leaf in open_leaves:
            half = leaf.shards // 2
            leaf.left, leaf.right = Node(leaf.first, half), Node(leaf.first + half, leaf.shards - half)


def write_shards(
    docs: DataFrame, tree: ShardTree, path: str, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> None:
    """Store every row of ``docs`` below ``path``, in a folder for each shard, as a struct ``document`` with its place."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    largest = max((leaf.bytes for leaf in tree.root.leaves()), default=0)
    buckets = max(1, -(-largest // bucket_bytes), -(-4 * partitions // tree.shards))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), *_points(docs, tree.dimensions, tree.scales, id_col, text_col))
    bucket = F.pmod(F.xxhash64("_tie"), F.lit(buckets)).cast("int").alias("bucket")
    dealt = _with_leaf(held, tree.root, "shard").select("document", "shard", bucket)
    order = Window.partitionBy("shard", "bucket").orderBy(F.col(f"document.{id_col}"))
    placed = dealt.withColumn("place", (F.row_number().over(order) - 1).cast("long"))
    placed.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, document: T.StructType) -> DataFrame:
    """(shard, slot, document): slots of a shard count from 0 without gaps."""
    stored_type = T.StructType(
        [
            T.StructField("document", document),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("place", T.LongType()),
            T.StructField("shard", T.IntegerType()),
        ]
    )
    stored = spark.read.schema(stored_type).parquet(path)
    counts = stored.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("held"))
    # One row per bucket, so the running sum of a shard is short.
    before = F.sum("held").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("held")
    starts = materialise(counts.select("shard", "bucket", before.alias("start")), "bucket-starts")
    placed = join_checked(stored, starts, ["shard", "bucket"], starts.count())
    return placed.select("shard", (F.col("start") + F.col("place")).alias("slot"), "document")
