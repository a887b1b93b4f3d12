"""Exact near-duplicate join on word shingles by vertical partitioning.

The n-grams have one global order, cut into fragments. Pass one sends each document's set to the fragments, slice by slice:
a fragment learns which of its n-grams occur in more than one document. An n-gram that many documents of a slice share
is known to be common there and is sent once, without them. A document can only have a partner if enough of its n-grams are
shared, so most leave here with their set size. Pass two works on one representative for every set: candidates share an n-gram of
the prefix, rarest first, that two sets must share, with enough n-grams after it in both; each candidate pair's overlap
is counted fragment by fragment on its own and summed per pair. Candidates come in rounds: first every document with the one of its prefix list
that has the fewest rarer n-grams; then, in lists that still hold more than one component, pairs across
components. Pairs inside a component can't change the result, so a large group of near copies costs its members, not its pairs.
Nor do two components cost the product of their members: one representative of each is compared first. The distance
1 - intersection / union is a metric, so if the representatives are further apart than the threshold and the radii of both
components allow, no two members can link; if they link themselves, the components are one. Members are paired only between these
cases, and only where their own distances from the representatives leave it open. No link between components is lost.

Null and empty texts, and texts of separators only, have the empty set and no links; fewer words than the shingle's size are one
shingle. Repeated rows and ids are documents each; a null id never becomes a component's id unless no other is there. An empty table
gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.llm.graph import components
from gridzonal.llm.skew import attach_group, free_name
from gridzonal.llm.text import Words, from_planes, give_back, mix, raw_texts, shard_of, shingles, slices, to_planes
from gridzonal.storage import materialise

WORDS = 5
PERCENT = 80
SLICE_BYTES = 2 << 20
FRAGMENTS = 4  # of the overlap count; the first pass has as many as the session has shuffle partitions
COMMON = 4  # documents of a slice from which on an n-gram is sent once for all of them
DROPPED_BITS = np.uint64(8)

BLOCKS = "slice bigint, fragment int, kind string, tags array<bigint>, ids array<bigint>, a binary, b binary, c binary"
_KINDS = (pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 3)
_NAMES = ("slice", "fragment", "kind", "tags", "ids", "a", "b", "c")


def _rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * len(_NAMES)
    return pa.table([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    heads = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    return heads, np.diff(np.append(heads, len(values)))


def _segments(size: int, fragments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The upper 31 bits are the partition and the lower 32 count its slices, or for tags its rows.
        number = base = TaskContext.get().partitionId() << 32
        seen = 0
        for batch in batches:
            texts, ids = raw_texts(batch.column("text")), batch.column("doc_id").to_pylist()
            for first, last in slices(texts, SLICE_BYTES):
                words = Words(texts[first:last])
                row, value = shingles(words.hashes(), words.counts, size)
                value = value >> DROPPED_BITS
                order = np.lexsort((row, value))
                row, value = row[order], value[order]
                new = np.concatenate([[True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])]) if len(row) else row == 0
                row, value = row[new], value[new]
                held = np.bincount(row, minlength=last - first)
                # Two sums over the set, equal for equal sets whatever their order.
                signs = [np.zeros(last - first, dtype=np.uint64) for _ in range(2)]
                for sign, seed in zip(signs, (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))):
                    np.add.at(sign, row, mix(value + seed))
                if seen + last - first > 1 << 32:
                    raise ValueError("a partition holds more than 2**32 rows; repartition the table")
                tags = range(base + seen, base + seen + last - first)
                seen += last - first
                some = int(mix(np.array([number], dtype=np.uint64))[0] >> np.uint64(1)) % fragments
                blobs = (to_planes(held), signs[0].tobytes(), signs[1].tobytes())
                rows = [(number, some, "sets", tags, ids[first:last], *blobs)]
                heads, runs = _runs(value)
                common = np.repeat(runs >= COMMON, runs)
                shared = heads[runs >= COMMON]
                place = shard_of(value << DROPPED_BITS, fragments)
                lone_edges = np.searchsorted(place[~common], np.arange(fragments + 1))
                shared_edges = np.searchsorted(place[shared], np.arange(fragments + 1))
                lone_row, lone_value = row[~common], value[~common]
                for fragment in range(fragments):
                    a, b = lone_edges[fragment : fragment + 2]
                    c, d = shared_edges[fragment : fragment + 2]
                    if b > a or d > c:
                        blobs = (to_planes(lone_value[a:b]), to_planes(lone_row[a:b]), to_planes(value[shared[c:d]]))
                        rows.append((number, fragment, "asked", None, None, *blobs))
                if common.any():
                    rows.append((number, some, "common", None, None, to_planes(value[common]), to_planes(row[common]), None))
                yield from _rows(rows).to_batches()
                number += 1
        give_back()

    return run


#: Stands for the number of documents of an n-gram that some slice found common; such n-grams come last in the order.
_MANY = np.uint64((1 << 32) - 1)


def _find_shared(table: pa.Table) -> pa.Table:
    """Answers with the n-grams that more than one document has, and how many have them."""
    kinds = np.array(table.column("kind").to_pylist())
    fragment = table.column("fragment")[0].as_py()
    kept = table.filter(pa.array(kinds != "asked")).to_pylist()
    rows = [tuple(r[n] for n in _NAMES) for r in kept]
    asked = table.filter(pa.array(kinds == "asked")).select(["slice", "a", "b", "c"]).to_pylist()
    values = [from_planes(r["a"]) for r in asked]
    common = np.unique(np.concatenate([np.zeros(0, np.uint64), *(from_planes(r["c"]) for r in asked)]))
    distinct, own, number = np.unique(
        np.concatenate([np.zeros(0, np.uint64), *values]), return_inverse=True, return_counts=True
    )
    number = np.where(np.isin(distinct, common), _MANY, number.astype(np.uint64))
    edges = np.cumsum([0, *map(len, values)])
    for row, value, a, b in zip(asked, values, edges[:-1], edges[1:]):
        seen = number[own[a:b]]
        keep = seen > 1
        if keep.any():
            blobs = (to_planes(value[keep]), to_planes(from_planes(row["b"])[keep]), to_planes(seen[keep]))
            rows.append((row["slice"], fragment, "shared", None, None, *blobs))
    return _rows(rows)


def _lean(work):
    """``work`` on a group, after which the worker keeps nothing of it: the stages that follow need the executor's memory."""

    def run(table: pa.Table) -> pa.Table:
        try:
            return work(table)
        finally:
            give_back()

    return run


SETS = "tag bigint, doc_id bigint, n bigint, sign string, prefix int, items array<bigint>"


def _assemble(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sets = next(r for r in rows if r["kind"] == "sets")
        size = from_planes(sets["a"]).astype(np.int64)
        signs = [np.frombuffer(sets[k], "<u8").tolist() for k in ("b", "c")]
        parts = [r for r in rows if r["kind"] in ("shared", "common")]
        none = np.zeros(0, np.uint64)
        value = np.concatenate([none, *(from_planes(r["a"]) for r in parts)])
        doc = np.concatenate([none, *(from_planes(r["b"]) for r in parts)]).astype(np.int64)
        seen = np.concatenate(
            [none, *(from_planes(r["c"]) if r["c"] else np.full(len(from_planes(r["a"])), _MANY) for r in parts)]
        )
        held = np.bincount(doc, minlength=len(size))
        able = (size > 0) & (100 * held >= percent * size)
        keep = able[doc]
        value, doc, seen = value[keep], doc[keep], seen[keep]
        order = np.lexsort((value, seen, doc))
        value, edges = value[order].astype(np.int64), np.searchsorted(doc[order], np.arange(len(size) + 1))
        # A partner has at least so many of the set; what may be missing, less the n-grams nobody shares, bounds the prefix.
        prefix = np.where(able, size - -(-percent * size // 100) + 1 - (size - held), 0)
        items = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(value))
        return pa.table(
            {
                "tag": pa.array(sets["tags"], pa.int64()),
                "doc_id": pa.array(sets["ids"], pa.int64()),
                "n": pa.array(size),
                "sign": pa.array([f"{n}:{a:016x}{b:016x}" for n, a, b in zip(size.tolist(), *signs)]),
                "prefix": pa.array(prefix.astype(np.int32)),
                "items": items,
            }
        )

    return run


def shingle_sets(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, fragments: int | None = None) -> DataFrame:
    """(tag, doc_id, n, sign, prefix, items): n-grams that others have too, rarest first, of documents that may have a partner.

    ``prefix`` is 0 for the rest. Equal sets have equal ``sign``, which is 128 bits of hash and the size.
    """
    spark = docs.sparkSession
    fragments = fragments or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.mapInArrow(_segments(size, fragments), BLOCKS)
    answered = sent.groupBy("fragment").applyInArrow(_lean(_find_shared), BLOCKS)
    return answered.groupBy("slice").applyInArrow(_lean(_assemble(percent)), SETS)


def _bound(percent: int) -> str:
    """Whether two sets may link if this is their first common n-gram: ``rest`` counts those from it on in the global order.

    A pair that links passes at its first common n-gram, so what fails at a later one is not lost.
    """
    most = "least(rest_x, rest_y)"
    return f"100 * {most} >= {percent} * (nx + ny - {most})"


def with_stars(listed: DataFrame) -> DataFrame:
    """Rows of the lists that hold several, each with the row of its list that has the fewest rarer n-grams.

    A copy with few changes is close to all others of its group. One row per list is the result of a partial aggregate, and
    long lists are not gathered to get it.
    """
    order = F.struct(F.col("rest") - F.col("n"), F.col("n"), F.col("tag"))
    stars = listed.groupBy("key").agg(
        F.count(F.lit(1)).alias("held"), F.max_by(F.struct("tag", "n", "rest"), order).alias("star")
    )
    return attach_group(listed, materialise(stars.filter("held > 1"), "stars"), "key", "held")


def star_pairs(starred: DataFrame, percent: int) -> DataFrame:
    """(x, y, nx, ny) of every row and its star."""
    pairs = starred.selectExpr(
        "tag AS x", "star.tag AS y", "n AS nx", "star.n AS ny", "rest AS rest_x", "star.rest AS rest_y"
    )
    return _oriented(pairs.filter(f"x <> y AND {_bound(percent)}"))


def _oriented(pairs: DataFrame) -> DataFrame:
    """Each pair once, the smaller tag first."""
    return pairs.selectExpr(
        "least(x, y) AS x", "greatest(x, y) AS y", "if(x <= y, nx, ny) AS nx", "if(x <= y, ny, nx) AS ny"
    ).distinct()


def cut(sets: DataFrame, fragments: int) -> DataFrame:
    """(tag, part, segment): the items of every set by fragment, which is a range of the n-grams' hashes.

    A set is one row and is cut where it lies; its items are not dealt out one by one.
    """
    part = f"shiftright(item * {fragments}, {64 - int(DROPPED_BITS)})"
    parts = f"transform(sequence(0, {fragments - 1}), p -> filter(items, item -> {part} = p))"
    return sets.select("tag", F.posexplode(F.expr(parts)).alias("part", "segment")).filter("size(segment) > 0")


def overlaps(pairs: DataFrame, segments: DataFrame, fragments: int) -> DataFrame:
    """(x, y, nx, ny, common) of the pairs that have anything in common: counted in each fragment separately and summed per pair."""
    spread = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))))
    left = segments.select("part", F.col("tag").alias("x"), F.col("segment").alias("left_segment"))
    right = segments.select("part", F.col("tag").alias("y"), F.col("segment").alias("right_segment"))
    both = spread.join(left, ["part", "x"]).join(right, ["part", "y"])
    partial = both.select("x", "y", "nx", "ny", F.size(F.array_intersect("left_segment", "right_segment")).alias("common"))
    return partial.groupBy("x", "y", "nx", "ny").agg(F.sum("common").alias("common"))


def count_links(pairs: DataFrame, segments: DataFrame, percent: int, fragments: int) -> DataFrame:
    """(x, y) of the pairs that link."""
    summed = overlaps(pairs, segments, fragments)
    return summed.filter(f"100 * common >= {percent} * (nx + ny - common)").select("x", "y")


def distances(pairs: DataFrame, segments: DataFrame, percent: int, fragments: int) -> DataFrame:
    """(x, y, distance, linked) of all pairs."""
    counted = overlaps(pairs, segments, fragments).select("x", "y", "common")
    whole = pairs.join(counted, ["x", "y"], "left").fillna(0, ["common"])
    return whole.selectExpr(
        "x", "y", "1 - common / (nx + ny - common) AS distance", f"100 * common >= {percent} * (nx + ny - common) AS linked"
    )


#: More than rounding can add to a sum of three distances.
_SLACK = 1e-9


def _across(
    listed: DataFrame, labels: DataFrame, tested: DataFrame, segments: DataFrame, sizes: DataFrame, percent: int, fragments: int
) -> tuple[DataFrame, DataFrame] | None:
    """(links of representatives, pairs of other members that may link): of different components, in the lists that still hold several.

    None if no two components can link.
    """
    known = listed.join(labels, listed.tag == labels.node, "left")
    named = known.select("key", "n", "rest", "tag", F.coalesce("component", "tag").alias("component"))
    named = materialise(named, "named")
    counted = named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"))
    mixed = counted.groupBy("key").agg(
        F.count(F.lit(1)).alias("several"),
        F.sum("held").alias("held"),
        F.max_by("component", F.struct("held", "component")).alias("main"),
    )
    mixed = materialise(mixed.filter("several > 1").select("key", "held", "main"), "mixed-lists")
    inside = materialise(attach_group(named, mixed, "key", "held"), "mixed")

    # One row per list and component: no member has more n-grams from the key on, or fewer in all.
    present = inside.groupBy("key", "component", "main").agg(F.min("n").alias("n"), F.max("rest").alias("rest"))
    present = materialise(present, "list-components")
    few = present.filter("component <> main").selectExpr("key", "n AS nx", "rest AS rest_x", "component AS x")
    all_ = present.selectExpr("key", "n AS ny", "rest AS rest_y", "component AS y", "component = main AS in_main")
    lists = few.join(all_, "key").filter(f"x <> y AND (in_main OR x < y) AND {_bound(percent)}")
    lists = materialise(lists.selectExpr("key", "x AS fx", "y AS fy", "least(x, y) AS cx", "greatest(x, y) AS cy"), "near-lists")
    if lists.isEmpty():
        return None
    near = lists.selectExpr("cx AS x", "cy AS y").distinct()

    def sized(pairs: DataFrame) -> DataFrame:
        with_x = pairs.join(sizes.selectExpr("tag AS x", "n AS nx"), "x")
        return materialise(with_x.join(sizes.selectExpr("tag AS y", "n AS ny"), "y").select("x", "y", "nx", "ny"), "sized")

    # A component's name is its representative.
    members = sized(inside.filter("tag <> component").selectExpr("component AS x", "tag AS y").distinct())
    away = distances(members, segments, percent, fragments).selectExpr("y AS tag", "distance AS away")
    placed = materialise(inside.join(away, "tag", "left").fillna(0.0, ["away"]), "placed")
    radii = placed.groupBy("component").agg(F.max("away").alias("radius"))
    apart = materialise(distances(sized(near), segments, percent, fragments), "apart")
    links = materialise(apart.filter("linked").select("x", "y"), "links")
    joined = components(links)
    apart = apart.filter("NOT linked")
    for side in ("x", "y"):
        radius = radii.select(F.col("component").alias(side), F.col("radius").alias(f"radius_{side}"))
        top = joined.select(F.col("node").alias(side), F.col("component").alias(f"top_{side}"))
        apart = apart.join(radius, side).join(top, side, "left")
    reach = 1 - percent / 100 + _SLACK
    apart = apart.filter(f"distance <= {reach} + radius_x + radius_y AND coalesce(top_x, x) <> coalesce(top_y, y)")
    apart = materialise(apart.selectExpr("x AS cx", "y AS cy", "distance", "radius_x", "radius_y"), "apart")

    # Members of the component that is not the list's main one come first, and only those far enough out.
    open_lists = lists.join(apart, ["cx", "cy"]).selectExpr("key", "fx", "fy", "distance", "if(fy = cx, radius_x, radius_y) AS radius")
    left = placed.selectExpr("component AS fx", "key", "n AS nx", "rest AS rest_x", "tag AS x", "away AS away_x")
    right = placed.selectExpr("component AS fy", "key", "n AS ny", "rest AS rest_y", "tag AS y", "away AS away_y")
    outer = open_lists.join(left, ["key", "fx"]).filter(f"distance - away_x - radius <= {reach}")
    pairs = outer.join(right, ["key", "fy"]).filter(f"distance - away_x - away_y <= {reach} AND {_bound(percent)}")
    return links, materialise(_oriented(pairs).join(tested, ["x", "y"], "left_anti"), "pairs")


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WORDS,
    percent: int = PERCENT,
    fragments: int = FRAGMENTS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, set_copies), one row per row of ``docs``.

    Two documents link when 100 * intersection >= percent * union; ``component_id`` is the smallest id reachable,
    ``set_copies`` the documents with the same set.
    """
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = materialise(shingle_sets(chosen, size, percent), "sets")
    able = sets.filter("prefix > 0")
    groups = materialise(
        able.groupBy("sign").agg(
            F.min("tag").alias("tag"), F.min("doc_id").alias("low_id"), F.count(F.lit(1)).alias("set_copies")
        ),
        "groups",
    )
    chosen = materialise(able.join(groups.select("tag"), "tag", "left_semi").select("tag", "n", "prefix", "items"), "chosen")
    listed = chosen.select("n", "tag", F.size("items").alias("held"), F.posexplode(F.expr("slice(items, 1, prefix)")).alias("at", "key"))
    listed = listed.select("key", "n", "tag", (F.col("held") - F.col("at")).cast("bigint").alias("rest"))
    starred = materialise(with_stars(materialise(listed, "prefixes")), "starred")
    listed = starred.select("key", "n", "tag", "rest")
    segments = materialise(cut(chosen.join(listed.select("tag").distinct(), "tag", "left_semi"), fragments), "segments")
    pairs = materialise(star_pairs(starred, percent), "pairs")
    links = materialise(count_links(pairs, segments, percent, fragments), "links")
    labels = components(links)
    across = _across(listed, labels, pairs.select("x", "y"), segments, chosen.select("tag", "n"), percent, fragments)
    more = None
    if across is not None:
        tops, rest = across
        more = materialise(count_links(rest, segments, percent, fragments).unionByName(tops), "links")
    if more is not None and not more.isEmpty():
        joined = more.join(labels.selectExpr("node AS x", "component AS cx"), "x", "left")
        joined = joined.join(labels.selectExpr("node AS y", "component AS cy"), "y", "left")
        over = components(joined.selectExpr("coalesce(cx, x) AS x", "coalesce(cy, y) AS y"))
        upper = over.selectExpr("node AS low", "component AS top")
        old = labels.join(upper, labels.component == upper.low, "left").selectExpr("node", "coalesce(top, component) AS component")
        new = upper.join(labels, upper.low == labels.node, "left_anti").selectExpr("low AS node", "top AS component")
        labels = materialise(old.unionByName(new), "labels")
    named = groups.join(labels, groups.tag == labels.node, "left").select(
        "sign", "low_id", "set_copies", F.coalesce("component", "tag").alias("component")
    )
    lowest = named.groupBy("component").agg(F.min("low_id").alias("component_id"))
    classes = materialise(named.join(lowest, "component").select("sign", "component_id", "set_copies"), "classes")
    light = able.select("doc_id", F.col("n").alias("n_shingles"), "sign")
    columns = ["doc_id", "n_shingles", "component_id", "set_copies"]
    linked = attach_group(light, classes, "sign", "set_copies").select(*columns)
    alone = sets.filter("prefix = 0").selectExpr("doc_id", "n AS n_shingles", "doc_id AS component_id", "1L AS set_copies")
    return linked.unionByName(alone)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id is their component's, with all their columns."""
    name = free_name(docs, "_kept")
    kept = near_components(docs, id_col, text_col).filter("doc_id <=> component_id").select(F.col("doc_id").alias(name))
    return docs.join(kept, docs[id_col].eqNullSafe(F.col(name)), "left_semi")
