"""Language-model scoring of whole texts with a sharded n-gram trie.

Tokens are words (A-Z lower-cased) and an end after each text. Texts are handled in slices, and a slice asks for each of its
different words and word pairs once. Texts are read once: a slice is one stored row, tokens and words together, and all passes start from
the stored rows, so it does not matter whether a second read would cut the table elsewhere. The tokens are stored once more, bucketed by
slice. Pass one deals the words to shards by hash, counts them over all training texts and gives every word an id. Pass two deals the pairs to shards by context; a shard writes its part of the trie (see
``trie``), maps it and answers the slices that asked. Pass three adds up the texts. So every count covers all texts, no task
holds more than a shard or a slice, a frequent word or pair costs one entry per slice, and nothing of the
corpus passes through the driver but two sums.

A pair's probability is the count less ``DISCOUNT`` over the context's count, plus the discounted mass times the
word's own probability, (c + 0.1) / (N + 0.1 (V + 1)); where the context was never seen, the word's own alone.

Null and empty texts are one end. Rows with a null id teach and are scored with id null; repeated rows teach and are scored each;
without training texts N and V are 0. An empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.llm.text import Words, from_planes, mix, raw_texts, shard_of, slices, to_planes
from gridzonal.llm.trie import Trie, chances
from gridzonal.storage import fresh_path, materialise

SLICE_BYTES = 4 << 20
DISCOUNT = 0.75
ADDED = 0.1

_END = mix(np.array([0x51ED270B], dtype=np.uint64))
BLOCKS = "slice bigint, shard int, kind string, ids array<bigint>, a binary, b binary, c binary"


def held_out(number: int | None, of: int = 10) -> bool:
    return number is not None and zlib.crc32(str(number).encode()) % of == 0


def _rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * 7
    kinds = (pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
    names = ("slice", "shard", "kind", "ids", "a", "b", "c")
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _slice_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per slice: its texts' sizes, its tokens as places among its different words, and those words."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        texts, ids = raw_texts(batch.column("text")), batch.column("doc_id").to_pylist()
        for first, last in slices(texts, SLICE_BYTES):
            words = Words(texts[first:last])
            sizes = words.counts + 1
            tokens = np.empty(int(sizes.sum()), dtype=np.uint64)
            tokens[np.cumsum(sizes) - 1] = _END[0]
            tokens[np.arange(len(words.doc)) + words.doc] = words.hashes()
            del words
            distinct, own = np.unique(tokens, return_inverse=True)
            row = (number, -1, "texts", ids[first:last], to_planes(sizes), to_planes(own), to_planes(distinct))
            yield from _rows([row]).to_batches()
            number += 1


def _slice_words(shards: int):
    """The different words of every stored slice by shard, with their counts in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                held = batch.slice(at, 1).to_pylist()[0]
                sizes, own, distinct = (from_planes(held[k]) for k in ("a", "b", "c"))
                learned = np.repeat([not held_out(i) for i in held["ids"]], sizes.astype(np.int64))
                counts = np.bincount(own.astype(np.int64)[learned], minlength=len(distinct))
                edges = np.searchsorted(shard_of(distinct, shards), np.arange(shards + 1))
                rows = [
                    (held["slice"], shard, "words", None, to_planes(distinct[a:b]), to_planes(counts[a:b]), None)
                    for shard, (a, b) in enumerate(zip(edges[:-1], edges[1:]))
                    if b > a
                ]
                yield from _rows(rows).to_batches()

    return run


def _store_slices(docs: DataFrame) -> DataFrame:
    """The slices as they are cut, each a row of one task's file: no exchange lies between cutting and storing."""
    path = fresh_path(docs.sparkSession, "lm-slices")
    docs.mapInArrow(_slice_tokens, BLOCKS).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(BLOCKS).parquet(path)


def _store_texts(texts: DataFrame, buckets: int) -> DataFrame:
    """The slices' tokens as a table bucketed by slice, so that the later passes do not shuffle them."""
    name = f"lm_texts_{uuid.uuid4().hex}"
    (
        texts.repartition(buckets, "slice")
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", fresh_path(texts.sparkSession, "lm-texts"))
        .bucketBy(buckets, "slice")
        .sortBy("slice")
        .saveAsTable(name)
    )
    return texts.sparkSession.table(name)


def _count_words(shards: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        asked = [from_planes(x) for x in table.column("a").to_pylist()]
        counts = np.concatenate([from_planes(x) for x in table.column("b").to_pylist()])
        distinct, own = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(own, weights=counts, minlength=len(distinct)).astype(np.uint64)
        edges = np.cumsum([0, *map(len, asked)])
        rows = []
        for number, a, b in zip(table.column("slice").to_pylist(), edges[:-1], edges[1:]):
            ids = own[a:b] * shards + shard + 1
            rows.append((number, shard, "counts", None, to_planes(total[own[a:b]]), to_planes(ids), None))
        rows.append((-1, shard, "totals", [int(total.sum()), int((total > 0).sum())], None, None, None))
        return _rows(rows)

    return run


class _Slice:
    """A slice's tokens with the counts and ids of its words, and its different pairs in the order of their shards."""

    def __init__(self, texts: pa.Table, answers: pa.Table, shards: int):
        row = texts.slice(0, 1).to_pylist()[0]
        self.number, self.ids = row["slice"], row["ids"]
        self.sizes, self.own = from_planes(row["a"]).astype(np.int64), from_planes(row["b"]).astype(np.int64)
        found = sorted(answers.to_pylist(), key=lambda r: r["shard"])
        self.counts = np.concatenate([from_planes(r["a"]) for r in found]).astype(np.float64)
        words = np.concatenate([from_planes(r["b"]) for r in found])
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        begins = np.cumsum(self.sizes) - self.sizes
        before = np.concatenate([[0], self.own[:-1] + 1])
        before[begins] = 0  # no word before
        key = before * len(words) + self.own
        distinct, self.pair = np.unique(key, return_inverse=True)
        context, word = np.concatenate([[np.uint64(0)], words])[distinct // len(words)], words[distinct % len(words)]
        place = shard_of(mix(context + np.uint64(1)), shards)
        order = np.lexsort((word, context, place))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.pair, self.doc = rank[self.pair], doc
        self.context, self.word = context[order], word[order]
        self.edges = np.searchsorted(place[order], np.arange(shards + 1))


def _heads(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def _slice_pairs(shards: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _rows([])
        held = _Slice(texts, answers, shards)
        learned = np.repeat([not held_out(i) for i in held.ids], held.sizes)
        counts = np.bincount(held.pair[learned], minlength=len(held.word))
        rows = []
        for shard, (a, b) in enumerate(zip(held.edges[:-1], held.edges[1:])):
            if b > a:
                heads = _heads(held.context[a:b])
                runs = np.diff(np.append(heads, b - a))
                contexts = to_planes(held.context[a:b][heads])
                block = len(contexts).to_bytes(4, "little") + contexts + to_planes(runs)
                rows.append((held.number, shard, "pairs", None, block, to_planes(held.word[a:b]), to_planes(counts[a:b])))
        return _rows(rows)

    return run


def _answer_pairs(table: pa.Table) -> pa.Table:
    shard, numbers = table.column("shard")[0].as_py(), table.column("slice").to_pylist()
    asked = []
    for block, words in zip(table.column("a").to_pylist(), table.column("b").to_pylist()):
        size = int.from_bytes(block[:4], "little")
        asked.append((from_planes(block[4 : 4 + size]), from_planes(block[4 + size :]).astype(np.int64), from_planes(words)))
    counts = np.concatenate([from_planes(x) for x in table.column("c").to_pylist()])
    learned = counts > 0
    context = np.concatenate([np.repeat(c, runs) for c, runs, _w in asked])[learned]
    word, counts = np.concatenate([w for _c, _runs, w in asked])[learned], counts[learned]
    order = np.lexsort((word, context))
    context, word, counts = context[order], word[order], counts[order]
    if len(order):
        heads = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])]))
        context, word, counts = context[heads], word[heads], np.add.reduceat(counts, heads)
    # All slices ask at once, in the order of the trie.
    lengths = [len(w) for _c, _runs, w in asked]
    all_context = np.concatenate([np.repeat(c, runs) for c, runs, _w in asked])
    all_word = np.concatenate([w for _c, _runs, w in asked])
    order = np.lexsort((all_word, all_context))
    heads = _heads(all_context[order])
    contexts = all_context[order[heads]]
    codes = np.empty(len(order), dtype=np.uint8)
    with tempfile.TemporaryDirectory() as folder:
        Trie.write(Path(folder), context, word, counts, DISCOUNT)
        found, backoff = Trie(Path(folder)).look_up(contexts, np.diff(np.append(heads, len(order))), all_word[order])
        codes[order] = found
    rows = []
    edges = np.cumsum([0, *lengths])
    for number, (own, _runs, _words), a, b in zip(numbers, asked, edges[:-1], edges[1:]):
        weights = backoff[np.searchsorted(contexts, own)]
        rows.append((number, shard, "codes", None, codes[a:b].tobytes(), weights.tobytes(), None))
    return _rows(rows)


SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def _score_slice(shards: int, tokens: int, words: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        kind = np.array(answers.column("kind").to_pylist())
        held = _Slice(texts, answers.filter(pa.array(kind == "counts")), shards)
        own = (held.counts + ADDED) / (tokens + ADDED * (words + 1))
        chance = own[held.own]
        pair_chance = np.zeros(len(held.word))
        rest = np.ones(len(held.word))
        for row in answers.filter(pa.array(kind == "codes")).to_pylist():
            part = slice(held.edges[row["shard"]], held.edges[row["shard"] + 1])
            backoff = np.frombuffer(row["b"], np.uint8)
            heads = _heads(held.context[part])
            runs = np.diff(np.append(heads, part.stop - part.start))
            pair_chance[part] = chances(np.frombuffer(row["a"], np.uint8))
            rest[part] = np.repeat(np.where(backoff > 0, chances(backoff), 1.0), runs)
        whole = pair_chance[held.pair] + rest[held.pair] * chance
        add = lambda v: np.bincount(held.doc, weights=v, minlength=len(held.ids))
        known = add((held.counts > 0)[held.own].astype(float)).astype(np.int64)
        return pa.table(
            {
                "doc_id": pa.array(held.ids, pa.int64()),
                "held_out": pa.array([held_out(i) for i in held.ids], pa.bool_()),
                "n_tokens": pa.array(held.sizes),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(held.ids), tokens)),
                "base_score": pa.array(add(np.log10(chance))),
                "score": pa.array(add(np.log10(whole))),
            }
        )

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = shards or 4 * partitions
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    stored = _store_slices(chosen)
    texts = _store_texts(stored.select("slice", "ids", "a", "b"), partitions)
    words = stored.mapInArrow(_slice_words(shards), BLOCKS)
    counted = materialise(words.groupBy("shard").applyInArrow(_count_words(shards), BLOCKS), "lm-counts")
    # One row per shard, added up by Spark.
    totals = counted.filter("kind = 'totals'").agg(F.sum(F.col("ids")[0]), F.sum(F.col("ids")[1])).first()
    tokens, distinct = (int(x or 0) for x in totals)
    counts = counted.filter("kind = 'counts'")
    pairs = texts.groupBy("slice").cogroup(counts.groupBy("slice")).applyInArrow(_slice_pairs(shards), BLOCKS)
    codes = materialise(pairs.groupBy("shard").applyInArrow(_answer_pairs, BLOCKS), "lm-codes")
    scored = texts.groupBy("slice").cogroup(counts.unionByName(codes).groupBy("slice"))
    return scored.applyInArrow(_score_slice(shards, tokens, distinct), SCORES)
