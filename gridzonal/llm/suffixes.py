"""Removal of repeated 50-byte passages by a distributed, common-prefix-aware merge sort of suffixes.

Sorting every suffix would move some thirty bytes for each byte of text, so, as in prefix-doubling string sorting, suffixes
whose first ``LENGTH`` bytes are known to be unique by fingerprints are not exchanged. Consecutive starts that share the
smallest ``GRAM``-byte hash in reach form a run. Pass one exchanges fingerprints of runs: a run that an earlier document
has in full is covered, one whose gram no other document has is unique, and only where a gram occurs in different surroundings are single starts
looked at. Pass two exchanges fingerprints of those starts. Pass three sorts the suffixes that are left: each slice sorts its own,
front-codes them (length of the prefix shared with the one before, and the rest) and sends each range of the order to its
task, which merges the runs with a loser tree that keeps, for every waiting suffix, the prefix known to be shared with the last one put out, and
compares bytes only beyond it. Equal suffixes meet there, and all but those of the smallest id are covered.

Texts are stored once, bucketed by slice, so that no pass shuffles them again. Only one entry per slice and fingerprint travels, so a
passage that a third of all rows hold costs an entry per slice.

Null and empty texts have no bytes; texts under ``LENGTH`` bytes lose nothing. Rows with a null id neither lose bytes nor cost
others any. Repeated rows with one id do not match each other, but both match smaller ids. An empty table gives an empty
result. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzonal.llm.text import byte_prefix_hashes, from_planes, gram_hashes, mix, shard_of, span_hash, to_planes
from gridzonal.storage import fresh_path, materialise

LENGTH = 50
GRAM = 24
SLICE_BYTES = 1 << 19
SPLITTER_DOCS = 2000

ASKED = "shard int, slice int, step string, ids binary, counts binary, keys binary, more binary"
ANSWERS = "slice int, step string, shard int, states binary"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"

UNIQUE, LOOK, COVERED = 0, 1, 2


def _asked(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.string(), *[pa.binary()] * 4)
    names = ("shard", "slice", "step", "ids", "counts", "keys", "more")
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _answers(rows: list[tuple]) -> pa.Table:
    kinds, names = (pa.int32(), pa.string(), pa.int32(), pa.binary()), ("slice", "step", "shard", "states")
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _heads(*columns: np.ndarray) -> np.ndarray:
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(columns[0]) - 1, dtype=bool)
    for column in columns:
        new |= column[1:] != column[:-1]
    return np.flatnonzero(np.concatenate([[True], new]))


def _grouped(doc: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, heads): entries in ascending order of the keys, equal ones as they were, and where each key begins there.

    ``doc`` ascends already, so the first entry of a key is that of its smallest document.
    """
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    return order, _heads(*(key[order] for key in keys))


def _firsts(doc: np.ndarray, order: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices, shared): the first entry in document order of every key, and whether other documents of the slice have it."""
    if not len(heads):
        return heads, heads.astype(bool)
    last = order[np.append(heads[1:], len(order)) - 1]
    first = order[heads]
    back = np.argsort(first)
    return first[back], (doc[first] != doc[last])[back]


def _dealt(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, edges): entries by shard, as they were within each, and where each shard begins there."""
    # Numbers of 16 bits are sorted by counting.
    order = np.argsort(shard.astype(np.uint16 if shards <= 1 << 16 else np.uint64), kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(shard.astype(np.int64), minlength=shards))])


class _Slice:
    """The texts of a slice in ascending id order, and what each pass derives from them and the answers so far."""

    def __init__(self, rows: pa.Table, answers: pa.Table | None, shards: int):
        ids, texts = rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i] or ""))
        self.ids = [ids[i] for i in order]
        self.texts = [(texts[i] or "").encode() for i in order]
        self.number, self.shards = rows.column("slice")[0].as_py(), shards
        self.data = np.frombuffer(b"".join(self.texts), dtype=np.uint8)
        sizes = np.fromiter(map(len, self.texts), dtype=np.int64, count=len(self.texts))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        # Equal ids count as one document.
        known = np.array([i is not None for i in self.ids])
        value = np.array([i or 0 for i in self.ids], dtype=np.int64)
        self.same = np.cumsum(np.concatenate([[0], value[1:] != value[:-1]])) if len(value) else value
        self.value, self.known = value, known
        self.found: dict[str, dict[int, np.ndarray]] = {}
        for row in answers.to_pylist() if answers is not None else []:
            self.found.setdefault(row["step"], {})[row["shard"]] = np.frombuffer(row["states"], np.uint8)

    def _blocks(self, step: str, doc: np.ndarray, shard: np.ndarray, keys: list[tuple[np.ndarray, int]]) -> list[tuple]:
        """One row per shard: ids of documents with the number of their entries, and the entries' keys."""
        order, edges = _dealt(shard, self.shards)
        rows = []
        for number in np.flatnonzero(np.diff(edges)):
            part = order[edges[number] : edges[number + 1]]
            heads = _heads(doc[part])
            counts = np.diff(np.append(heads, len(part)))
            ids = (self.value[doc[part][heads]].astype(np.int64) ^ np.int64(-(1 << 63))).view(np.uint64)
            packed = [to_planes(key[part] >> np.uint64(bits)) for key, bits in keys]
            rows.append((int(number), self.number, step, to_planes(ids), to_planes(counts), packed[0], packed[1] if packed[1:] else None))
        return rows

    def _states(self, step: str, shard: np.ndarray) -> np.ndarray:
        """The answers to the entries of ``_blocks``, in their own order."""
        out = np.zeros(len(shard), dtype=np.uint8)
        order, edges = _dealt(shard, self.shards)
        for number, states in self.found.get(step, {}).items():
            out[order[edges[number] : edges[number + 1]]] = states
        return out

    def runs(self) -> None:
        size = len(self.data)
        self.hashes = byte_prefix_hashes(self.data)
        self.first = self.last = self.doc = np.zeros(0, dtype=np.int64)
        self.gram = np.zeros(0, dtype=np.uint64)
        if size >= LENGTH:
            gram = gram_hashes(self.hashes, GRAM)
            bits = np.uint64(max(24, size.bit_length()))
            least, reach, span = (gram >> bits << bits) | np.arange(len(gram), dtype=np.uint64), LENGTH - GRAM + 1, 1
            while span * 2 <= reach:
                least, span = np.minimum(least[:-span], least[span:]), span * 2
            if reach > span:
                least = np.minimum(least[: span - reach], least[reach - span :])
            anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            # A run ends where the anchor changes, where a text does, and where less than ``LENGTH`` bytes of it are left.
            new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            for place in (self.starts, np.maximum(self.ends - LENGTH + 1, self.starts)):
                new[place[place < len(new)]] = True
            heads = np.flatnonzero(new)
            doc = np.searchsorted(self.ends, heads, side="right")
            able = (heads + LENGTH <= self.ends[doc]) & self.known[doc]
            self.first, self.doc, self.gram = heads[able], doc[able], gram[anchor[heads[able]]]
            self.last = (np.append(heads[1:], len(new)) - 1)[able]
        self.whole = span_hash(self.hashes, self.first, self.last + LENGTH)
        # A run that an earlier document of the slice has is covered; only the others travel.
        self.by_run = _grouped(self.same[self.doc], self.gram, self.whole)
        self.sent, _shared = _firsts(self.same[self.doc], *self.by_run)
        # Anchors have the smallest hash in reach, so most are small: hashed once more, they fill all shards alike.
        self.run_shard = shard_of(mix(self.gram[self.sent]), self.shards)

    def ask_runs(self) -> list[tuple]:
        keys = [(self.gram[self.sent], 24), (self.whole[self.sent], 16)]
        return self._blocks("runs", self.doc[self.sent], self.run_shard, keys)

    def look(self) -> None:
        """The single starts to look at, by the answers about runs."""
        states = self._states("runs", self.run_shard)
        self.state = np.full(len(self.first), COVERED, dtype=np.uint8)
        self.state[self.sent] = states
        # Equal ids: a run of the same document as the first one shares its state.
        order, heads = self.by_run
        own = np.repeat(order[heads], np.diff(np.append(heads, len(order)))) if len(heads) else order
        twin = self.same[self.doc[order]] == self.same[self.doc[own]]
        self.state[order[twin]] = self.state[own[twin]]
        open_ = np.flatnonzero(self.state == LOOK)
        sizes = self.last[open_] - self.first[open_] + 1
        ends = np.cumsum(sizes)
        self.at = np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes) + np.repeat(self.first[open_], sizes)
        self.at_doc = np.repeat(self.doc[open_], sizes)
        self.mark = span_hash(self.hashes, self.at, self.at + LENGTH)
        self.by_mark = _grouped(self.same[self.at_doc], self.mark)
        self.marked, self.mark_shared = _firsts(self.same[self.at_doc], *self.by_mark)
        self.mark_shard = shard_of(self.mark[self.marked], self.shards)

    def ask_starts(self) -> list[tuple]:
        return self._blocks("starts", self.at_doc[self.marked], self.mark_shard, [(self.mark[self.marked], 16)])

    def suffixes(self) -> None:
        """The suffixes that other documents may have too: sorted, different ones with their first document."""
        repeated = (self._states("starts", self.mark_shard) > 0) | self.mark_shared
        order, heads = self.by_mark
        chosen = np.zeros(len(self.mark), dtype=bool)
        chosen[self.marked] = repeated
        wanted = np.zeros(len(self.mark), dtype=bool)
        wanted[order] = np.repeat(chosen[order[heads]], np.diff(np.append(heads, len(order))))
        self.at, self.at_doc = self.at[wanted], self.at_doc[wanted]
        text = np.lib.stride_tricks.sliding_window_view(self.data, LENGTH)[self.at] if len(self.at) else np.zeros((0, LENGTH), np.uint8)
        keys = np.ascontiguousarray(text).view(f"S{LENGTH}").reshape(-1)
        # Byte strings of this type compare by all their bytes: they have equal lengths, and padding is zero.
        order = np.lexsort((self.same[self.at_doc], keys))
        heads = _heads(keys[order])
        self.entry = np.zeros(len(order), dtype=np.int64)
        self.entry[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
        self.entry_doc = self.at_doc[order[heads]] if len(heads) else heads
        self.sorted = text[order[heads]] if len(heads) else text
        self.sorted_keys = keys[order[heads]] if len(heads) else keys

    def cut(self, splitters: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.searchsorted(self.sorted_keys, splitters), [len(self.sorted_keys)]])

    def ask_suffixes(self, splitters: np.ndarray) -> list[tuple]:
        edges, rows = self.cut(splitters), []
        for number in np.flatnonzero(np.diff(edges)):
            part = self.sorted[edges[number] : edges[number + 1]]
            shared = front_code(part)
            rest = part[np.arange(LENGTH) >= shared[:, None]].tobytes()
            ids = (self.value[self.entry_doc[edges[number] : edges[number + 1]]] ^ np.int64(-(1 << 63))).view(np.uint64)
            rows.append((int(number), self.number, "suffixes", to_planes(ids), None, shared.tobytes(), rest))
        return rows

    def result(self, splitters: np.ndarray) -> pa.Table:
        covered = np.zeros(len(self.data) + 1, dtype=np.int64)

        def cover(first: np.ndarray, end: np.ndarray) -> None:
            covered[:] += np.bincount(first, minlength=len(covered)) - np.bincount(end, minlength=len(covered))

        done = self.state == COVERED
        cover(self.first[done], self.last[done] + LENGTH)
        edges = self.cut(splitters)
        earlier = np.zeros(len(self.sorted_keys), dtype=bool)
        for number, states in self.found.get("suffixes", {}).items():
            earlier[edges[number] : edges[number + 1]] = states > 0
        hit = earlier[self.entry] | (self.same[self.at_doc] != self.same[self.entry_doc[self.entry]])
        cover(self.at[hit], self.at[hit] + LENGTH)
        gone = np.cumsum(covered[:-1]) > 0
        out: list[list] = [[], [], [], [], []]
        for number, text, a, b in zip(self.ids, self.texts, self.starts.tolist(), self.ends.tolist()):
            part = gone[a:b]
            removed = int(part.sum())
            spans = int(part[:1].sum() + (part[1:] & ~part[:-1]).sum()) if removed else 0
            kept = self.data[a:b][~part].tobytes() if removed else text
            for column, value in zip(out, (number, b - a, removed, spans, hashlib.sha256(kept).hexdigest())):
                column.append(value)
        kinds = (*[pa.int64()] * 4, pa.string())
        names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def front_code(rows: np.ndarray) -> np.ndarray:
    """How many first bytes each row shares with the row before."""
    shared = np.zeros(len(rows), dtype=np.uint8)
    if len(rows) > 1:
        same = rows[1:] == rows[:-1]
        shared[1:] = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))
    return shared


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, int]]:
    """(run, place, shared) in sorted order; a run is the shared-prefix lengths of its rows and what follows them.

    ``shared`` is the prefix common with the row put out before. Of two waiting rows, the one that shares more with the last
    row put out comes first; only if they share the same are bytes compared, and only those beyond it.
    """
    count = len(runs)
    if not count:
        return
    place, text, known = [0] * count, [rest[0] if rest else None for _s, rest in runs], [0] * count

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix is then the one it shares with the winner."""
        one, two = text[a], text[b]
        if one is None:
            return b, a
        if two is None or known[a] > known[b]:
            return a, b
        if known[a] < known[b]:
            return b, a
        start = known[a]
        x, y = one[start:], two[start:]
        if x == y:
            known[b] = start + len(x)
            return a, b
        apart = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
        shared = start + len(x) - (apart.bit_length() + 7) // 8
        if x < y:
            known[b] = shared
            return a, b
        known[a] = shared
        return b, a

    losers = [0] * count

    def build(node: int) -> int:
        if node >= count:
            return node - count
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if count > 1 else 0
    while text[winner] is not None:
        yield winner, place[winner], known[winner]
        shared, rest = runs[winner]
        place[winner] = now = place[winner] + 1
        if now < len(rest):
            known[winner] = shared[now]
            text[winner] = text[winner][: shared[now]] + rest[now]
        else:
            text[winner] = None
        node = (winner + count) >> 1
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1


def _read(table: pa.Table) -> tuple[list[dict], list[np.ndarray]]:
    rows = table.to_pylist()
    ids = [from_planes(r["ids"]) for r in rows]
    return rows, [np.repeat(i, from_planes(r["counts"]).astype(np.int64)) if r["counts"] else i for i, r in zip(ids, rows)]


def _answer_runs(table: pa.Table) -> pa.Table:
    rows, ids = _read(table)
    doc = np.concatenate(ids)
    gram, whole = (np.concatenate([from_planes(r[k]) for r in rows]) for k in ("keys", "more"))
    order = np.lexsort((doc, whole, gram))
    gram, whole, doc = gram[order], whole[order], doc[order]
    heads, gram_heads = _heads(gram, whole), _heads(gram)
    sizes = np.diff(np.append(heads, len(doc)))
    first_doc = np.repeat(doc[heads], sizes)
    # Surroundings per gram.
    group = np.searchsorted(gram_heads, heads, side="right") - 1
    many = np.repeat(np.bincount(group) > 1, np.diff(np.append(gram_heads, len(doc))))
    states = np.where(doc > first_doc, COVERED, np.where(many, LOOK, UNIQUE)).astype(np.uint8)
    out = np.empty(len(states), dtype=np.uint8)
    out[order] = states
    return _split(rows, ids, out)


def _answer_starts(table: pa.Table) -> pa.Table:
    rows, ids = _read(table)
    doc, key = np.concatenate(ids), np.concatenate([from_planes(r["keys"]) for r in rows])
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    heads = _heads(key)
    ends = np.append(heads[1:], len(doc))
    out = np.empty(len(doc), dtype=np.uint8)
    out[order] = np.repeat(doc[ends - 1] != doc[heads], ends - heads)
    return _split(rows, ids, out)


def _answer_suffixes(table: pa.Table) -> pa.Table:
    rows, ids = _read(table)
    runs = []
    for row in rows:
        shared = list(row["keys"])
        edges = np.cumsum([0, *(LENGTH - s for s in shared)]).tolist()
        runs.append((shared, [row["more"][a:b] for a, b in zip(edges, edges[1:])]))
    out = [np.zeros(len(i), dtype=np.uint8) for i in ids]
    held: list[tuple[int, int, int]] = []
    numbers = [i.tolist() for i in ids]

    def close() -> None:
        if len(held) > 1:
            least = min(number for number, _run, _place in held)
            for number, run, place in held:
                out[run][place] = number > least

    for run, place, shared in merge_runs(runs):
        if shared < LENGTH:
            close()
            held = []
        held.append((numbers[run][place], run, place))
    close()
    return _split(rows, ids, np.concatenate(out))


def _split(rows: list[dict], ids: list[np.ndarray], states: np.ndarray) -> pa.Table:
    edges = np.cumsum([0, *map(len, ids)])
    return _answers([(r["slice"], r["step"], r["shard"], states[a:b].tobytes()) for r, a, b in zip(rows, edges, edges[1:])])


def _splitters(docs: DataFrame, count: int, parts: int) -> np.ndarray:
    """Borders of ranges of the suffix order from a bounded sample; they decide balance only, not the result."""
    if parts < 2:
        return np.zeros(0, dtype=f"S{LENGTH}")
    share = min(1.0, SPLITTER_DOCS / max(1, count))
    place = F.expr("cast(1 + pmod(xxhash64(doc_id), greatest(1, length(text) - 50)) AS INT)")
    picked = docs.filter("text IS NOT NULL").sample(share, 17).select(F.substring(F.col("text"), place, F.lit(LENGTH)).alias("s"))
    sample = np.sort(np.array([(r["s"].encode())[:LENGTH] for r in picked.limit(4 * SPLITTER_DOCS).collect()], dtype=f"S{LENGTH}"))
    if not len(sample):
        return np.zeros(0, dtype=f"S{LENGTH}")
    return np.unique(sample[np.arange(1, parts) * len(sample) // parts])


def store_slices(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """(slice, doc_id, text) as a table bucketed by slice, with slices of about ``SLICE_BYTES``."""
    spark = docs.sparkSession
    number = max(1, -(-size // SLICE_BYTES))
    placed = docs.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text"), F.lit(number)).cast("int"))
    name = f"slices_{uuid.uuid4().hex}"
    (
        placed.repartition(buckets, "slice")
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", fresh_path(spark, "slices"))
        .bucketBy(buckets, "slice")
        .sortBy("slice")
        .saveAsTable(name)
    )
    return spark.table(name)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``.

    A byte goes if a ``LENGTH``-byte string over it also starts in a document with a smaller id.
    """
    spark: SparkSession = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = 2 * partitions
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, size = chosen.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    splitters = _splitters(chosen, rows, shards)
    stored = store_slices(chosen, size or 0, partitions)

    def run_pass(answers: DataFrame | None, make, schema: str) -> DataFrame:
        by_slice = stored.groupBy("slice")
        if answers is None:
            return by_slice.applyInArrow(lambda table: make(_Slice(table, None, shards)), schema)
        return by_slice.cogroup(answers.groupBy("slice")).applyInArrow(
            lambda table, found: make(_Slice(table, found, shards)), schema
        )

    def ask_runs(held: _Slice) -> pa.Table:
        held.runs()
        return _asked(held.ask_runs())

    def ask_starts(held: _Slice) -> pa.Table:
        held.runs()
        held.look()
        return _asked(held.ask_starts())

    def ask_suffixes(held: _Slice) -> pa.Table:
        held.runs()
        held.look()
        held.suffixes()
        return _asked(held.ask_suffixes(splitters))

    def finish(held: _Slice) -> pa.Table:
        held.runs()
        held.look()
        held.suffixes()
        return held.result(splitters)

    def answered(asked: DataFrame, answer, label: str) -> DataFrame:
        return materialise(asked.groupBy("shard").applyInArrow(answer, ANSWERS), label)

    runs = answered(run_pass(None, ask_runs, ASKED), _answer_runs, "runs")
    starts = answered(run_pass(runs, ask_starts, ASKED), _answer_starts, "starts")
    known = runs.unionByName(starts)
    suffixes = answered(run_pass(known, ask_suffixes, ASKED), _answer_suffixes, "suffixes")
    return run_pass(known.unionByName(suffixes), finish, RESULT)
