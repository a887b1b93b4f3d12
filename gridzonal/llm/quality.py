"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Features of a text are its words, word pairs and the shapes of both (a word without its letters: punctuation, digits and whether it is
all in capitals; a pair of shapes tells whether the word is repeated), hashed to ``DIMENSIONS``; a feature weighs its share of the text's features. Training takes at
most ``SAMPLE`` labelled rows, those with the smallest hashed ids, dealt to ``SHARDS`` learners whose states
are averaged after every pass; everything it sends to the driver is bounded by these parameters. Scoring is a sparse dot
product inside Arrow tasks over every whole text.

Null and empty texts score by the bias alone. Rows without a label, with a null label or with one that is neither 0 nor 1 teach nothing; without
any labelled row every score is 0.5. Repeated rows are scored each on its own; label, lang, source and id are not features. Columns named
``held_out``, ``score`` or ``predicted`` in the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.llm.skew import free_name
from gridzonal.llm.text import Words, mix, raw_texts, slices
from gridzonal.storage import materialise

DIMENSIONS = 1 << 18
SAMPLE = 16_000
SHARDS = 6
PASSES = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0, 1e-4
SCALE = 16.0
THRESHOLD = 0.7

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_SIGN = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SIGN[_LETTER | _UPPER] = 0
_SIGN[ord("0") : ord("9") + 1] = _SIGN[ord("0")]

_CAPITALS, _PAIR, _SHAPE = np.uint64(0xA5A5A5A5A5A5A5A7), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def _spans(values: np.ndarray, words: Words) -> np.ndarray:
    summed = np.zeros(len(values) + 1, dtype=values.dtype)
    np.cumsum(values, out=summed[1:])
    return summed[words.ends] - summed[words.starts]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of every feature of every text, repeats included."""
    words = Words(texts)
    if not len(words.starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    word = words.hashes()
    capitals = (_spans(_UPPER[words.raw].astype(np.int64), words) >= 2) & (
        _spans(_LETTER[words.raw].astype(np.int64), words) == 0
    )
    shape = mix(_spans(_SIGN[words.raw], words) + capitals * _CAPITALS + _SHAPE)
    next_to = np.flatnonzero(words.doc[1:] == words.doc[:-1])
    again = (word[next_to] == word[next_to + 1]) * _CAPITALS
    pairs = [mix(word[next_to] * _PAIR + word[next_to + 1]), mix(shape[next_to] * _PAIR + shape[next_to + 1] + again)]
    rows = np.concatenate([words.doc, words.doc, words.doc[next_to], words.doc[next_to]])
    return rows, (np.concatenate([word, shape, *pairs]) >> np.uint64(46)).astype(np.int64)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = raw_texts(batch.column("text"))
        out: list[list[bytes]] = [[], []]
        for first, last in slices(texts):
            rows, index = features(texts[first:last])
            order = np.argsort(rows, kind="stable")
            edges = np.searchsorted(rows[order], np.arange(last - first + 1))
            for a, b in zip(edges[:-1], edges[1:]):
                found, times = np.unique(index[order[a:b]], return_counts=True)
                out[0].append(found.astype("<i4").tobytes())
                out[1].append((times * (SCALE / max(1, b - a))).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), *(pa.array(c, pa.binary()) for c in out)],
            names=["doc_id", "label", "found", "weight"],
        )


class Ftrl:
    """Per-coordinate FTRL-proximal state; the last coordinate is the bias."""

    def __init__(self, state: np.ndarray | None = None):
        self.z, self.n = np.zeros((2, DIMENSIONS + 1)) if state is None else state.astype(np.float64)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, shrunk, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] += g * g


def _learner(state: np.ndarray, number: int):
    def run(table: pa.Table) -> pa.Table:
        model = Ftrl(state)
        ids = table.column("order").to_numpy()
        found, weight = table.column("found").to_pylist(), table.column("weight").to_pylist()
        labels = table.column("label").to_pylist()
        for row in np.random.default_rng(number).permutation(np.argsort(ids, kind="stable")):
            at = np.append(np.frombuffer(found[row], "<i4"), DIMENSIONS)
            x = np.append(np.frombuffer(weight[row], "<f4").astype(np.float64), 1.0)
            model.learn(at, x, labels[row])
        both = np.stack([model.z, model.n]).astype("<f4").tobytes()
        return pa.table({"rows": pa.array([len(ids)], pa.int64()), "state": pa.array([both], pa.binary())})

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights of all features and the bias, from at most ``sample`` labelled rows (doc_id, quality)."""
    # The sample is bounded by a parameter, so its ids are broadcast.
    chosen = (
        labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("label"), F.xxhash64("doc_id").alias("order"))
        .orderBy("order", "label")
        .limit(sample)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    known = texts.select("doc_id", "text", "label", "order")
    made = known.mapInArrow(_featurise, "doc_id bigint, label int, found binary, weight binary")
    rows = materialise(made.withColumn("order", F.xxhash64("doc_id")), "features")
    rows = rows.withColumn("shard", F.pmod("order", F.lit(SHARDS)))
    state = np.zeros((2, DIMENSIONS + 1))
    for number in range(PASSES):
        learned = rows.groupBy("shard").applyInArrow(_learner(state.astype(np.float32), number), "rows bigint, state binary")
        # At most SHARDS states of a fixed size.
        # In an order of their own, so that sums don't depend on which comes first.
        states = sorted(learned.collect(), key=lambda r: (r["rows"], bytes(r["state"])))
        if not states:
            break
        share = [r["rows"] / sum(s["rows"] for s in states) for r in states]
        state = sum(w * np.frombuffer(r["state"], "<f4").reshape(2, -1).astype(np.float64) for w, r in zip(share, states))
    return Ftrl(state).weights(slice(None)).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, name: str = "_score") -> DataFrame:
    """The columns of ``docs`` with the score, between 0 and 1, as ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            out = np.empty(len(texts))
            for first, last in slices(texts):
                rows, index = features(texts[first:last])
                number = np.bincount(rows, minlength=last - first)
                dot = np.bincount(rows, weights=w[index], minlength=last - first)
                out[first:last] = w[-1] + SCALE * dot / np.maximum(number, 1)
            out = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*names, name])

    schema = docs.withColumn(name, F.lit(0.0)).schema
    return docs.mapInArrow(run, schema)


def held_out() -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted), learned from the labels of rows that are not held out."""
    weights = train(docs, labels.filter(~held_out()), sample)
    scored = score(docs.select("doc_id", "text"), weights)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents predicted 1, with all their columns."""
    weights = train(docs, labels.filter(~held_out()), sample)
    name = free_name(docs, "_score")
    return score(docs, weights, name).filter(F.col(name) >= THRESHOLD).drop(name)
