"""KD-tree search, quality classifier and language model."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import DOCS, as_rows, documents, rows
from gridzonal.llm import quality
from gridzonal.llm.kdtree import Tree, top_k
from gridzonal.llm.lm import ADDED, DISCOUNT, lm_scores
from gridzonal.llm.trie import EliasFano, Trie, chances, quantise


def brute_top(vectors, k):
    known = []
    for number, vector in vectors:
        if number is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        known.append((number, [math.floor(1024 * x) for x in vector]))
    known = [(n, v) for n, v in known if len(v) == 4]
    out = []
    for number, vector in known:
        if number % 5 == 0:
            scored = sorted((-sum(a * b for a, b in zip(vector, v)), n) for n, v in known if n != number)[:k]
            out += [(number, rank + 1, n, -s) for rank, (s, n) in enumerate(scored)]
    return sorted(out)


def test_top_k_over_several_shards(spark):
    rng = random.Random(11)
    vectors = [(k, [rng.choice([0.0, 0.25, -0.5, rng.random()]) for _ in range(4)]) for k in range(300)]
    vectors += [(k, vectors[k - 300][1]) for k in range(300, 340)]
    vectors += [(500, None), (505, [None, 1.0, 1.0, 1.0]), (510, [float("nan")] * 4), (515, [float("inf")] * 4), (None, [1.0] * 4), (520, [1.0])]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(1)).repartition(3)
    vectors = [(n, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for n, v in vectors]
    found = top_k(df, df.filter("vec_id % 5 = 0"), k=10, shard_rows=60)
    assert as_rows(found, "query_id", "rank", "vec_id", "score") == brute_top(vectors, 10)


def test_top_k_refuses_scores_beyond_64_bits(spark):
    for large in (1e18, 1e200, -3e6):
        table = spark.createDataFrame([(1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [large, 1.0])], "vec_id bigint, embedding array<double>")
        with pytest.raises(Exception, match="vector 3 has an entry"):
            top_k(table, table.filter("vec_id = 1")).collect()
    fine = spark.createDataFrame([(1, [1.0, 1.0]), (2, [2e6, 2.0]), (3, [2e6, 1.0])], "vec_id bigint, embedding array<double>")
    assert as_rows(top_k(fine, fine.filter("vec_id = 2")), "rank", "vec_id") == [(1, 3), (2, 1)]


def test_top_k_with_few_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], "vec_id bigint, embedding array<float>")
    assert as_rows(top_k(few, few.filter("vec_id = 0")), "query_id", "rank", "vec_id", "score") == [(0, 1, 1, 1024 * 512 + 2048 * 512)]
    assert top_k(few.limit(0), few).isEmpty() and top_k(few, few.limit(0)).isEmpty()


def test_tree_boxes_prune():
    rng = np.random.default_rng(1)
    rows_ = np.concatenate([rng.integers(0, 5, (500, 3)), rng.integers(900, 1000, (500, 3))])
    tree = Tree.load(Tree.build(np.arange(1000), rows_, 50).dump())
    assert (tree.low[0] == rows_.min(axis=0)).all() and (tree.high[0] == rows_.max(axis=0)).all()
    got = tree.search(np.array([1, 1, 1]), -1, 5, None)
    want = sorted((-int(s), n) for n, s in enumerate(rows_ @ np.array([1, 1, 1])))[:5]
    assert got == [(-s, n) for s, n in want]
    assert tree.search(np.array([1, 1, 1]), -1, 5, 10**6) == []


@pytest.fixture(scope="module")
def graded(spark):
    good = "the word and a sentence of plain prose with some more words in it"
    rng = random.Random(2)
    table = []
    for k in range(600):
        part = rng.sample(good.split(), 9)
        bad = rng.random() < 0.4
        table.append((k, " ".join(w + "%%%" if bad else w for w in part), 0 if bad else 1))
    return spark.createDataFrame(table, "doc_id bigint, text string, quality int")


def test_classifier_on_held_out_rows(spark, graded):
    docs, labels = graded.drop("quality"), graded.select("doc_id", "quality")
    junk = spark.createDataFrame([(None, 1), (5, None), (6, 7)], "doc_id bigint, quality int")
    found = quality.classify(docs.withColumn("score", F.lit(1)), labels.unionByName(junk)).join(labels, "doc_id")
    for row in found.collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == (1 if row.score >= 0.7 else 0)
    held = [r for r in found.collect() if r.held_out]
    assert sum(r.predicted == r.quality for r in held) > 0.97 * len(held) > 50
    # Labels of held-out rows are never read.
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    columns = ("doc_id", "score")
    assert as_rows(quality.classify(docs, turned), *columns) == as_rows(quality.classify(docs, labels), *columns)


def test_classifier_stands_every_row(spark, graded):
    labels = graded.select("doc_id", "quality")
    docs = documents(spark, with_clashes=True)
    assert quality.classify(docs, labels).count() == docs.count()
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).isEmpty()


def test_sample_bound(spark, graded):
    small = quality.train(graded, graded.select("doc_id", "quality"), sample=40)
    assert np.isfinite(small).all() and small.shape == (quality.DIMENSIONS + 1,)


def test_elias_fano():
    rng = np.random.default_rng(4)
    for values in ([], [0], [7], [3, 3, 9], np.sort(rng.integers(0, 10**12, 9000)), np.arange(5000), [0, 2**62]):
        held = EliasFano.build(np.array(values, dtype=np.uint64))
        assert (held.values() == np.array(values, dtype=np.uint64)).all()
    values = np.unique(rng.integers(0, 10**9, 20000)).astype(np.uint64)
    held = EliasFano.build(values)
    asked = np.sort(np.concatenate([values[::7], rng.integers(0, 10**9, 500).astype(np.uint64)]))
    place = held.find(asked)
    want = {int(v): k for k, v in enumerate(values)}
    assert [int(p) for p in place] == [want.get(int(a), -1) for a in asked]
    bits = 8 * (held.low.nbytes + held.high.nbytes)
    assert bits / len(values) < math.log2(10**9 / len(values)) + 3


def test_trie_look_up(tmp_path):
    rng = random.Random(6)
    counts = {(rng.randrange(50) * 10**6 + 3, rng.randrange(400)): rng.randrange(1, 9) for _ in range(3000)}
    keys = sorted(counts)
    context, word = (np.array([k[i] for k in keys], dtype=np.uint64) for i in (0, 1))
    Trie.write(tmp_path, context, word, np.array([counts[k] for k in keys]), DISCOUNT)
    trie = Trie(tmp_path)
    total = Counter()
    follow = Counter()
    for (c, _w), n in counts.items():
        total[c] += n
        follow[c] += 1
    asked = sorted({*keys, *((c, w) for c, _w in keys[:200] for w in (0, 401, 10**9)), (1, 1), (10**9, 5)})
    contexts = sorted({c for c, _w in asked})
    runs = np.array([sum(c == k for k, _w in asked) for c in contexts])
    codes, backoff = trie.look_up(np.array(contexts, dtype=np.uint64), runs, np.array([w for _c, w in asked], dtype=np.uint64))
    for key, code in zip(asked, codes):
        want = (counts[key] - DISCOUNT) / total[key[0]] if key in counts else 0.0
        assert chances(code) == pytest.approx(want, rel=0.06), key
    for c, code in zip(contexts, backoff):
        assert (code > 0) == (c in total)
        if code:
            assert chances(code) == pytest.approx(DISCOUNT * follow[c] / total[c], rel=0.06)
    assert chances(quantise(np.array([0.5, 0.25, 1.0]))).tolist() == [0.5, 0.25, 1.0] and chances(np.zeros(1)) == 0


def tokens_of(text):
    lowered = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return [*re.findall(rb"[^\x20\x09-\x0D]+", lowered), None]


def brute_scores(table):
    held = lambda n: n is not None and zlib.crc32(str(n).encode()) % 10 == 0
    single, pairs, after = Counter(), Counter(), defaultdict(set)
    for number, text in table:
        if not held(number):
            found = tokens_of(text)
            single.update(found)
            for a, b in zip([0, *found], found):
                pairs[a, b] += 1
                after[a].add(b)
    total, size = sum(single.values()), len(single)
    context = Counter()
    for (a, _b), n in pairs.items():
        context[a] += n
    out = []
    for number, text in table:
        found = tokens_of(text)
        own = [(single[t] + ADDED) / (total + ADDED * (size + 1)) for t in found]
        whole = 0.0
        for a, b, p in zip([0, *found], found, own):
            if context[a]:
                p = max(pairs[a, b] - DISCOUNT, 0) / context[a] + DISCOUNT * len(after[a]) / context[a] * p
            whole += math.log10(p)
        known = sum(single[t] > 0 for t in found)
        out.append((number, held(number), len(found), known, total, sum(map(math.log10, own)), whole))
    return out


@pytest.mark.parametrize("clashes", [False, True])
def test_language_model(spark, clashes):
    found = lm_scores(documents(spark, clashes), shards=5).collect()
    want = brute_scores([r[:2] for r in rows()])
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    assert len(found) == len(want)
    for got, expected in zip(sorted(map(tuple, found), key=key), sorted(want, key=key)):
        assert got[:5] == expected[:5]
        assert got[5] == pytest.approx(expected[5])
        # Probabilities are one byte each.
        assert got[6] == pytest.approx(expected[6], rel=0.02, abs=0.05)


def test_language_model_of_a_table_that_is_cut_elsewhere_when_read_again(spark, tmp_path):
    table = [r[:2] for r in rows()]

    def read(batches):
        part = next(iter(batches)).column("id")[0].as_py()
        before = len(list(tmp_path.glob(f"{part}-*")))
        (tmp_path / f"{part}-{before}").touch()
        held = table[(part + before) % 4 :: 4]
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array([r[0] for r in held], pa.int64()), "text": [r[1] for r in held]})

    docs = spark.range(0, 4, 1, 4).mapInArrow(read, "doc_id bigint, text string")
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    found = sorted(map(tuple, lm_scores(docs, shards=5).collect()), key=key)
    want = sorted(brute_scores(table), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert [r[5] for r in found] == pytest.approx([r[5] for r in want])
    assert [r[6] for r in found] == pytest.approx([r[6] for r in want], rel=0.02, abs=0.05)


def test_language_model_without_rows(spark):
    docs = spark.createDataFrame([], DOCS)
    assert lm_scores(docs, shards=3).isEmpty()
    held = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    only = spark.createDataFrame([(held, "never learned")], "doc_id bigint, text string")
    row = lm_scores(only, shards=3).first()
    assert row.train_tokens == 0 and row.n_known == 0 and row.held_out
