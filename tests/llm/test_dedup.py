"""Exact groups, near-duplicate components and repeated passages next to brute force."""

import hashlib
import itertools
import random
import re
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import DOCS, as_rows, documents, rows, words
from gridzonal.llm import graph, jaccard
from gridzonal.llm.exact_dedup import append_new, create_index, digests, drop_index, exact_groups, keep_exact
from gridzonal.llm.graph import components
from gridzonal.llm.jaccard import keep_one_of_each, near_components
from gridzonal.llm.suffixes import LENGTH, front_code, merge_runs, repeated_passages
from gridzonal.storage import fresh_path, materialise


def sorted_rows(found):
    return sorted(found, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


@pytest.mark.parametrize("clashes", [False, True])
def test_exact_groups(spark, clashes):
    groups = defaultdict(list)
    for number, text, *_ in rows():
        groups[hashlib.sha256((text or "").encode()).hexdigest()].append(number)
    want = []
    for digest, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, digest) for i in ids]
    found = exact_groups(documents(spark, clashes))
    assert as_rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted_rows(want)


def test_keep_exact_keeps_one_row_of_each_text(spark):
    docs = documents(spark, with_clashes=True)
    kept = keep_exact(docs)
    assert kept.columns == docs.columns
    texts = [row.text or "" for row in kept.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in rows()})


def test_index_grows_and_finds_what_it_has(spark):
    path, name = fresh_path(spark, "index"), "digest_index_test"
    keys = digests(documents(spark).filter("doc_id IS NOT NULL"))
    create_index(spark, name, path, 4)
    append_new(keys.filter("doc_id >= 10"), name, buckets=4)
    first = spark.table(name).count()
    append_new(keys, name, buckets=4)
    append_new(keys, name, buckets=4)
    assert spark.table(name).count() == keys.select("digest").distinct().count() > first
    drop_index(spark, name)
    create_index(spark, name, path, 4)  # the files outlive the name
    assert spark.table(name).count() == keys.select("digest").distinct().count()
    plan = keys.hint("merge").join(spark.table(name).hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


@pytest.mark.parametrize("tasks", [4, 31])
def test_index_has_a_file_per_bucket_however_many_tasks_write(spark, monkeypatch, tasks):
    frame = type(spark.range(0))
    dealt = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, _number, *keys: dealt(self, tasks, *keys))
    path, name = fresh_path(spark, "index"), f"digest_index_tasks_{tasks}"
    keys = digests(spark.range(500).selectExpr("id AS doc_id", "concat('text ', id % 400) AS text"))
    create_index(spark, name, path, 4)
    append_new(keys, name, buckets=4)
    files = [row.file for row in spark.table(name).selectExpr("input_file_name() AS file").distinct().collect()]
    kept = {row.digest: row.keep_id for row in spark.table(name).collect()}
    drop_index(spark, name)
    assert len(files) == 4
    assert kept == {hashlib.sha256(f"text {i}".encode()).hexdigest(): i + 400 if i < 100 else i for i in range(400)}
    drop_index(spark, name)


def shingle_set(text):
    found = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set()


def brute_components(table):
    sets = [shingle_set(text) for _i, text in table]
    top = list(range(len(table)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(range(len(table)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            top[find(a)] = find(b)
    least = {}
    for k, (number, _t) in enumerate(table):
        if number is not None:
            least[find(k)] = min(least.get(find(k), number), number)
    return [(number, len(sets[k]), least.get(find(k)) if sets[k] else number) for k, (number, _t) in enumerate(table)]


@pytest.mark.parametrize("clashes", [False, True])
def test_near_components(spark, clashes):
    want = brute_components([r[:2] for r in rows()])
    found = near_components(documents(spark, clashes))
    assert as_rows(found, "doc_id", "n_shingles", "component_id") == sorted_rows(want)


def test_near_components_at_the_threshold_and_in_a_large_group(spark):
    # 8 of 10 shingles link, 7 of 9 do not; then many near copies of one text, some far from each other.
    def run(first, count):
        return [f"t{k}" for k in range(first, first + count)]

    table = [(1, run(0, 13)), (2, run(0, 12) + ["q"]), (3, run(100, 12)), (4, run(100, 11) + ["q"]), (5, run(200, 9)), (6, run(201, 9))]
    rng, base = random.Random(7), words(8, 70, 5000)
    for number in range(10, 160):
        text = list(base)
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(70)] = f"v{rng.randrange(10**6)}"
        table.append((number, text))
    table = [(number, " ".join(text)) for number, text in table]
    docs = spark.createDataFrame(table, "doc_id bigint, text string").repartition(5)
    found = near_components(docs)
    assert as_rows(found, "doc_id", "n_shingles", "component_id") == sorted_rows(brute_components(table))


@pytest.mark.parametrize("part", [0, 2047, 2048, 4_000_000, 2**31 - 1])
def test_tags_of_any_partition_are_distinct_longs(monkeypatch, part):
    monkeypatch.setattr(jaccard.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: part))
    monkeypatch.setattr(jaccard, "SLICE_BYTES", 40)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(9)), "text": [f"text number {k} of these" for k in range(9)]})
    sent = [row for out in jaccard._segments(5, 3)(iter([batch, batch])) for row in out.to_pylist() if row["kind"] == "sets"]
    tags = [tag for row in sent for tag in row["tags"]]
    assert len(sent) > 2 and len({row["slice"] for row in sent}) == len(sent)
    assert len(set(tags)) == 18 and all(0 <= tag < 2**63 for tag in tags)


def test_keep_one_of_each(spark):
    docs = documents(spark, with_clashes=True).filter("doc_id IS NOT NULL AND doc_id <> 7")
    want = {c for _i, _n, c in brute_components([r[:2] for r in rows() if r[0] not in (None, 7)])}
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert {row.doc_id for row in kept.collect()} == want


def test_components_of_long_paths_and_stars(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(500, 400), (400, 450)]
    found = components(spark.createDataFrame(pairs, "x bigint, y bigint"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 400: 400, 450: 400, 500: 400}
    assert components(spark.createDataFrame([], "x bigint, y bigint")).isEmpty()


def brute_passages(table):
    first = {}
    known = [(number, (text or "").encode()) for number, text in table]
    for number, data in known:
        if number is not None:
            for p in range(len(data) - LENGTH + 1):
                key = data[p : p + LENGTH]
                first[key] = min(first.get(key, number), number)
    out = []
    for number, data in known:
        gone = [False] * len(data)
        if number is not None:
            for p in range(len(data) - LENGTH + 1):
                if first[data[p : p + LENGTH]] < number:
                    gone[p : p + LENGTH] = [True] * LENGTH
        spans = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((number, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


PASSAGE_COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("clashes", [False, True])
def test_repeated_passages(spark, clashes):
    found = repeated_passages(documents(spark, clashes))
    assert as_rows(found, *PASSAGE_COLUMNS) == sorted_rows(brute_passages([r[:2] for r in rows()]))


def test_repeated_passages_over_many_slices(spark, monkeypatch):
    rng = random.Random(3)
    pool = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(30, 200))) for _ in range(12)]
    table = [(k, "".join(rng.choice(pool) for _ in range(4)) + str(k)) for k in range(60)]
    table += [(k, "ab" * rng.randrange(20, 60)) for k in range(60, 70)]
    import gridzonal.llm.suffixes as suffixes

    monkeypatch.setattr(suffixes, "SLICE_BYTES", 3000)
    found = repeated_passages(spark.createDataFrame(table, "doc_id bigint, text string").repartition(4))
    assert as_rows(found, *PASSAGE_COLUMNS) == sorted_rows(brute_passages(table))


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(5)
    for count in (0, 1, 2, 3, 7, 16):
        runs = [sorted({bytes(rng.choice(b"ab\x00") for _ in range(8)) for _ in range(rng.randrange(0, 30))}) for _ in range(count)]
        coded = []
        for run in runs:
            shared = front_code(np.frombuffer(b"".join(run), np.uint8).reshape(-1, 8)).tolist() if run else []
            coded.append((shared, [text[s:] for s, text in zip(shared, run)]))
        out, last = [], b""
        for run, place, shared in merge_runs(coded):
            text = runs[run][place]
            common = next((k for k, (a, b) in enumerate(zip(text, last)) if a != b), min(len(text), len(last)))
            assert shared == common
            out.append(text)
            last = text
        assert out == sorted(itertools.chain(*runs))


@pytest.mark.parametrize("operator", [exact_groups, near_components, repeated_passages, keep_exact, keep_one_of_each])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], DOCS)).isEmpty()


def test_hot_text_of_a_third(spark):
    table = [(k, "the very same text of a hot group, long enough to be a passage of its own") for k in range(300)]
    table += [(k, f"text number {k} " + " ".join(words(k, 20))) for k in range(300, 900)]
    docs = spark.createDataFrame(table, "doc_id bigint, text string").repartition(6)
    groups = exact_groups(docs)
    assert groups.filter("kept").count() == 601
    assert groups.filter("doc_id < 300 AND keep_id = 299 AND group_size = 300").count() == 300
    near = near_components(docs)
    assert near.filter("doc_id < 300 AND component_id = 0").count() == 300
    gone = repeated_passages(docs)
    assert gone.filter("n_removed = n_bytes").count() >= 299
    assert gone.agg(F.count("*")).first()[0] == 900


def template_corpus(spark, count):
    """Documents of two templates out of four, in an order, and six words of their own: sixteen components, none linked to another."""
    templates = [words(100 + k, 60, 5000) for k in range(4)]
    table = []
    for k in range(count):
        own = [f"own{k}x{j}" for j in range(6)]
        table.append((k, " ".join(templates[k % 4] + templates[k // 4 % 4] + own), "en", "a", 1))
    return spark.createDataFrame(table, DOCS).repartition(4), table


def test_components_that_share_templates_are_not_paired_member_by_member(spark, monkeypatch):
    plain, counted = jaccard.count_links, []

    def counting(pairs, *rest):
        counted[-1].append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(jaccard, "count_links", counting)
    for count in (128, 512):
        counted.append([])
        docs, table = template_corpus(spark, count)
        found = near_components(docs)
        assert as_rows(found, "doc_id", "n_shingles", "component_id") == sorted_rows(brute_components([r[:2] for r in table]))
        assert sum(counted[-1]) <= 4 * count
    assert sum(counted[1]) <= 5 * sum(counted[0])


def test_runs_fill_all_shards_alike():
    import gridzonal.llm.suffixes as suffixes

    generator = random.Random(5)
    texts = ["".join(generator.choices("abcdefgh ", k=4000)) for _ in range(40)]
    rows = pa.table({"doc_id": list(range(40)), "text": texts, "slice": pa.array([0] * 40, pa.int32())})
    held = suffixes._Slice(rows, None, 32)
    held.runs()
    counts = np.bincount(held.run_shard.astype(int), minlength=32)
    assert counts.sum() > 3000 and counts.max() < 2 * counts.mean()


def test_a_task_on_shingles_gives_its_memory_back(monkeypatch):
    from gridzonal.llm import text

    monkeypatch.setattr(jaccard, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two three four five six", "seven"]})
    sent = pa.Table.from_batches(list(jaccard._segments(5, 2)(iter([batch]))))
    assert sent.num_rows and not text._powers


def test_components_that_are_stars_already_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "materialise", lambda table, label: written.append(label) or materialise(table, label))
    pairs = [(1, 5), (7, 1), (1, 7), (3, 2), (4, 4)]
    found = components(spark.createDataFrame(pairs, "x bigint, y bigint"))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 2), (3, 2), (5, 1), (7, 1)]
    assert written == ["edges"]
    written.clear()
    found = components(spark.createDataFrame([(1, 2), (3, 2), (9, 3)], "x bigint, y bigint"))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1), (9, 1)]
    assert "stars" in written


def test_nothing_is_compared_when_no_list_holds_two_components(spark, monkeypatch):
    written = []
    monkeypatch.setattr(jaccard, "materialise", lambda table, label: written.append(label) or materialise(table, label))
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base + [f"end{i}"]) for i in range(4)] + [" ".join(f"v{i}" for i in range(30))]
    table = list(enumerate(texts))
    found = near_components(spark.createDataFrame(table, "doc_id bigint, text string"))
    assert as_rows(found, "doc_id", "n_shingles", "component_id") == sorted_rows(brute_components(table))
    assert "near-lists" in written and "placed" not in written


def test_sets_are_cut_into_segments_where_they_lie(spark, monkeypatch):
    plans = {}

    def spy(table, label):
        plans[label] = table._jdf.queryExecution().optimizedPlan().toString()
        return materialise(table, label)

    monkeypatch.setattr(jaccard, "materialise", spy)
    base = [f"w{i}" for i in range(60)]
    table = [(i, " ".join(base + [f"end{i}"])) for i in range(4)]
    found = near_components(spark.createDataFrame(table, "doc_id bigint, text string"))
    assert as_rows(found, "doc_id", "n_shingles", "component_id") == sorted_rows(brute_components(table))
    assert "collect_list" not in plans["segments"]


@pytest.mark.parametrize("fragments", [1, 4, 7])
def test_segments_hold_every_item_once(spark, fragments):
    top = (1 << 56) - 1
    sets = [(1, [0, top, 5, 1 << 55, 1 << 54, (1 << 54) - 1]), (2, [top]), (3, [])]
    found = jaccard.cut(spark.createDataFrame(sets, "tag bigint, items array<bigint>"), fragments).collect()
    assert all(v * fragments >> 56 == r.part for r in found for v in r.segment)
    assert sorted((r.tag, v) for r in found for v in r.segment) == sorted((t, v) for t, items in sets for v in items)
