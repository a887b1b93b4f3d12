"""Token files, packing and mixing."""

import glob
import math
import random
import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow.orc as orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import DOCS, as_rows, documents, rows
from gridzonal.llm.mixing import mix, poisson_steps, repetition_rates
from gridzonal.llm.packing import match_runs, pack
from gridzonal.llm.token_orc import read_token_orc, token_digests, write_token_orc
from gridzonal.llm.tokens import Encoder
from gridzonal.storage import fresh_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(library):
    hard = [
        "İ Á b̸= ≠ a.́ x—. don't. it's'd. 'S<|endoftext|>. \x1ca\x85b ΑΣ. Σ ẞ.", "5.5. ① ﬁ. ẛ̣. é, é... Ω. Å, 𝒜.", "<|startoftext|>,", "a b c",
        *[chr(c) + mark + end for c in range(65, 91) for mark in ("", "́", "̇", "̸", "̧") for end in ("", ".", ',"')],
        "ÀÉÎÕÜß ÞÐ× ÷ ÿ. Ÿ!", "'", "''s", "''", "a'", "naïve's!", "£5 €6 «é».", "é" * 300,
    ]
    texts = [text for _i, text, *_ in rows()] + hard
    coded = Encoder(PATH).encode(texts)
    for text, got in zip(texts, coded):
        assert got == b"".join(i.to_bytes(4, "little") for i in ids_of(library, text)), text


def test_encoder_tells_special_tokens_by_their_case(library):
    texts = ["<|ENDOFTEXT|>", "<|EndOfText|>", "a<|STARTOFTEXT|>B. <|startoftext|>Word<|endoftext|>", "X<|endoftext|>Y<|Endoftext|>", "AB<| CD <|>É<|"]
    encoder = Encoder(PATH)
    for text, got in zip(texts + texts[::-1], encoder.encode(texts) + encoder.encode(texts[::-1])):
        assert got == b"".join(i.to_bytes(4, "little") for i in ids_of(library, text)), text
    assert all(token.content.startswith("<|") for token in library.get_added_tokens_decoder().values())


def test_encoder_composes_before_it_lowers(library):
    marks = [chr(c) for c in range(0x300, 0x370)]
    texts = [" ".join(chr(c) + mark + end for mark in marks for end in ("", ".", "x")) for c in [*range(65, 91), *range(97, 123)]]
    texts += ["aT\u0591\u0308B É\u0308 H\u0331h\u0331 T \u0308", "\u0308T", "J\u030c" * 50]
    encoder = Encoder(PATH)
    for text, got in zip(texts + texts[::-1], encoder.encode(texts) + encoder.encode(texts[::-1])):
        assert got == b"".join(i.to_bytes(4, "little") for i in ids_of(library, text)), text
    rng = random.Random(8)
    signs = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0x300, 0x346), 0x20, 0x2E, 0xC4, 0xE9, 0x1E97, 0x212A, 0x130)]
    texts = ["".join(rng.choice(signs) for _ in range(12)) for _ in range(20_000)]
    for text, got in zip(texts, encoder.encode(texts)):
        assert got == b"".join(i.to_bytes(4, "little") for i in ids_of(library, text)), text


def test_encoder_memory_is_bounded(library, monkeypatch):
    import gridzonal.llm.tokens as tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    encoder = Encoder(PATH)
    for start in range(0, 400, 20):
        text = " ".join(f"word{k}" for k in range(start, start + 40))
        assert encoder.encode([text])[0] == b"".join(i.to_bytes(4, "little") for i in ids_of(library, text))
        assert len(encoder.young) < 200


@pytest.mark.parametrize("clashes", [False, True])
def test_token_files(spark, library, clashes):
    path = fresh_path(spark, "orc")
    write_token_orc(documents(spark, clashes), path, PATH, end_id=1)
    found = token_digests(spark, path)
    coded = [(number, [*ids_of(library, text), 1]) for number, text, *_ in rows()]
    crc = [(n, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))) for n, ids in coded]
    order = lambda r: [(v is None, v or 0) for v in r]
    assert sorted(as_rows(found, "doc_id", "n_tokens", "ids_crc32"), key=order) == sorted(crc, key=order)
    # Nulls come first; within equal ids any order will do.
    placed = sorted(found.collect(), key=lambda r: r["start"])
    assert [r["start"] for r in placed] == [sum(r["n_tokens"] for r in placed[:k]) for k in range(len(placed))]
    ids = [r["doc_id"] for r in placed]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_token_files_prune_by_id(spark):
    path = fresh_path(spark, "orc")
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text number ', id, ' and more') AS text")
    write_token_orc(docs, path, PATH, end_id=1)
    one = read_token_orc(spark, path).filter("doc_id = 1234")
    assert one.count() == 1
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,1234)]" in one._jdf.queryExecution().toString()
    local = path.removeprefix("file:")
    files = [orc.ORCFile(f) for f in glob.glob(f"{local}/*.orc")]
    assert sum(f.nrows for f in files) == 3000 and all(f.compression == "ZSTD" for f in files if f.nrows)
    assert all(f.row_index_stride == 1000 for f in files if f.nrows)


def check_packing(found, coded, capacity):
    pieces = defaultdict(list)
    for row in found:
        pieces[row.sequence_id].append((row.offset, row.length))
    for held in pieces.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    want = sorted(
        (str(n), k, k * capacity, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))
        for n, ids in coded
        for k, part in enumerate(ids[s : s + capacity] for s in range(0, len(ids), capacity))
    )
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    return len(pieces)


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_packing(spark, library, capacity):
    found = pack(documents(spark, with_clashes=True), PATH, 0, capacity).collect()
    coded = [(number, [*ids_of(library, text), 0]) for number, text, *_ in rows()]
    used = check_packing(found, coded, capacity)
    assert used <= -(-sum(len(ids) for _n, ids in coded) // capacity) * 1.2 + 1


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        able = [g for g in gaps if g >= length]
        gap = min(able) if able else capacity
        if able:
            gaps.remove(gap)
        gaps.append(gap - length)
    return len(gaps)


def test_runs_give_the_sequences_of_best_fit_decreasing():
    held = {100: 3, 99: 1, 61: 7, 60: 2, 40: 9, 39: 5, 30: 1, 21: 8, 20: 3, 7: 20, 1: 11}
    matches = match_runs(held, 100)
    used = {m[3] + k for m in matches for k in range(m[2] - m[1])}
    assert len(used) == max(used) + 1 == best_fit_decreasing([n for n, c in held.items() for _ in range(c)], 100)
    for length, count in held.items():
        ranks = sorted(k for m in matches if m[0] == length for k in range(m[1], m[2]))
        assert ranks == list(range(count))


def test_runs_give_the_sequences_of_best_fit_decreasing_on_random_lengths():
    rng = random.Random(9)
    cases = [(100, {30: 4, 23: 3})]
    for _ in range(300):
        capacity = rng.choice([7, 60, 100, 257])
        cases.append((capacity, {rng.randrange(1, capacity + 1): rng.randrange(1, 30) for _ in range(rng.randrange(1, 14))}))
    for capacity, held in cases:
        matches = match_runs(held, capacity)
        filled, ranks = defaultdict(list), defaultdict(list)
        for length, first_rank, end_rank, first, offset in matches:
            ranks[length] += range(first_rank, end_rank)
            for sequence in range(first, first + end_rank - first_rank):
                filled[sequence].append((offset, length))
        assert {length: len(r) for length, r in ranks.items()} == held
        assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
        for pieces in filled.values():
            pieces.sort()
            assert [o for o, _n in pieces] == [sum(n for _o, n in pieces[:k]) for k in range(len(pieces))]
            assert sum(n for _o, n in pieces) <= capacity
        want = best_fit_decreasing([n for n, c in held.items() for _ in range(c)], capacity)
        assert len(filled) == max(filled) + 1 == want, (capacity, held)


def poisson_quantile(rate, u):
    k, p, upto = 0, math.exp(-rate), math.exp(-rate)
    while upto <= u and k < rate + 12 * math.sqrt(rate) + 40:
        k += 1
        p *= rate / k
        upto += p
    return k if rate > 0 else 0


def test_poisson_steps_are_the_distribution(spark):
    rates = [0.0, 0.01, 0.7, 3.0, 40.0, 900.0]
    found = spark.createDataFrame([(r,) for r in rates], "rate double").select("rate", poisson_steps(F.col("rate")).alias("s"))
    for row in found.collect():
        for u in (0.0, 0.2, 0.5, 0.99):
            count = sum(step <= u for step in row.s)
            if row.rate < 700:
                assert count == poisson_quantile(row.rate, u), (row.rate, u)
            elif u:
                assert abs(count - row.rate) < 4 * math.sqrt(row.rate)


def test_mixing(spark):
    docs = documents(spark)
    rates = {r.source: r.rate for r in repetition_rates(docs).collect()}
    sizes = defaultdict(int)
    for _n, text, _l, source, _c in rows():
        sizes[source] += max(1, len(text or ""))
    for source, size in sizes.items():
        want = math.sqrt(size) / sum(map(math.sqrt, sizes.values())) * sum(sizes.values()) / size
        assert rates[source] == pytest.approx(want)
    mixed = mix(docs)
    again = mix(docs.repartition(1))
    assert as_rows(mixed, *mixed.columns) == as_rows(again, *again.columns)
    keys = [r.shuffle_key for r in mixed.collect()]
    assert keys == sorted(keys) and len(set(keys)) > 1
    named = spark.createDataFrame([("b", 1.0), ("absent", 5.0)], "source string, weight double")
    assert {r.source for r in mix(docs, named, epochs=3.0).select("source").distinct().collect()} == {"b"}
    with pytest.raises(ValueError, match="clash"):
        mix(docs.withColumn("copy", F.lit(1)))


def test_mixing_reaches_target_weights(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('x', 20) AS text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) AS source")
    weights = spark.createDataFrame([("hot", 0.2), *[(f"s{k}", 0.8 / 7) for k in range(7)]], "source string, weight double")
    counts = {r.source: r["count"] for r in mix(docs, weights).groupBy("source").count().collect()}
    assert sum(counts.values()) == pytest.approx(6000, rel=0.06)
    assert counts["hot"] == pytest.approx(1200, rel=0.12)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    path = fresh_path(spark, "orc")
    write_token_orc(docs, path, PATH, end_id=1)
    assert token_digests(spark, path).isEmpty()
    assert pack(docs, PATH, 0, 2048).isEmpty()
    assert mix(docs).isEmpty()


def test_letters_are_remembered_once_whatever_closes_them(library):
    encoder = Encoder(PATH)
    texts = ["Harbour, harbour. harbour! (harbour) HARBOUR", None, "  harbour;\n\tharbour, ", ""]
    for text, got in zip(texts, encoder.encode(texts)):
        assert got == b"".join(i.to_bytes(4, "little") for i in ids_of(library, text or "")), text
    assert not {b"harbour,", b"harbour.", b"harbour!", b"harbour;"} & set(encoder.young)
    assert b"harbour" in encoder.young


@pytest.mark.parametrize("whole", [True, False])
def test_a_task_leaves_nothing_remembered_in_its_worker(whole):
    import pyarrow as pa

    from gridzonal.llm import packing, token_orc, tokens

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words here", "and others"], "file_no": pa.array([0, 0], pa.int32())})
    for run in (packing._cut(PATH, 0, 2048), token_orc._encode_sorted(PATH, 1)):
        found = run(iter([batch, batch]))
        assert next(found).num_rows == 2
        assert tokens.encoder(PATH).young
        if whole:
            assert sum(b.num_rows for b in found) == 2
        found.close()
        assert not tokens.encoder(PATH).young and not tokens.encoder(PATH).old
