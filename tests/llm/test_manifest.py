"""Merkle manifests next to a plain construction: layout, roots, proofs and tampering."""

import hashlib
import itertools
import random
import zlib

import pytest

from cases import DOCS, as_rows, documents, rows
from gridzonal.llm import merkle
from gridzonal.llm.merkle import address, build_block, build_manifest, counts_of, levels_of, merkle_proofs, siblings
from gridzonal.storage import fresh_path

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(number, text, lang, source, chars):
    fields = [number, source, lang, chars, text]
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def grow(nodes):
    """(top, for every leaf the list of (left siblings, right siblings) upwards)."""
    paths = [[] for _ in nodes]
    members = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for first in range(0, len(nodes), 3):
            run = nodes[first : first + 3]
            for k in range(len(run)):
                for leaf in members[first + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha("".join(run)))
            over.append(list(itertools.chain(*members[first : first + 3])))
        nodes, members = up, over
    return nodes[0], paths


def brute(table):
    by_source = {}
    for row in table:
        by_source.setdefault(row[3], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        order = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees[source] = (order, *grow([leaf_of(*r) for r in order]))
    root, upper = grow([trees[s][1] for s in sources])
    out = []
    for source, above in zip(sources, upper):
        order, subroot, paths = trees[source]
        for row, own in zip(order, paths):
            path = own + above
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = leaf_of(row[0], text, *row[2:])
            for left, right in path:
                folded = sha(left + folded + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((row[0], leaf_of(*row), subroot, root, proof, folded, folded == root))
    return out


def ordered(found):
    return sorted(found, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


@pytest.mark.parametrize("clashes, height", [(False, 1), (True, 6)])
def test_equals_plain_construction(spark, clashes, height):
    found = merkle_proofs(documents(spark, clashes), height)
    assert as_rows(found, *COLUMNS) == ordered(brute(rows()))


def test_many_sources_and_several_layers(spark):
    rng = random.Random(4)
    table = [(k, f"t{k}\n" * (k % 3), "en", None if k % 50 == 0 else f"s{min(rng.randrange(60), 30)}", k) for k in range(700)]
    found = merkle_proofs(spark.createDataFrame(table, DOCS).repartition(5), 2)
    want = brute(table)
    assert as_rows(found, *COLUMNS) == ordered(want)
    assert {row[6] for row in want} == {True, False}


def test_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_PATHS", 0)
    assert as_rows(merkle_proofs(documents(spark), 1), *COLUMNS) == ordered(brute(rows()))


def test_empty_and_single(spark):
    assert merkle_proofs(documents(spark, empty=True)).collect() == []
    one = spark.createDataFrame([(None, None, None, None, None)], DOCS)
    leaf = sha("-----")
    assert [tuple(r) for r in merkle_proofs(one).collect()] == [(None, leaf, leaf, leaf, sha(""), leaf, True)]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 9, 26, 27, 28, 80, 243])
def test_layout_has_every_node_once_and_halves(size):
    for levels in range(levels_of(size), levels_of(size) + 3):
        places = [address(level, i, levels, size) for level, n in enumerate(counts_of(size, levels)) for i in range(n)]
        assert sorted(places) == list(range(len(places)))
        assert address(levels - 1, 0, levels, size) == 0
    # The nodes of a bottom subtree lie together.
    levels = levels_of(size)
    bottom = levels - levels // 2
    if levels > 1:
        inside = [address(level, i, levels, size) for level in range(bottom) for i in range(min(3 ** (bottom - 1 - level), counts_of(size, levels)[level]))]
        assert max(inside) - min(inside) == len(inside) - 1


def test_siblings_by_address():
    leaves = [sha(str(k)) for k in range(50)]
    top, paths = grow(leaves)
    levels = levels_of(50)
    nodes = build_block(leaves, levels)
    assert nodes[0] == top
    assert [siblings(nodes, k, levels, 50) for k in range(50)] == paths


def test_stored_blocks_are_bounded(spark):
    table = spark.range(400).selectExpr("id AS doc_id", "'x' AS text", "'l' AS lang", "'one' AS source", "1L AS n_chars")
    manifest = build_manifest(table, fresh_path(spark, "merkle"), 3)
    sizes = [row["size"] for row in manifest.layers[0].collect()]
    assert max(sizes) == 27 and sum(sizes) == 400 and len(manifest.layers) == 2
    assert manifest.layers[1].first()["root"] == manifest.root
