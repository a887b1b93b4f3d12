"""Whitening next to a dense eigendecomposition."""

import numpy as np
import pytest

from gridzonal.llm import whitening
from gridzonal.llm.whitening import bidiagonalise, leading, whiten

SCHEMA = "vec_id bigint, embedding array<double>, component int, n string"


def vectors(spark, data, extra=()):
    table = [(k, [float(c) for c in row], 7, "x") for k, row in enumerate(data)] + list(extra)
    return spark.createDataFrame(table, SCHEMA).repartition(3)


def dense(data):
    x = np.floor(np.asarray(data, dtype=np.float64) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    shifted = x * n - sums
    centred = shifted / n
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    return x, n, (shifted * shifted).sum(axis=1), centred, values[::-1], columns[:, ::-1]


def check(found, data, components):
    _x, n, deviation, centred, values, columns = dense(data)
    table = found.toPandas().sort_values(["vec_id", "component"])
    count = min(components, len(values))
    assert len(table) == n * count
    assert (table.n == n).all() and table.identity_error.nunique() == 1 and table.identity_error.iloc[0] < 1e-9
    got = table.whitened.to_numpy().reshape(n, count)
    want = centred @ columns[:, :count] / np.sqrt(values[:count])
    signs = np.sign((got * want).sum(axis=0))
    np.testing.assert_allclose(got * signs, want, atol=1e-6)
    np.testing.assert_allclose(table.explained.to_numpy().reshape(n, count)[0], values[:count] / values.sum(), rtol=1e-9)
    assert table.deviation.to_numpy().reshape(n, count)[:, 0].tolist() == deviation.tolist()


@pytest.fixture
def data():
    rng = np.random.default_rng(5)
    return rng.standard_normal((300, 9)) @ rng.standard_normal((9, 9)) + 3


@pytest.mark.parametrize("components", [1, 4, 32])
def test_equals_dense(spark, data, components):
    check(whiten(vectors(spark, data), components), data, components)


def test_leaves_out_what_takes_no_part(spark, data):
    bad = [(900, None, 0, ""), (901, [None] + [1.0] * 8, 0, ""), (902, [float("nan")] + [0.0] * 8, 0, ""), (903, [float("inf")] * 9, 0, ""), (904, [1.0, 2.0], 0, ""), (905, [], 0, "")]
    found = whiten(vectors(spark, data, bad), 3)
    assert found.columns == [field.split()[0] for field in whitening.WHITENED.split(", ")]
    check(found, data, 3)


def test_small_blocks_and_partials_summed_in_a_shuffle(spark, data, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 700)
    monkeypatch.setattr(whitening, "PARTIALS", 2)
    check(whiten(vectors(spark, data), 4), data, 4)


def test_components_without_variance_are_left_out(spark, data):
    data = np.column_stack([data, data[:, 0], np.full(len(data), 2.0)])
    found = whiten(vectors(spark, np.round(data * 64) / 64), 32)
    assert found.agg({"component": "max"}).first()[0] == 9
    assert found.first()["identity_error"] < 1e-9


def test_empty_and_constant(spark, data):
    assert whiten(vectors(spark, [])).collect() == []
    assert whiten(vectors(spark, [[1.0, 2.0]] * 5)).collect() == []
    assert whiten(vectors(spark, [[1.0, 2.0]])).collect() == []


def test_repeated_rows_and_null_ids(spark, data):
    twice = np.vstack([data, data])
    check(whiten(vectors(spark, twice), 3), twice, 3)
    found = whiten(vectors(spark, data, [(None, [0.0] * 9, 0, "")]), 2)
    assert found.filter("vec_id IS NULL").count() == 2 and found.filter("vec_id IS NULL").first()["n"] == 301


def test_refuses_what_does_not_fit(spark):
    with pytest.raises(Exception, match="vector 1 has an entry"):
        whiten(vectors(spark, [[1.0], [1e18]])).collect()
    with pytest.raises(Exception, match="64 bits"):
        whiten(vectors(spark, [[1.0], [1e11]])).collect()


@pytest.mark.parametrize("spectrum", [[5, 5, 5, 2, 1], [7, 7, 7, 7, 7], [9, 3, 0, 0, 0], [9, 8, 7, 6, 5]])
@pytest.mark.parametrize("width", [5, 40])
def test_equal_and_missing_deviations(spectrum, width):
    rng = np.random.default_rng(1)
    basis = np.linalg.qr(rng.standard_normal((width, width)))[0]
    values = np.array(list(spectrum) + [0.1] * (width - 5), dtype=float)
    x = np.linalg.qr(rng.standard_normal((80, width)))[0] @ np.diag(values) @ basis.T

    def product(w, q):
        spread = x @ np.column_stack([w, q])
        p = spread[:, -1]
        along = spread.T @ p
        return along[:-1], along[-1], x.T @ p

    wanted = np.sort(values)[::-1][:3]
    deviations, columns = leading(product, width, 3)
    np.testing.assert_allclose(deviations, wanted, atol=1e-12)
    np.testing.assert_allclose(columns.T @ columns, np.eye(3), atol=1e-12)
    np.testing.assert_allclose(x.T @ (x @ columns), columns * deviations**2, atol=1e-10)


def test_stops_when_converged():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 200)) * np.r_[[100.0, 60.0], np.full(198, 0.01)]
    calls = []

    def product(w, q):
        calls.append(1)
        spread = x @ np.column_stack([w, q])
        along = spread.T @ spread[:, -1]
        return along[:-1], along[-1], x.T @ spread[:, -1]

    deviations, _columns, whole = bidiagonalise(product, np.zeros((200, 0)), 2)
    assert not whole and len(calls) < 60
    np.testing.assert_allclose(deviations, np.linalg.svd(x)[1][:2], rtol=1e-13)
