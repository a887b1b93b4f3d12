"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers, floor(64 * c) + 1,000,000, stored as blocks of rows. With n vectors of sums S, the centred
matrix X has the entries (n * x - S) / n, whose numerator is exact. The bidiagonalisation alternates p = X v and r = X' u, each a
distributed pass over the blocks; every new u and v is orthogonalised against all earlier ones, twice. The long vectors
u are never stored or moved: each lies in the range of X, so it is kept as u = X w with a short w, and a
pass forms all of them block by block. A pass sends the driver as many numbers as there are steps and dimensions. The SVD of the
small bidiagonal matrix yields components and deviations; steps end when the leading components have
converged, or with the last dimension.

Vectors that are null, hold a null or non-finite entry, or differ in length from most take no part; one with an entry beyond
``LARGEST`` stops the job with its id, and so does a squared distance beyond 64 bits. Null ids and repeated rows take part each. Components
without variance are left out, so equal vectors, or a single one, give an empty result, as an empty table does. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.storage import materialise

UNIT, OFFSET = 64, 1_000_000
LARGEST = 1 << 44
COMPONENTS = 32
BLOCK_BYTES = 2 << 20
CONVERGED = 1e-15
NEGLIGIBLE = 1e-13
PARTIALS = 512

BLOCKS = "width int, held bigint, ids array<bigint>, x binary"
WHITENED = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"

_NUMBERS = {"bigint": pa.int64(), "double": pa.float64()}


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors to blocks of integers, a block for each length that occurs in a batch."""
    for batch in batches:
        vectors = batch.column("vector")
        flat = vectors.flatten().cast(pa.float64())
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        lengths = np.where(np.isnan(lengths.astype(float)), -1, lengths).astype(np.int64)
        ends = np.cumsum(np.maximum(lengths, 0))
        starts = ends - np.maximum(lengths, 0)
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        fine = (lengths >= 0) & (bad[ends] == bad[starts])
        out = []
        for width in np.unique(lengths[fine]).tolist():
            rows = np.flatnonzero(fine & (lengths == width))
            size = max(1, BLOCK_BYTES // max(1, 8 * width))
            for first in range(0, len(rows), size):
                part = rows[first : first + size]
                x = np.floor(values[starts[part][:, None] + np.arange(width)] * UNIT) + OFFSET
                ids = batch.column("vec_id").take(pa.array(part))
                large = np.flatnonzero((np.abs(x) > LARGEST).any(axis=1))
                if len(large):
                    raise ValueError(f"vector {ids[int(large[0])].as_py()} has an entry that is too large to whiten")
                out.append((width, len(part), ids.to_pylist(), x.astype("<i8").tobytes()))
        for width, held, ids, data in out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([width], pa.int32()), pa.array([held]), pa.array([ids], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                names=["width", "held", "ids", "x"],
            )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row["ids"], np.frombuffer(row["x"], "<i8").reshape(row["held"], row["width"])


def _sum_blocks(blocks: DataFrame, of: Callable[[np.ndarray], np.ndarray], dtype: str) -> np.ndarray:
    """Sum ``of`` (a matrix of integers -> a vector of fixed length) over all blocks, in an order that does not change.

    A task sends one row. The rows of up to ``PARTIALS`` tasks go to the driver; those of more are summed in groups of neighbours first.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _ids, x in _matrices(batches):
            total = of(x) if total is None else total + of(x)
        if total is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([total.tolist()], pa.list_(_NUMBERS[dtype]))], names=["part", "value"]
            )

    rows = blocks.mapInArrow(partial, f"part bigint, value array<{dtype}>")
    tasks = blocks.rdd.getNumPartitions()
    if tasks > PARTIALS:
        ordered = F.array_sort(F.collect_list(F.struct("part", "value")))
        add = lambda total, one: F.zip_with(total, one["value"], lambda a, b: a + b)
        start, rest = F.element_at(ordered, 1)["value"], F.slice(ordered, F.lit(2), F.size(ordered))
        size = -(-tasks // PARTIALS)
        rows = rows.groupBy(F.floor(F.col("part") / size).alias("part")).agg(F.aggregate(rest, start, add).alias("value"))
    total = None
    for row in sorted(rows.collect(), key=lambda row: row["part"]):
        value = np.array(row["value"])
        total = value if total is None else total + value
    return total


class _Products:
    """The passes over X: for w's and a q, the inner products of X q with every X w and itself, and X' X q."""

    def __init__(self, blocks: DataFrame, n: int, sums: np.ndarray):
        self.blocks, self.n, self.sums = blocks, n, sums

    def __call__(self, w: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        n, sums, both, count = self.n, self.sums, np.column_stack([w, q]), w.shape[1]

        def products(x: np.ndarray) -> np.ndarray:
            centred = _centred(x, n, sums)
            spread = centred @ both
            p = spread[:, -1]
            return np.concatenate([spread.T @ p, p @ centred])

        found = _sum_blocks(self.blocks, products, "double")
        return found[:count], float(found[count]), found[count + 1 :]


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (x * n - sums) / n


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalise(product: Callable, outside: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """The largest ``wanted`` singular values of X and their right singular vectors, as columns, orthogonal to those ``outside``.

    The last value tells whether the bidiagonalisation went through all dimensions.
    """
    width = len(outside)
    generator = np.random.default_rng(width + outside.shape[1])

    def fresh(v: np.ndarray) -> np.ndarray:
        start = _orthogonal(generator.standard_normal(width), np.column_stack([outside, v]))
        return start / np.linalg.norm(start)

    v, w, z = np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((width, 0))
    alphas: list[float] = []
    betas: list[float] = []
    beta, largest, new = 0.0, 0.0, fresh(v)
    while True:
        v = np.column_stack([v, new])
        # p = X v - beta u, less its parts along all earlier u, twice; the second pass yields X' p as well.
        q = new - (beta * w[:, -1] if w.shape[1] else 0.0)
        along, _square, _back = product(w, q)
        q = q - w @ along
        along, square, back = product(w, q)
        q, back = q - w @ along, back - z @ along
        alpha = float(np.sqrt(max(0.0, square - along @ along)))
        largest = max(largest, alpha, beta)
        if alpha <= NEGLIGIBLE * largest:
            alpha, q, back = 0.0, np.zeros(width), np.zeros(width)
        else:
            q, back = q / alpha, back / alpha
        alphas.append(alpha)
        w, z = np.column_stack([w, q]), np.column_stack([z, back])
        rest = _orthogonal(back - alpha * new, np.column_stack([outside, v]))
        beta = float(np.linalg.norm(rest))
        left, deviations, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        whole = len(alphas) == width - outside.shape[1]
        cut_off = beta <= NEGLIGIBLE * largest
        converged = len(alphas) > wanted and (beta * np.abs(left[-1, :wanted])).max() <= CONVERGED * deviations[0]
        if whole or (converged and not cut_off):
            return deviations[:wanted], v @ right.T[:, :wanted], whole
        if cut_off:
            # An invariant subspace: go on from a direction outside it.
            beta, new = 0.0, fresh(v)
        else:
            new = rest / beta
        betas.append(beta)


def leading(product: Callable, width: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``bidiagonalise``, also where singular values are equal, of which one start sees one: what is left is searched again."""
    deviations, vectors, whole = bidiagonalise(product, np.zeros((width, 0)), wanted)
    while not whole and vectors.shape[1] < width:
        more, beside, whole = bidiagonalise(product, vectors, 1)
        if more[0] <= deviations[wanted - 1] * (1 + 1e-12):
            break
        deviations, vectors, whole = np.append(deviations, more), np.column_stack([vectors, beside]), False
        order = np.argsort(-deviations, kind="stable")
        deviations, vectors = deviations[order], vectors[:, order]
    return deviations[:wanted], vectors[:, :wanted]


def _apply(n: int, sums: np.ndarray, projection: np.ndarray, explained: list[float], error: float):
    count = projection.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches):
            shifted = x * n - sums
            reach = int(np.abs(shifted).max(initial=0))
            if reach * reach * x.shape[1] >= 1 << 63:
                squares = [sum(int(c) ** 2 for c in row) for row in shifted]
                if max(squares) >= 1 << 63:
                    raise ValueError(f"the squared distance of vector {ids[int(np.argmax(squares))]} needs more than 64 bits")
                deviation = np.array(squares, dtype=np.int64)
            else:
                deviation = (shifted * shifted).sum(axis=1)
            whitened = (shifted / n) @ projection
            rows = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()).take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, n)),
                    pa.array(np.repeat(deviation, count)),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * count, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


class Whitening:
    """A fitted transformation: n, sums, components as columns, their eigenvalues, the trace and the identity error."""

    def __init__(self, blocks: DataFrame, n: int, sums: np.ndarray, components: int):
        self.blocks, self.n, self.sums = blocks, n, sums
        width = len(sums)
        wanted = min(components, width)
        deviations, vectors = leading(_Products(blocks, n, sums), width, wanted)
        # What is left of a component without variance is rounding.
        kept = deviations > NEGLIGIBLE * max(deviations[0], np.finfo(float).tiny) * np.sqrt(width)
        self.eigenvalues = deviations[kept] ** 2 / n
        self.vectors = vectors[:, kept]
        self.projection = self.vectors / np.sqrt(self.eigenvalues)
        self.trace = float(_sum_blocks(blocks, lambda x: np.array([(_centred(x, n, sums) ** 2).sum()]), "double")[0]) / n
        self.identity_error = self._identity_error()

    def _identity_error(self) -> float:
        n, sums, projection = self.n, self.sums, self.projection
        count = projection.shape[1]
        if not count:
            return 0.0

        def moments(x: np.ndarray) -> np.ndarray:
            y = _centred(x, n, sums) @ projection
            return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

        found = _sum_blocks(self.blocks, moments, "double") / n
        covariance = found[count:].reshape(count, count) - np.outer(found[:count], found[:count])
        return float(np.abs(covariance - np.eye(count)).max())


def encode_vectors(vectors: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """The blocks of all vectors that take part, written."""
    chosen = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    blocks = materialise(chosen.mapInArrow(_encode, BLOCKS), "vectors")
    widths = blocks.groupBy("width").agg(F.sum("held").alias("held")).orderBy(F.desc("held"), "width").first()
    return blocks.filter(F.lit(False)) if widths is None else blocks.filter(F.col("width") == widths["width"])


def fit_whitening(blocks: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all blocks; None if they hold no numbers."""
    n = blocks.agg(F.sum("held")).first()[0]
    if not n or not blocks.first()["width"]:
        return None
    sums = _sum_blocks(blocks, lambda x: x.sum(axis=0), "bigint")
    largest = blocks.select("x").mapInArrow(_largest, "value bigint").agg(F.max("value")).first()[0]
    if largest * n >= 1 << 62:
        raise ValueError(f"{n} vectors with entries up to {largest} need sums of more than 64 bits")
    return Whitening(blocks, n, sums, components)


def _largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        most = [int(np.abs(np.frombuffer(x, "<i8")).max(initial=0)) for x in batch.column("x").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(most, pa.int64())], names=["value"])


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, vector_col: str = "embedding", id_col: str = "vec_id"
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component.

    ``deviation`` is the squared distance to the mean in units of 1/n, ``explained`` the component's share of the variance and
    ``identity_error`` the largest entry of the whitened covariance less the identity.
    """
    blocks = encode_vectors(vectors, vector_col, id_col)
    fitted = fit_whitening(blocks, components)
    if fitted is None or not fitted.projection.shape[1]:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    explained = (fitted.eigenvalues / fitted.trace).tolist()
    rows = blocks.mapInArrow(_apply(fitted.n, fitted.sums, fitted.projection, explained, fitted.identity_error), WHITENED)
    return rows
