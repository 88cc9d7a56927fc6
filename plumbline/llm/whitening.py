"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

With the centred vectors as rows of X, unit vectors v (one number for each dimension) and u (one for
each row) are made in turn: ``u = Xv - beta u'``, ``v = X^T u - alpha v'``, each orthogonalised
against all before it, so that ``XV = UB`` with B bidiagonal.  The singular values and right
singular vectors of B, a matrix as small as the dimensions, give variances and components.

A step is one pass over the rows.  Every u is ``Xq`` for a short vector q, so tasks work out their
part of U from X and never store it; a pass returns the sums of ``Xv`` against U (what is to be taken
off), of its squares, and of ``X^T`` times it.  The driver holds V, Q and B only.

All dimensions are bidiagonalised, with a new random direction where the space of the last one is
used up, so no copy of a multiple variance is missed.  Vectors are integers and centring is exact:
``(n x - S) / n`` is rounded once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import settle

#: fixed values of the contract
SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
SEED = 20240607
#: entries of larger magnitude have no integer
_LARGEST = float(1 << 52)
_SAFE = 1 << 62
#: parts of the whole deviation below which a length is rounding: what is left of a used-up space, or of
#: dimensions that don't vary; a shorter u would not be orthogonal to the others in double precision
NOTHING = 1e-9


# -------------------------------------------------------------------- vectors


def _usable(column: str) -> Column:
    """Not null, and all entries present, finite and within what an integer holds."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE >= _LARGEST)
    return F.col(column).isNotNull() & ~F.exists(F.col(column), bad)


def integer_vectors(table: DataFrame, column: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """key, x (eight bytes for each entry, settled) of all vectors that count, and their dimensions."""
    rows = table.filter(_usable(column)).select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("c"))
    # vectors of another length than most have no place in the space
    lengths = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dims = lengths["d"] if lengths else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(SCALE * batch.column(1).flatten().to_numpy()).astype("<i8") + SHIFT
            raw = x.tobytes()
            width = 8 * dims
            packed = pa.array([raw[i * width : (i + 1) * width] for i in range(batch.num_rows)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["key", "x"])

    kind = rows.schema["key"].dataType.simpleString()
    return settle(rows.filter(F.size("c") == dims).mapInArrow(run, f"key {kind}, x binary")), dims


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dims)


@dataclass
class Centre:
    """The fit list: how many vectors, their exact sums, and their largest entry."""

    n: int
    sums: list[int]
    largest: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact: as Python integers where 64 bits could overflow."""
        if 2 * self.n * max(1, self.largest) < _SAFE:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred vectors, rounded once."""
        return (self.deviations(x) / self.n).astype(np.float64)

    def square_sums(self, x: np.ndarray) -> list[int]:
        d = self.deviations(x)
        if d.dtype == object or (d.size and int(np.abs(d).max()) ** 2 * d.shape[1] >= _SAFE):
            d = d.astype(object)
        return (d * d).sum(axis=1).tolist()


def fit_centre(vectors: DataFrame, dims: int) -> Centre:
    """Exact sums over all vectors, as partial sums of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, largest, sums = 0, 0, np.zeros(dims, object)
        for batch in batches:
            x = matrix(batch.column(1), dims)
            if len(x):
                n, largest = n + len(x), max(largest, int(np.abs(x).max()))
                # 64 bits hold the sums of two thousand entries of 52
                for at in range(0, len(x), 2000):
                    sums = sums + x[at : at + 2000].sum(axis=0).astype(object)
        values = [n, largest, *[int(s) for s in sums]]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values, pa.decimal128(38, 0))], names=["i", "value"])

    partial = vectors.mapInArrow(run, "i int, value decimal(38,0)")
    total = partial.groupBy("i").agg(F.sum("value").alias("sum"), F.max("value").alias("max")).collect()  # dims + 2 rows
    found = {r.i: r for r in total}
    if not found:
        return Centre(0, [0] * dims, 0)
    return Centre(int(found[0].sum), [int(found[k + 2].sum) for k in range(dims)], int(found[1].max))


def summed(vectors: DataFrame, centre: Centre, dims: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all batches of what ``of`` gives for their centred rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(centre.rows(matrix(batch.column(1), dims)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "value"])

    rows = vectors.mapInArrow(run, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()
    return np.array([r.value for r in sorted(rows, key=lambda r: r.i)])


# ----------------------------------------------------------- bidiagonalisation


@dataclass
class Components:
    """Unit components as columns, their variances (falling), and the trace of the covariance."""

    vectors: np.ndarray
    variances: np.ndarray
    trace: float


def _orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(step: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float, np.ndarray, float]], dims: int) -> tuple[np.ndarray, np.ndarray, float]:
    """V, B and the sum of squares of X.

    ``step(g, Q)`` makes ``w = Xg`` and gives ``(XQ)^T w``, ``w^T w``, ``X^T w`` and the sum of squares.
    """
    rng = np.random.default_rng(SEED)
    v_all, q_all, z_all = (np.zeros((dims, dims)) for _ in range(3))  # z is X^T u
    b, beta, squares = np.zeros((dims, dims)), 0.0, 0.0

    def direction(k: int, wanted: np.ndarray | None) -> np.ndarray:
        """Unit vector orthogonal to the first ``k``; a random one where none is wanted."""
        v = rng.normal(size=dims) if wanted is None else wanted
        for _ in range(2):  # a short vector loses its right angle when it is stretched
            v = _orthogonal(v, v_all[:, :k])
            v = v / np.linalg.norm(v)
        return v

    onward = None
    for k in range(dims):
        v_all[:, k] = v = direction(k, onward)
        q_old, z_old = q_all[:, :k], z_all[:, :k]
        g = v - beta * q_old[:, -1] if k else v
        overlap, length, z, squares = step(g, q_old)
        least = NOTHING * np.sqrt(max(squares, 0.0))
        alpha, beta, onward = np.sqrt(max(0.0, length - overlap @ overlap)), 0.0, None
        if alpha > least:
            q, z = (g - q_old @ overlap) / alpha, (z - z_old @ overlap) / alpha
            again = q_old.T @ z  # U^T u, what rounding has left
            q, z = q - q_old @ again, z - z_old @ again
            size = np.sqrt(q @ z)
            q_all[:, k], z_all[:, k] = q / size, z / size
            b[k, k] = alpha = alpha * size
            onward = _orthogonal(z_all[:, k] - alpha * v, v_all[:, : k + 1])
            beta = float(np.linalg.norm(onward))
        if k + 1 < dims:
            if beta > least:
                b[k, k + 1] = beta
            else:  # the space of the last start is used up
                beta, onward = 0.0, None
    return v_all, b, squares


def fit_components(vectors: DataFrame, centre: Centre, dims: int, most: int = COMPONENTS) -> Components:
    """The ``most`` components of largest variance; those without variance are left out."""

    def step(g: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, float]:
        k = q.shape[1]

        def of(x: np.ndarray) -> np.ndarray:
            w = x @ g
            return np.concatenate([(x @ q).T @ w, [w @ w], x.T @ w, [np.einsum("ij,ij", x, x)]])

        total = summed(vectors, centre, dims, of)
        return total[:k], float(total[k]), total[k + 1 : k + 1 + dims], float(total[-1])

    if not centre.n or not dims:
        return Components(np.zeros((dims, 0)), np.zeros(0), 0.0)
    v, b, squares = bidiagonalise(step, dims)
    _, deviation, turned = np.linalg.svd(b)
    there = deviation > NOTHING * np.sqrt(max(squares, 0.0))
    few = min(most, int(there.sum()))
    found = v @ turned[:few].T
    found /= np.linalg.norm(found, axis=0)
    return Components(found, deviation[:few] ** 2 / centre.n, squares / centre.n)


# -------------------------------------------------------------------- whitened


def identity_error(vectors: DataFrame, centre: Centre, dims: int, projection: np.ndarray) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = projection.shape[1]
    if not k:
        return 0.0

    def of(x: np.ndarray) -> np.ndarray:
        white = x @ projection
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    total = summed(vectors, centre, dims, of) / centre.n
    # the vectors are centred, so their mean is rounding
    return float(np.abs(total[k:].reshape(k, k) - np.outer(total[:k], total[:k]) - np.eye(k)).max())


def whiten(table: DataFrame, column: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error for every vector and component.

    Vectors that are null, or hold null, non-finite or (beyond 2^52 / 1024) too large entries, are
    dropped, and so are those of another length than most vectors (of two lengths equally frequent,
    the larger counts).  ``deviation`` is an exact decimal, null beyond 38 digits.  Repeated rows
    count each time.  Components without variance are left out, so equal vectors, or an empty
    table, give no rows.  Other columns are not read.
    """
    vectors, dims = integer_vectors(table, column, key)
    centre = fit_centre(vectors, dims)
    fitted = fit_components(vectors, centre, dims, most)
    projection = fitted.vectors / np.sqrt(fitted.variances) if len(fitted.variances) else fitted.vectors
    error = identity_error(vectors, centre, dims, projection)
    explained = fitted.variances / fitted.trace if fitted.trace else fitted.variances
    k = projection.shape[1]
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if k else ():
            x = matrix(batch.column(1), dims)
            rows = np.repeat(np.arange(len(x)), k)
            square = pa.array([s if s < 10**38 else None for s in centre.square_sums(x)], pa.decimal128(38, 0))
            columns = [
                batch.column(0).take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), centre.n, np.int64)),
                square.take(pa.array(rows)),
                pa.array((centre.rows(x) @ projection).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(rows), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = vectors.schema["key"].dataType.simpleString()
    return vectors.mapInArrow(run, f"{key} {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
