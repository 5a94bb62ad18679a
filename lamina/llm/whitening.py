"""Whitening of embeddings on their leading principal components.

The covariance is added up over all vectors in tasks, centred before anything is multiplied. It is brought to tridiagonal form by
Householder reflections; bisection on Sturm counts finds the leading eigenvalues, inverse iteration their vectors, orthogonalised
again within clusters of close eigenvalues. The projection reaches the tasks by broadcast; its size depends on the dimension alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
# Eigenvalues below this share of the largest one are zero but for rounding: there is no variance to scale to one.
RANK = 1e-12
# Eigenvalues closer than this share of the matrix norm get their vectors orthogonalised against each other.
_CLUSTER = 1e-3
_EPS = np.finfo(np.float64).eps
_LONGEST = 2**63 - 1


class Model(NamedTuple):
    n: int
    sums: np.ndarray  # of the integer vectors, by dimension
    components: np.ndarray  # one row for each, unit length
    eigenvalues: np.ndarray
    trace: float


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, side diagonal, Q) with matrix = Q T Q' for a symmetric matrix."""
    a = matrix.astype(np.float64).copy()
    n = len(a)
    q = np.eye(n)
    for j in range(n - 2):
        x = a[j + 1 :, j]
        # Scaled, so that squares neither overflow nor vanish.
        largest = np.abs(x).max()
        if largest == 0 or not np.abs(x[1:]).any():
            continue
        v = x / largest
        v[0] += math.copysign(math.sqrt(v @ v), v[0])
        v /= math.sqrt(v @ v)
        # Two-sided update of the rest: a - 2vw' - 2wv'.
        rest = a[j + 1 :, j + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        side = x - 2 * v * (v @ x)
        a[j + 1 :, j] = side
        a[j, j + 1 :] = side
        q[:, j + 1 :] -= 2 * np.outer(q[:, j + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def count_below(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of `at`: negative pivots of T - x."""
    tiny = np.finfo(np.float64).tiny * max(1.0, float((e**2).max(initial=0.0)))
    pivot = d[0] - at
    pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
    count = (pivot < 0).astype(np.int64)
    for i in range(1, len(d)):
        pivot = d[i] - at - e[i - 1] ** 2 / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, all bisected at once until no number lies between their bounds."""
    n = len(d)
    radius = np.zeros(n)
    radius[:-1] += np.abs(e)
    radius[1:] += np.abs(e)
    margin = _EPS * n * max(float(np.abs(d).max()), float(radius.max()), np.finfo(np.float64).tiny)
    low, high = np.full(k, (d - radius).min() - 2 * margin), np.full(k, (d + radius).max() + 2 * margin)
    wanted = n - np.arange(k)  # the j-th largest has n - j smaller ones, and itself
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return np.sort(middle)[::-1]
        above = count_below(d, e, middle) < wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _solved(d: np.ndarray, e: np.ndarray, shifts: np.ndarray, right: np.ndarray) -> np.ndarray:
    """x of (T - shift) x = right for each shift (a column), by elimination with row exchanges."""
    n, k = right.shape
    norm = max(float(np.abs(d).max()), float(np.abs(e).max(initial=0.0)), np.finfo(np.float64).tiny)
    smallest = _EPS * norm
    # The three diagonals of the triangular factor; b is reduced along the way.
    u0, u1, u2, b = np.zeros((n, k)), np.zeros((n, k)), np.zeros((n, k)), right.copy()
    main, above = d[0] - shifts, np.full(k, e[0] if n > 1 else 0.0)
    for i in range(n - 1):
        below, next_main = np.full(k, e[i]), d[i + 1] - shifts
        next_above = np.full(k, e[i + 1] if i + 2 < n else 0.0)
        swap = np.abs(below) > np.abs(main)
        main = np.where(~swap & (np.abs(main) < smallest), smallest, main)
        u0[i] = np.where(swap, below, main)
        u1[i] = np.where(swap, next_main, above)
        u2[i] = np.where(swap, next_above, 0.0)
        factor = np.where(swap, main / np.where(swap, below, 1.0), below / main)
        kept, other = np.where(swap, b[i + 1], b[i]), np.where(swap, b[i], b[i + 1])
        b[i], b[i + 1] = kept, other - factor * kept
        main = np.where(swap, above - factor * next_main, next_main - factor * above)
        above = np.where(swap, -factor * next_above, next_above)
    u0[n - 1] = np.where(np.abs(main) < smallest, smallest, main)
    x = np.zeros((n, k))
    for i in range(n - 1, -1, -1):
        rest = b[i].copy()
        if i + 1 < n:
            rest -= u1[i] * x[i + 1]
        if i + 2 < n:
            rest -= u2[i] * x[i + 2]
        x[i] = rest / u0[i]
    return x


def inverse_iteration(d: np.ndarray, e: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors (columns) for the falling eigenvalues; those of a cluster are orthogonalised after every round."""
    n, k = len(d), len(values)
    norm = max(float(np.abs(d).max()), float(np.abs(e).max(initial=0.0)), np.finfo(np.float64).tiny)
    shifts = values.copy()
    first = np.zeros(k, np.int64)  # where the cluster of each value begins
    for j in range(1, k):
        near = values[j - 1] - values[j] < _CLUSTER * norm
        first[j] = first[j - 1] if near else j
        # Equal values would give the same vector again and again.
        if near:
            shifts[j] = min(shifts[j], shifts[j - 1] - 10 * _EPS * norm)
    z = np.random.default_rng(7).uniform(0.5, 1.0, (n, k)) * np.where(np.random.default_rng(8).random((n, k)) < 0.5, -1, 1)
    for _ in range(rounds):
        z /= np.abs(z).max(axis=0)
        z = _solved(d, e, shifts, z)
        z /= np.sqrt((z * z).sum(axis=0))
        for j in range(k):
            mates = z[:, first[j] : j]
            for _twice in range(2):
                z[:, j] -= mates @ (mates.T @ z[:, j])
            z[:, j] /= math.sqrt(z[:, j] @ z[:, j])
    return z


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the k largest eigenvalues that aren't zero; the entry of an eigenvector that
    is largest by amount is positive."""
    k = min(k, len(covariance))
    if not k or not np.abs(covariance).max(initial=0.0):
        return np.zeros(0), np.zeros((0, len(covariance)))
    d, e, q = tridiagonal(covariance)
    values = leading_eigenvalues(d, e, k)
    values = values[values > RANK * values[0]]
    vectors = (q @ inverse_iteration(d, e, values)).T
    vectors /= np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    largest = np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], axis=1)
    return values, vectors * np.sign(largest)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim): the vectors that are not NULL and hold no NULL or non-finite entry."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return vectors.where(x.isNotNull()).where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("v"), F.size(x).alias("dim"))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, integer vectors) of the vectors of each length in the batch."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        flat = batch.column("v").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield int(dim), rows, np.floor(SCALE * flat.reshape(len(rows), dim)).astype(np.int64) + SHIFT


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, rows, x in _by_dim(batch):
            n[dim] = n.get(dim, 0) + len(rows)
            sums[dim] = sums.get(dim, 0) + x.sum(axis=0)
    for dim in n:
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([n[dim]], pa.int64()), pa.array([sums[dim].tolist()], pa.list_(pa.int64()))], names=["dim", "n", "sums"]
        )


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n times the distance from the mean, exact; in Python's integers where 64 bits could be too few."""
    if n * (int(np.abs(x).max(initial=0)) + 1) < 2**62 and int(np.abs(sums).max(initial=0)) < 2**62:
        return n * x - sums
    return n * x.astype(object) - sums.astype(object)


def _outer_sums(project: dict[int, tuple[int, np.ndarray, np.ndarray]]):
    """Sums of products of centred vectors, a row of the matrix at a time; project: (n, sums, matrix applied first) by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _by_dim(batch):
                n, sums, matrix = project[dim]
                centred = _deviations(x, n, sums).astype(np.float64) / n
                if matrix is not None:
                    centred = centred @ matrix.T
                total[dim] = total.get(dim, 0) + centred.T @ centred
        for dim, square in total.items():
            rows = len(square)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * rows, pa.int32()), pa.array(range(rows), pa.int32()), pa.array(square.tolist(), pa.list_(pa.float64()))],
                names=["dim", "i", "row"],
            )

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sum of the tasks' rows, added in a fixed order of their values."""
    row = np.array(table.column("row").to_pylist(), np.float64)
    total = [math.fsum(column) for column in row.T]
    return pa.table({"dim": table.column("dim")[:1], "i": table.column("i")[:1], "row": pa.array([total], pa.list_(pa.float64()))})


def _square(rows: DataFrame, project: dict) -> dict[int, np.ndarray]:
    """Matrices by length; the driver gets the square of the dimension, whatever the number of rows."""
    schema = "dim int, i int, row array<double>"
    parts = rows.mapInArrow(_outer_sums(project), schema).groupBy("dim", "i").applyInArrow(_added, schema).collect()
    out: dict[int, list] = {}
    for dim, _, row in sorted(parts, key=lambda r: (r["dim"], r["i"])):
        out.setdefault(dim, []).append(row)
    return {dim: np.array(square) / project[dim][0] for dim, square in out.items()}


def fit(rows: DataFrame, k: int = COMPONENTS) -> dict[int, Model]:
    """A model for each length of vectors, over all of them. Rows are those of `usable`."""
    parts = rows.where("dim > 0").mapInArrow(_partial_sums, "dim int, n long, sums array<long>")
    wide = parts.select("dim", "n", F.posexplode("sums").alias("i", "s")).groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    n: dict[int, int] = {}
    sums: dict[int, list[int]] = {}
    for r in sorted(wide.collect(), key=lambda r: (r["dim"], r["i"])):
        n[r["dim"]] = r["n"]
        sums.setdefault(r["dim"], []).append(int(r["s"]))
    means = {d: (n[d], np.array(s) if max(map(abs, s)) < 2**62 else np.array(s, object), None) for d, s in sums.items()}
    models = {}
    for dim, covariance in _square(rows.where("dim > 0"), means).items():
        values, vectors = leading_components((covariance + covariance.T) / 2, k)
        models[dim] = Model(n[dim], means[dim][1], vectors, values, float(np.trace(covariance)))
    return models


def whiten(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue, dim): a row for each vector and component.

    NULL vectors and those with a NULL or non-finite entry are left out, and so are vectors without entries; rows without a vec_id and
    rows with the same vec_id are rows of their own. Vectors of another length are whitened among themselves. Directions without
    variance have no component: a table of equal vectors gives no rows, nor does an empty one. Components of equal eigenvalues are
    any orthogonal ones. `deviation` is NULL where it is beyond 64 bits. Other columns are not read.
    """
    rows = usable(vectors)
    spark = rows.sparkSession
    models = fit(rows, k)
    scaled = {d: (m.n, m.sums, m.components / np.sqrt(m.eigenvalues)[:, None]) for d, m in models.items()}
    errors = {
        d: float(np.abs(square - np.eye(len(square))).max(initial=0.0))
        for d, square in _square(rows.where("dim > 0"), scaled).items()
    } if models else {}
    shared = spark.sparkContext.broadcast((models, scaled, errors))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, scaled, errors = shared.value
        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue", "dim"]
        for batch in batches:
            for dim, at, x in _by_dim(batch):
                model = models.get(dim)
                if model is None or not len(model.eigenvalues):
                    continue
                moved = _deviations(x, model.n, model.sums)
                flat = (moved.astype(np.float64) / model.n @ scaled[dim][2].T).ravel()
                count, rows = len(model.eigenvalues), len(at)
                far = pa.array(_squares(moved), pa.int64())
                each = pa.array(np.repeat(np.arange(rows), count))

                def same(value, kind):
                    return pa.array(np.full(rows * count, value), kind)

                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(pa.array(at)).take(each), pa.array(np.tile(np.arange(1, count + 1), rows), pa.int32()),
                    same(model.n, pa.int64()), far.take(each), pa.array(flat), pa.array(np.tile(model.eigenvalues / model.trace, rows)),
                    same(errors[dim], pa.float64()), pa.array(np.tile(model.eigenvalues, rows)), same(dim, pa.int32()),
                ], names=names)

    return rows.where("dim > 0").mapInArrow(
        project, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double, dim int"
    )


def _squares(moved: np.ndarray) -> list[int | None]:
    """Sums of squares; exact, NULL beyond 64 bits."""
    if moved.dtype != object and int(np.abs(moved).max(initial=0)) ** 2 * max(1, moved.shape[1]) <= _LONGEST:
        return (moved * moved).sum(axis=1).tolist()
    wide = moved.astype(object)
    return [s if s <= _LONGEST else None for s in (int(v) for v in (wide * wide).sum(axis=1))]
