"""Embedding whitening by QDWH spectral divide and conquer.

1. Sums of all vectors, exact in whole numbers; the vectors of the most frequent length are the fit list.
2. Their covariance: rows are centred exactly (n * x - S, whole numbers) before anything is multiplied; tasks send one matrix each, which
   is added up row by row on the cluster. The matrix of a fit, dimension by dimension, is all that comes to the driver.
3. Its eigenvectors by divide and conquer: the polar factor of the covariance less a shift (QDWH: dynamically weighted Halley steps by QR
   and Cholesky factors) has eigenvalues 1 and -1, so (U + I) / 2 projects on the space above the shift. Bases of this space and of the one
   below split the matrix in two, and each half is split on until the parts are single components.
4. The whitening matrix (dimensions times components) travels with the tasks; one pass measures the covariance of the whitened rows, one
   gives them out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import session, written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
EPS = float(np.finfo(float).eps)
ROWS = 2048                         # vectors multiplied at once


# ---- spectral divide and conquer ---------------------------------------------------------------------

def polar(a: np.ndarray, steps: int = 30) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QR-based dynamically weighted Halley iteration."""
    n = len(a)
    x = a / (np.linalg.norm(a) or 1.0)
    low = EPS                                                # no singular value below it counts; more steps if one is there
    eye = np.eye(n)
    for _ in range(steps):
        sq = low * low
        d = np.cbrt(4 * (1 - sq) / (sq * sq))
        root = np.sqrt(1 + d)
        w = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - sq) / (sq * root))
        b = (w - 1) ** 2 / 4
        c = w + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            new = b / c * x + (w - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            half = np.linalg.cholesky(eye + c * (x.T @ x))
            new = b / c * x + (w - b / c) * np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
        new = (new + new.T) / 2
        low = min(1.0, low * (w + b * sq) / (1 + c * sq))
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 10 * EPS and moved <= np.cbrt(5 * EPS):
            break
    return x


def _spaces(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | int:
    """Orthonormal bases of the spaces of eigenvalues above and below ``shift``, or the number above it if there is nothing to split."""
    n = len(a)
    above = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    k = int(round(float(np.trace(above))))
    if k in (0, n):
        return k
    basis = np.linalg.qr(above @ np.random.default_rng(n).standard_normal((n, k)))[0]
    q = np.linalg.qr(above @ basis, mode="complete")[0]
    return q[:, :k], q[:, k:]


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix."""
    values, vectors = [], []
    todo = [(a, np.eye(len(a)))] if len(a) else []
    while todo:
        part, basis = todo.pop()
        n = len(part)
        level = float(np.trace(part)) / n
        rest = part - level * np.eye(n)
        spread = float(np.linalg.norm(rest))
        if n == 1 or spread <= 4 * EPS * np.sqrt(n) * abs(level) or spread == 0:        # one component, or equal ones: any basis will do
            values += [float(x) for x in np.diag(part)]
            vectors += list(basis.T)
            continue
        low, high = level - spread, level + spread
        shift, split = float(np.median(np.diag(part))), None
        for _ in range(60):
            if not low < shift < high:
                shift = (low + high) / 2
            got = _spaces(part, shift)
            if not isinstance(got, int):
                one, two = got
                # a shift that all but meets an eigenvalue gives no clean cut: try beside it
                if np.linalg.norm(two.T @ part @ one) <= 100 * n * EPS * np.linalg.norm(part):
                    split = got
                    break
                shift += (high - low) * 1e-3
                continue
            low, high = (shift, high) if got == n else (low, shift)
            shift = level if low < level < high else (low + high) / 2
        if split is None:
            values += [float(x) for x in np.diag(part)]
            vectors += list(basis.T)
            continue
        for q in split:
            half = q.T @ part @ q
            todo.append(((half + half.T) / 2, basis @ q))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors)[order].T.reshape(len(a), -1)


# ---- sums over the rows -------------------------------------------------------------------------------

def _whole(vector: str) -> tuple[Column, Column]:
    """Whether every entry is a finite number, and the entries as whole numbers."""
    c = F.col(vector)
    finite = c.isNotNull() & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(finite, F.lit(False)), F.transform(c, lambda x: F.floor(x.cast("double") * SCALE).cast("long") + OFFSET)


def _matrices(batches, at: int):
    """Vectors of equal length of Arrow batches as matrices with the places of their rows."""
    for b in batches:
        column = b.column(at)
        size = column.value_lengths().to_numpy(zero_copy_only=False)
        flat, start = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(size) - size
        for d in np.unique(size).tolist():
            rows = np.flatnonzero(size == d)
            for i in range(0, len(rows), ROWS):
                part = rows[i:i + ROWS]
                yield b, part, flat[start[part][:, None] + np.arange(d)].astype(np.int64).reshape(len(part), d)


def _sums(batches):
    n: dict[int, int] = {}
    total: dict[int, np.ndarray] = {}
    for _, _, x in _matrices(batches, 0):
        d = x.shape[1]
        n[d] = n.get(d, 0) + len(x)
        total[d] = total.get(d, 0) + x.sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int32()), pa.array(list(n.values()), pa.int64()), pa.array([t.tolist() for t in total.values()], pa.list_(pa.int64()))],
                                     names=["d", "n", "s"])


def _products(n: int, s: np.ndarray, weights: np.ndarray | None) -> Callable:
    """Each task's sum of products of the centred rows (times ``weights``) with themselves, a row of the matrix a row; then their sum."""
    def run(batches):
        total, d = 0.0, len(s) if weights is None else weights.shape[1]
        for _, _, x in _matrices(batches, 0):
            if x.shape[1] == len(s):
                z = (n * x - s) / n
                if weights is not None:
                    z = z @ weights
                total = total + np.vstack([z.T @ z, z.sum(axis=0)])
        if not isinstance(total, float):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"])
    return run


def _add(table: pa.Table) -> pa.Table:
    rows = np.sort(np.array(table.column("row").to_pylist()), axis=0)         # in an order of their own, not of arrival
    return pa.Table.from_arrays([table.column("i").slice(0, 1), pa.array([rows.sum(axis=0).tolist()], pa.list_(pa.float64()))], names=["i", "row"])


def _covariance(vectors: DataFrame, n: int, s: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    parts = vectors.select("x").mapInArrow(_products(n, s, weights), "i int, row array<double>")
    rows = parts.groupBy("i").applyInArrow(_add, "i int, row array<double>").collect()
    table = np.array([r.row for r in sorted(rows, key=lambda r: r.i)])
    mean = table[-1] / n
    return table[:-1] / n - np.outer(mean, mean) if weights is not None else (table[:-1] + table[:-1].T) / (2 * n)


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: rows ``(x - s / n) @ weights`` have the identity as covariance, up to ``identity_error``."""
    n: int
    s: np.ndarray
    weights: np.ndarray
    explained: list[float]
    identity_error: float


def whole_vectors(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key`` and ``x``: the rows whose vector is there and holds finite numbers only, entries c as floor(64 * c) + 1,000,000."""
    session(rows.sparkSession)
    fine, x = _whole(vector)
    return rows.where(fine).select(F.col(key).alias("key"), x.alias("x"))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all ``vectors`` (of ``whole_vectors``) of the most frequent length (ties: the longest); None if there are none."""
    sums = written(vectors.select("x").mapInArrow(_sums, "d int, n long, s array<long>"), "sums", few=True)
    top = sums.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), F.col("d").desc()).first()
    if top is None:
        return None
    each = sums.where(F.col("d") == top.d).select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    s = np.array([r.v for r in sorted(each, key=lambda r: r.i)], np.int64)
    if not len(s):
        return None
    cov = _covariance(vectors, top.n, s)
    values, basis = spectrum(cov)
    # components without variance (beyond rounding) cannot be whitened
    k = min(components, int((values > len(s) * EPS * max(values[0], 0.0)).sum()))
    weights = basis[:, :k] / np.sqrt(values[:k])
    error = float(np.abs(_covariance(vectors, top.n, s, weights) - np.eye(k)).max()) if k else 0.0
    return Whitening(top.n, s, weights, (values[:k] / np.trace(cov)).tolist(), error)


def _whiten(model: Whitening) -> Callable:
    most = np.sqrt(2.0 ** 63 / len(model.s)) * (1 - 1e-9)

    def run(batches):
        for b, rows, x in _matrices(batches, 1):
            if x.shape[1] != len(model.s):
                continue
            y = model.n * x - model.s
            fits = np.abs(y.astype(float)).max(axis=1) < most
            deviation = (y * y).sum(axis=1)
            z = (y / model.n) @ model.weights
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(deviation, mask=~fits), values], names=["key", "deviation", "values"])
    return run


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` for every fitted row and component (1 is the largest).

    Rows whose vector is null or holds null or non-finite entries are left out, so are those of another length than the most frequent one
    (ties: the longest). Rows without key and rows that repeat count and come out each. Components without variance (a constant
    dimension, fewer rows than dimensions) cannot be whitened and have no rows; an empty table has none at all. ``deviation`` (the sum of
    (n * x - S) squared) is null where it does not fit in a long; entries beyond a long are an error of the arithmetic.
    """
    vectors = whole_vectors(rows, vector, key)
    kind = dict(vectors.dtypes)["key"]
    model = fit(vectors, components)
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if model is None or not model.explained:
        return rows.sparkSession.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    out = vectors.mapInArrow(_whiten(model), f"key {kind}, deviation long, values array<double>")
    out = out.select("key", "deviation", F.posexplode("values").alias("at", "whitened"))
    share = F.element_at(F.array(*[F.lit(x) for x in model.explained]), F.col("at") + 1)
    return out.select("key", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long"), "deviation", "whitened", share, F.lit(model.identity_error)).toDF(*names)
