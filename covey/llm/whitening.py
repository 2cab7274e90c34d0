"""Whitening of embeddings by shifted CholeskyQR.

The distinct vectors, brought to a grid of whole numbers and centred, are the rows of a tall
matrix A. Each pass over them sums a Gram matrix: every task adds up its own rows, Spark adds up
the tasks. Its Cholesky factor R, with a small shift so that it always exists, makes the columns
of A closer to orthogonal by a triangular solve (Q R = A), row by row in the next pass. The rows
are never stored again: a pass solves by all factors so far. When the Gram matrix is a projector
(every eigenvalue 1, or 0 for a direction without variance), the composed factors and the root of
that Gram matrix hold all of A but its rotation; their singular vectors are the components and the
squares of their singular values, over n, the variances.

Defined cases: vectors that are null or empty, or hold a null, NaN or infinity, are left out, as are
those of another length than the most common one (ties: the longer). Repeated vectors count once in
the fit, and all are returned; repeated ids are rows of their own, and a null id stays null.
A component without variance has null as whitened value; an empty table gives no rows. A deviation
beyond 38 digits is null. Columns other than the two named ones are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.functions.columns import column
from covey.sources.shared import fresh_path, remove

#: Steps of the grid in a unit.
GRID = 256
_KEY, _X = "key", "x"
_EPS = float(np.finfo(np.float64).eps)
_MOST_PASSES = 12
_ORTHOGONAL = 1e-11
_ROWS_AT_ONCE = 4096
_LONG = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """A fit: ``n`` distinct vectors with sums ``sums``; unit ``components`` as rows, by falling
    variance ``eigenvalues``; the total variance; how far from the identity the covariance of the
    whitened fit rows is; the factors R of the passes."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None
    factors: list[np.ndarray]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scales(self) -> np.ndarray:
        """What a projection is multiplied by; NaN for a component without variance."""
        return _scales(self.eigenvalues, self.trace)


def on_grid(df: DataFrame, key: str = "vec_id", value: str = "embedding") -> DataFrame:
    """``key, x``: the usable vectors on the grid, ``x = floor(GRID * c)`` as longs."""
    vector = column(value).cast("array<double>")
    sound = (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.select(
        column(key).alias(_KEY), F.transform(vector, lambda c: F.floor(c * float(GRID))).alias(_X), sound.alias("sound")
    ).filter("sound").drop("sound")


def fit(df: DataFrame, key: str = "vec_id", value: str = "embedding", components: int = 4) -> Whitening | None:
    """The whitening of ``df``'s distinct vectors on the grid; None where there is none.

    They are written once; each pass sends a Gram matrix a task to Spark, and one to the driver.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "whitening")
    on_grid(df, key, value).select(_X).distinct().write.parquet(path)
    try:
        return _fit(spark.read.parquet(path), components)
    finally:
        remove(spark, path)


def _fit(rows: DataFrame, components: int) -> Whitening | None:
    longest = rows.groupBy(F.size(_X).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if longest is None:
        return None
    d, n = longest["d"], longest["count"]
    rows = rows.filter(F.size(_X) == d)
    sums = _sums(rows, d)
    mean = np.array([s / n for s in sums])
    factors: list[np.ndarray] = []
    gram = first = _gram(rows, d, lambda x: x - mean)
    for _ in range(_MOST_PASSES):
        if _is_projector(gram):
            break
        factors.append(_shifted_factor(gram))
        gram = _gram(rows, d, lambda x: solve(x - mean, factors))
    trace = float(np.trace(first)) / n
    composed = _root(gram)
    for r in reversed(factors):
        composed = composed @ r
    _, sigma, vt = np.linalg.svd(composed)
    eigenvalues = sigma**2 / n
    k = min(components, d)
    found = Whitening(n, sums, vt[:k], eigenvalues, trace, None, factors)
    varied = int(np.isfinite(found.scales[:k]).sum())
    if not varied:
        return found
    project = (vt[:varied] * found.scales[:varied, None]).T
    seen = _gram(rows, varied, lambda x: (x - mean) @ project) / n
    error = float(np.abs(seen - np.eye(varied)).max())
    return Whitening(n, sums, vt[:k], eigenvalues, trace, error, factors)


def solve(a: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows ``q`` with ``q R_k ... R_1 = a``: forward substitution by column, one factor at a time."""
    q = np.ascontiguousarray(a.T)
    for r in factors:
        for j in range(len(r)):
            q[j] = (q[j] - r[:j, j] @ q[:j]) / r[j, j]
    return q.T


def _shifted_factor(gram: np.ndarray) -> np.ndarray:
    """Upper R with R'R = gram + shift; the shift is near rounding and grows until R exists."""
    shift = 4 * len(gram) * _EPS * float(np.linalg.norm(gram, 2))
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift *= 10


def _is_projector(gram: np.ndarray) -> bool:
    values = np.linalg.eigvalsh(gram)
    return bool((np.minimum(abs(values), abs(values - 1)) <= _ORTHOGONAL).all())


def _root(gram: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(gram)
    return (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T


def _scales(eigenvalues: np.ndarray, trace: float) -> np.ndarray:
    flat = eigenvalues <= len(eigenvalues) * (64 * _EPS) ** 2 * trace
    return np.where(flat, np.nan, 1 / np.sqrt(np.where(flat, 1, eigenvalues)))


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, _ROWS_AT_ONCE):
            part = batch.slice(a, _ROWS_AT_ONCE)
            yield part, part.column(_X).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(rows: DataFrame, d: int) -> list[int]:
    """Exact sums of the positions over all rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for _, x in _matrices(batches, d):
            total = [t + int(s) for t, s in zip(total, x.sum(0), strict=True)]
        yield pa.record_batch(
            [pa.array(range(d), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0))], ["i", "part"]
        )

    got = rows.mapInArrow(add, "i int, part decimal(38,0)").groupBy("i").agg(F.sum("part").alias("s"))
    by_place = {r["i"]: int(r["s"]) for r in got.collect()}
    return [by_place[i] for i in range(d)]


def _gram(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``y'y`` over the rows' images ``y``; a task sends one triangle."""
    upper = np.triu_indices(width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if not batch.num_rows:
                continue
            length = len(batch.column(_X)[0])
            for _, x in _matrices([batch], length):
                y = of(x.astype(np.float64))
                total += y.T @ y
        yield pa.record_batch(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], ["i", "j", "part"]
        )

    got = rows.mapInArrow(add, "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("s")).collect()
    out = np.zeros((width, width))
    for r in got:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"]
    return out


def transform(df: DataFrame, found: Whitening | None, key: str = "vec_id", value: str = "embedding") -> DataFrame:
    """A row for each usable vector of the fit's length and component (from 1): ``key`` under its
    own name, ``component``, ``n``, exact ``deviation`` (sum of ``(n x - S)^2``, decimal),
    ``whitened``, ``explained`` and the fit's ``identity_error``. Row-local."""
    kind = df.select(column(key)).schema[0].dataType.simpleString()
    schema = f"{_KEY} {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if found is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed(_KEY, key)
    k, d = found.components.shape
    mean, scales = found.mean, found.scales[:k]
    project = (found.components * np.where(np.isnan(scales), 0, scales)[:, None]).T
    share = found.eigenvalues[:k] / found.trace if found.trace > 0 else np.zeros(k)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, d):
            m = len(x)
            whitened = (x - mean) @ project
            far = pa.array([v if abs(v) < 10**38 else None for v in deviations(x, found.n, found.sums)], pa.decimal128(38, 0))
            each = np.repeat(np.arange(m), k)
            yield pa.record_batch(
                [
                    part.column(_KEY).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, found.n)),
                    far.take(pa.array(each)),
                    pa.array(whitened.reshape(-1), mask=np.tile(np.isnan(scales), m)),
                    pa.array(np.tile(share, m)),
                    pa.array([found.identity_error] * (m * k), pa.float64()),
                ],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    usable = on_grid(df, key, value).filter(F.size(_X) == d)
    return usable.mapInArrow(apply, schema).withColumnRenamed(_KEY, key)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """``sum((n x - S)^2)`` of each row, exact: ``n^2 x.x - 2n x.S + S.S`` in whole numbers."""
    d, most = x.shape[1], int(abs(x).max(initial=0))
    widest = max(map(abs, sums), default=0)
    constant = sum(s * s for s in sums)
    if d * most * max(most, widest) < _LONG and widest < _LONG:
        squares = (x * x).sum(1).tolist()
        products = (x @ np.array(sums, np.int64)).tolist()
    else:
        rows = x.tolist()
        squares = [sum(v * v for v in row) for row in rows]
        products = [sum(v * s for v, s in zip(row, sums, strict=True)) for row in rows]
    return [n * n * q - 2 * n * p + constant for q, p in zip(squares, products, strict=True)]
