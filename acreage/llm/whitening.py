"""Whitening of vectors: distributed covariance, float32 eigenvectors, and their refinement to double precision by matrix products.

Only sums go to the driver: one number for each pair of dimensions, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acreage.llm.common import stored

SCALE = 256
#: Rows of a matrix that is worked on at a time, and rounds of refinement at most (each squares the error).
ROWS, ROUNDS = 4096, 12


# --- eigenvectors -----------------------------------------------------------------------------------------------------


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima step: better vectors, their values, the size of the correction, and the gap below which values are a cluster.

    With R = I - X'X and S = X'AX the correction of vector j along vector i is (S_ij + v_j R_ij) / (v_j - v_i); inside a
    cluster only orthogonality can be mended, by R_ij / 2.
    """
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    norm = lambda m: float(np.sqrt((m * m).sum()))
    near = 2 * (norm(s - np.diag(values)) + norm(a) * norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, float(np.abs(e).max(initial=0)), near


def _clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Groups of two and more values, sorted, of which each is within ``near`` of the next one."""
    order = np.argsort(values, kind="stable")
    cut = np.flatnonzero(np.diff(values[order]) > near) + 1
    return [g for g in np.split(order, cut) if len(g) > 1]


def refined_eigen(v: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Vectors start in float32 and are corrected by products in extended precision. Where values are too close for a
    correction, the part of the matrix that their vectors span is shifted by its mean value and solved on its own, which
    shows the gaps that the whole matrix hides. The largest entry of each vector is positive.
    """
    size = float(np.abs(v).max(initial=0))
    if not size:
        return np.zeros(len(v)), np.eye(len(v))
    a = (v / size).astype(np.longdouble)
    a = (a + a.T) / 2
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    done = np.finfo(np.float64).eps / 8
    for _ in range(rounds):
        x, values, moved, near = _step(a, x)
        if moved <= done:
            break
        for g in _clusters(values, near):
            part = x[:, g]
            shift = values[g].mean()
            t = part.T @ (a @ part) - shift * (part.T @ part)
            x[:, g] = part @ np.linalg.eigh(((t + t.T) / 2).astype(np.float64))[1].astype(np.longdouble)
    x = x + x @ ((np.eye(len(v), dtype=a.dtype) - x.T @ x) / 2)
    values = ((a @ x) * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order] * size
    top = x[np.abs(x).argmax(axis=0), np.arange(len(v))]
    return values.astype(np.float64), (x * np.where(top < 0, -1, 1)).astype(np.float64)


# --- rows -------------------------------------------------------------------------------------------------------------


def integer_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """``(key, x)`` with x = floor(256 c) of every vector that takes part, and the dimension.

    Null vectors and those with a null or non-finite entry are left out; shorter ones count as padded with zeros. An entry
    that has no 64-bit integer raises an error.
    """
    d = vectors.select(F.col(key), F.col(vector).cast("array<double>").alias("x"))
    d = d.filter(F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    width = d.agg(F.max(F.size("x"))).first()[0] or 0
    whole = lambda c: F.when(F.abs(c * SCALE) < 2.0**63, F.floor(c * SCALE)).otherwise(F.raise_error("a vector entry has no 64-bit integer").cast("bigint"))
    x = F.concat(F.transform("x", whole), F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("x")))
    return d.select(key, x.alias("x")), width


def _matrices(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and integer matrix of each piece of a batch."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.column("x").slice(at, ROWS)
        yield at, part.flatten().to_numpy().reshape(len(part), width)


def reduced(rows: DataFrame, width: int, fn: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum of ``fn(matrix)``, an array whose size doesn't depend on the rows, over all rows: added up in tasks, then by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for _, x in _matrices(b, width):
                made = fn(x).ravel()
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])

    parts = rows.select("x").mapInArrow(run, f"i bigint, v {kind}").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)" if kind == "bigint" else kind)).alias("v"))
    return np.array([int(r["v"]) if kind == "bigint" else r["v"] for r in parts.orderBy("i").collect()], object if kind == "bigint" else float)


def _limbs(x: np.ndarray) -> np.ndarray:
    """Column sums as two halves of 32 bits, which stay exact for whatever fits a task."""
    return np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])


@dataclass(frozen=True)
class Whitening:
    """Mean and principal components of ``n`` distinct integer vectors."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])

    @property
    def live(self) -> np.ndarray:
        """Components that have a variance, beyond what rounding leaves."""
        return self.values > max(1e-300, len(self.values) * np.finfo(float).eps * float(self.values.max(initial=0)))

    def project(self, x: np.ndarray, components: int) -> np.ndarray:
        """Whitened coordinates; NaN where a component has no variance."""
        y = (x - self.mean) @ self.vectors[:, :components]
        live = self.live[:components]
        return np.where(live, y / np.sqrt(np.where(live, self.values[:components], 1)), np.nan)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exact: n^2 (x.x) - 2 n (x.S) + S.S."""
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        far = max((abs(s) for s in self.sums), default=0)
        exact = x if x.shape[1] * most * max(most, far) < 2**63 else x.astype(object)
        s = np.array(self.sums, np.int64 if exact is x and far < 2**63 else object)
        own, cross = (exact * exact).sum(axis=1), exact @ s
        return list(own.astype(object) * self.n**2 - cross.astype(object) * (2 * self.n) + sum(c * c for c in self.sums))


def fit(rows: DataFrame, width: int) -> Whitening | None:
    """Whitening of the rows ``x``, which must be distinct; None without rows. Rows are centred before they are multiplied."""
    n = rows.count()
    if not n or not width:
        return None
    halves = reduced(rows, width, _limbs, "bigint")
    sums = tuple(int(h) * 2**32 + int(low) for h, low in zip(halves[:width], halves[width:]))
    mean = np.array([float(Fraction(s, n)) for s in sums])

    def products(x: np.ndarray) -> np.ndarray:
        c = x - mean
        return c.T @ c

    v = reduced(rows, width, products).reshape(width, width) / n
    values, vectors = refined_eigen(v)
    return Whitening(n, sums, values, vectors, float(np.trace(v)))


def identity_error(rows: DataFrame, width: int, w: Whitening, components: int) -> float | None:
    """Largest entry of the covariance of the whitened rows less the identity, over components that have a variance."""
    live = int(w.live[:components].sum())
    if not live:
        return None
    mean = reduced(rows, width, lambda x: w.project(x, live).sum(axis=0)) / w.n

    def products(x: np.ndarray) -> np.ndarray:
        y = w.project(x, live) - mean
        return y.T @ y

    return float(np.abs(reduced(rows, width, products).reshape(live, live) / w.n - np.eye(live)).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """One row for each vector and each of its first components: key, component (from 1), n, deviation, whitened, explained,
    identity_error, deviation_exact.

    The fit has each distinct vector once. ``deviation`` is null where it has no 64-bit integer; ``deviation_exact``, a
    decimal, holds it then too (null beyond 38 digits). A component without variance has null for ``whitened``, and for
    ``explained`` if nothing varies. Rows with a null key and repeated rows are kept; other columns are ignored; no vectors,
    or none with entries, give no rows.
    """
    rows, width = integer_vectors(vectors, key, vector)
    distinct = stored(rows.select("x").distinct(), "distinct")
    w = fit(distinct, width)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"k {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    if w is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("k", key)
    count = min(components, width)
    error = identity_error(distinct, width, w, count)
    explained = [float(v) / w.trace if w.trace > 0 else None for v in w.values[:count]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in _matrices(b, width):
                size = len(x)
                exact = w.deviations(x)
                twice = lambda values, kind: pa.array(values, kind).take(pa.array(np.repeat(np.arange(size), count)))
                columns = [
                    b.column("k").slice(at, size).take(pa.array(np.repeat(np.arange(size), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * count, w.n)),
                    twice([d if d < 2**63 else None for d in exact], pa.int64()),
                    pa.array(w.project(x, count).ravel(), from_pandas=True),
                    pa.array(explained * size, pa.float64()),
                    pa.array([error] * (size * count), pa.float64()),
                    twice([d if d < 10**38 else None for d in exact], pa.decimal128(38, 0)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["k", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    return rows.select(F.col(key).alias("k"), "x").mapInArrow(run, schema).withColumnRenamed("k", key)
