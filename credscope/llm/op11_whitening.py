"""Embedding whitening by mixed-precision refinement of eigenvectors.

The covariance is summed over tasks in whole numbers, so it is exact until the
last division.  Its eigenvectors are first taken in float32, which is fast and
good to about seven digits, then corrected by the iteration of Ogita and
Aishima in extended precision.  A step costs a few matrix products and roughly
doubles the number of right digits: with X near the eigenvectors of V,
R = I - X'X, S = X'VX and e = diag(S) / (1 - diag(R)), X becomes X + XE, where
E = (S + e R) / (e_j - e_i) off the diagonal for eigenvalues that differ
clearly, and R / 2 elsewhere.

Eigenvalues too near to each other for that form clusters.  For a cluster the
basis X_J is right as a subspace only; the small problem X_J'(V - m I)X_J is
solved, shifted by the cluster's middle m so that its differences keep their
digits, X_J is turned by the solution, and the iteration goes on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Entries whose x has this magnitude or more can't be told from null ones.
_LIMIT = 1 << 53
#: Extended where the machine has it, else double.
_HIGH = np.longdouble


# ------------------------------------------------------------- eigenvectors

def _clusters(values: np.ndarray, gap) -> list[np.ndarray]:
    """Positions of the ascending ``values``, cut where neighbours differ by more than ``gap``."""
    cuts = np.flatnonzero(np.diff(values) > gap) + 1
    return np.split(np.arange(len(values)), cuts)


def _refined(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, object]:
    """One step: eigenvalues, corrected vectors, distance below which eigenvalues count as one cluster."""
    r = np.eye(len(v), dtype=_HIGH) - x.T @ x
    s = x.T @ (v @ x)
    s = (s + s.T) / 2  # differences of its halves would be divided by small gaps
    e = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    near = 2 * (np.sqrt((off**2).sum()) + np.abs(e).max() * np.sqrt((r**2).sum()))
    apart = e[None, :] - e[:, None]
    far = np.abs(apart) > near
    step = np.where(far, (s + e[None, :] * r) / np.where(far, apart, 1), r / 2)
    return e, x + x @ step, near


def eigenvectors(v: np.ndarray, most: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric
    matrix, to double precision: float32 vectors, refined."""
    v = np.asarray(v, dtype=_HIGH)
    size = np.abs(v).max() if v.size else 0
    if not size:
        return np.zeros(len(v)), np.eye(len(v))
    v = v / size
    _, start = np.linalg.eigh(v.astype(np.float32))
    x, last = start.astype(_HIGH), None
    for _ in range(most):
        e, x, near = _refined(v, x)
        order = np.argsort(e, kind="stable")
        e, x = e[order], x[:, order]
        for j in _clusters(e, near):
            if len(j) > 1:  # sub-solve: the cluster's own directions
                basis = x[:, j]
                middle = e[j].mean()
                small = basis.T @ (v @ basis - middle * basis)
                small = (small + small.T) / 2
                unit = np.abs(small).max()
                if unit > np.finfo(_HIGH).eps * 4:
                    x[:, j] = basis @ np.linalg.eigh((small / unit).astype(np.float64))[1].astype(_HIGH)
        wrong = _residual(v, x)
        if last is not None and wrong >= last / 2:
            break
        last = wrong
    e, x, _ = _refined(v, x)
    order = np.argsort(-e, kind="stable")
    x = x / np.sqrt((x * x).sum(axis=0))
    return (e[order] * size).astype(np.float64), x[:, order].astype(np.float64)


def _residual(v: np.ndarray, x: np.ndarray) -> float:
    s = x.T @ (v @ x)
    r = np.eye(len(v), dtype=_HIGH) - x.T @ x
    return float(max(np.abs(s - np.diag(np.diag(s))).max(), np.abs(r).max()))


# ------------------------------------------------------------- exact sums

def _whole(batch: pa.RecordBatch, column: int, dim: int) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, dim) + SHIFT


def _totals(dim: int):
    """embedding -> pos, total: one row for each dimension and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _whole(batch, 0, dim)
                wide = int(np.abs(x).max()) * len(x) >= 1 << 62
                sums = [str(s) for s in (x.astype(object) if wide else x).sum(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(sums)], names=["pos", "total"])

    return run


def _cross(rows: np.ndarray) -> list[np.ndarray]:
    """Exact products rows' rows, as matrices of whole numbers to be added up."""
    top = max(1, int(np.abs(rows).max(initial=0)))
    if top * top >= 1 << 53:
        exact = rows.astype(object)
        return [exact.T @ exact]
    most = max(1, ((1 << 53) - 1) // (top * top))  # so many rows' products are exact in a double
    return [(part.T @ part).astype(np.int64) for part in (rows[i : i + most].astype(np.float64) for i in range(0, len(rows), most))]


def _products(dim: int, centre: list[int]):
    """embedding -> pos (i * dim + j, i <= j), total of (x_i - c_i)(x_j - c_j): once a task."""
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                for part in _cross(_whole(batch, 0, dim) - np.array(centre, dtype=np.int64)):
                    part = part[upper].astype(object)
                    total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array((upper[0] * dim + upper[1]).astype(np.int32)), pa.array([str(t) for t in total])], names=["pos", "total"])

    return run


def _added(parts: DataFrame) -> dict[int, int]:
    """Totals by position; their number depends on the dimension alone."""
    rows = parts.groupBy("pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return {r["pos"]: int(r["total"]) for r in rows}


@dataclass
class Whitening:
    """Of ``n`` x-vectors with sums ``sums``: eigenvalues, vectors (columns),
    trace of the covariance.  ``weights`` are the vectors over the roots of
    their eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def weights(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def covariance(n: int, sums: list[int], centre: list[int], products: dict[int, int]) -> tuple[np.ndarray, float]:
    """The covariance from exact totals about a whole-numbered centre, rounded
    once, and its trace."""
    dim = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre)]
    v = np.empty((dim, dim), dtype=_HIGH)
    trace = 0
    for i in range(dim):
        for j in range(i, dim):
            exact = n * products[i * dim + j] - rest[i] * rest[j]
            if i == j:
                trace += exact
            high, low = divmod(exact, n * n)
            v[i, j] = v[j, i] = _HIGH(high) + _HIGH(float(Fraction(low, n * n)))
    return v, float(Fraction(trace, n * n))


def usable(embeddings: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """The rows that take part, and their dimension.

    Null vectors and those with null or non-finite entries don't; nor do those
    of another length than most (ties: the longer one), as they lack entries,
    nor those with an entry of 2 ** 46 or more, whose x isn't exact.
    """
    c = F.col(vector)
    fine = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float(_LIMIT // SCALE // 2)))
    rows = embeddings.where(c.isNotNull() & F.forall(c, fine) & (F.size(c) > 0))
    most = rows.groupBy(F.size(c).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = most["dim"] if most else 0
    return rows.where(F.size(c) == dim), dim


def fit(rows: DataFrame, dim: int, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Whitening of ``usable`` rows; none without rows.  Components without
    variance (to double precision) have no direction and are left out."""
    only = rows.select(vector)
    n = rows.count() if dim else 0
    if not n:
        return None
    sums = _added(only.mapInArrow(_totals(dim), "pos int, total string"))
    sums = [sums[i] for i in range(dim)]
    centre = [s // n for s in sums]
    v, trace = covariance(n, sums, centre, _added(only.mapInArrow(_products(dim, centre), "pos int, total string")))
    values, vectors = eigenvectors(v)
    some = min(components, int((values > max(values[0], 0) * dim * 2.0**-52).sum()))
    return Whitening(n, sums, values[:some], vectors[:, :some], trace) if some else None


def _project(w: Whitening, dim: int):
    """x - S/n on the components: the whole part of the mean is taken off exactly."""
    centre = np.array([s // w.n for s in w.sums], dtype=np.int64)
    rest = np.array([float(Fraction(s % w.n, w.n)) for s in w.sums])
    weights = w.weights

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - centre).astype(np.float64) - rest) @ weights

    return project


def _moments(w: Whitening, dim: int):
    """embedding -> a task's sums of the whitened values and of their products."""
    project, k = _project(w, dim), len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if len(batch):
                z = project(_whole(batch, 0, dim))
                total += np.vstack([z.T @ z, z.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["pos", "total"])

    return run


def identity_error(rows: DataFrame, dim: int, w: Whitening, vector: str = "embedding") -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured."""
    k = len(w.values)
    parts = rows.select(vector).mapInArrow(_moments(w, dim), "pos int, total double").groupBy("pos").agg(F.sum("total").alias("total")).collect()
    total = np.zeros((k + 1) * k)
    for r in parts:
        total[r["pos"]] = r["total"]
    total = total.reshape(k + 1, k) / w.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def _whitened(w: Whitening, dim: int):
    """id, embedding -> id, deviation, whitened (array): one row for each row."""
    project = _project(w, dim)
    sums, n = np.array(w.sums, dtype=object), w.n

    def deviations(x: np.ndarray) -> list[int | None]:
        small = np.array([s // n for s in w.sums], dtype=np.int64)
        rest = np.array([s % n for s in w.sums], dtype=object)
        y = x - small
        if n * (int(np.abs(y).max()) + 1) < 1 << 28 and dim <= 64:
            part = n * y - rest.astype(np.int64)
            return (part * part).sum(axis=1).tolist()
        exact = n * x.astype(object) - sums
        return [int(d) if d < 1 << 63 else None for d in (exact * exact).sum(axis=1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _whole(batch, 1, dim)
                z = project(x)
                lists = pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], z.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviations(x), pa.int64()), lists], names=["vec_id", "deviation", "whitened"])

    return run


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None, float | None]:
    """vec_id, deviation, whitened (array by component) of every usable row,
    the fit, and its ``identity_error``.

    Rows that repeat an id are all fitted and returned; null ids stay.  Other
    columns are ignored.  Without usable rows or without any variance there
    are no components and no rows.  ``deviation`` is null where it exceeds a
    long.  The driver holds matrices of the dimension squared, never rows, and
    tasks get one such matrix.
    """
    rows, dim = usable(embeddings, vector)
    w = fit(rows, dim, vector, components)
    if w is None:
        return embeddings.sparkSession.createDataFrame([], "vec_id long, deviation long, whitened array<double>"), None, None
    narrow = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector)
    return narrow.mapInArrow(_whitened(w, dim), "vec_id long, deviation long, whitened array<double>"), w, identity_error(rows, dim, w, vector)


def query(spark, sf_dir):
    rows, w, error = whiten(table(spark, sf_dir, "embeddings"))
    explained = F.lit([float(e) / w.trace for e in w.values] if w else []).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(w.n if w else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, "i").alias("explained"), F.lit(error).cast("double").alias("identity_error"))
