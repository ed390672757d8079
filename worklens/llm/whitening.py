"""Embedding whitening: spectral divide and conquer by QDWH polar decompositions, then a projection.

Spark counts each distinct vector of whole numbers once and sums it up: first the exact sums of all
dimensions, then the products of the centred vectors, one row a dimension and task. What reaches the
driver is one matrix of dimensions times dimensions. There the covariance is split: the polar factor
of the covariance minus a shift (QDWH: dynamically weighted Halley steps) gives the projectors onto
the subspaces above and below the shift; each half is compressed and split again until blocks are
single components. The components are broadcast and every row is projected where it lies.

Defined results: a vector that is NULL, holds NULL or non-finite entries or none, has not the most
common length (ties: the longest), or an entry too large for its whole number to be a long takes no
part; repeated rows are returned as often as they come but fitted once; a NULL vec_id stays NULL. A
component without variance (all vectors equal in it) has a NULL ``whitened``; ``explained`` is then 0,
or NULL if nothing varies. A ``deviation`` beyond a long is NULL. No rows give no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from worklens.llm.common import columns, saved

#: fixed values: an entry c counts as floor(SCALE * c) + SHIFT
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Entries from here on have no long for their whole number (and are left out).
LARGEST = float(1 << 56)
#: Rows of vectors handled at once in a task.
BLOCK = 4096
_EPS = float(np.finfo(np.float64).eps)


# -- polar decomposition and spectral divide and conquer ---------------------------------------


def polar(a: np.ndarray, steps: int = 12) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH steps.

    Each step's weights follow from a lower bound of the singular values. While the bound is small a
    step goes by the QR of the stacked matrix, later by Cholesky, both backward stable.
    """
    n = len(a)
    size = float(np.abs(a).sum(axis=1).max())  # bounds the largest singular value
    if size == 0:
        return np.eye(n)
    x, low = a / size, _EPS
    for _ in range(steps):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack((np.sqrt(wc) * x, np.eye(n))))
            x = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            lower = np.linalg.cholesky(np.eye(n) + wc * (x.T @ x))
            half = np.linalg.solve(lower, x.T)
            x = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(lower.T, half).T
        x = (x + x.T) / 2
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        if abs(1 - low) < 10 * _EPS and np.abs(x - before).max() < np.cbrt(_EPS) ** 2:
            break
        if low >= 1:
            low = 1.0
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, int] | None:
    """(orthonormal basis, size of the subspace above the shift), or None if the shift parts nothing
    or lies too near an eigenvalue for a clean projector."""
    n = len(a)
    above = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(float(np.trace(above))))
    if not 0 < rank < n:
        return None
    # a basis of the projector's range: its columns of largest norm, then once more to clean up
    start = above[:, np.argsort(-np.diag(above), kind="stable")]
    basis = np.linalg.qr(start)[0]
    upper = above @ basis[:, :rank]
    rest = basis[:, rank:] - above @ basis[:, rank:]
    basis = np.linalg.qr(np.hstack((upper, rest)))[0]
    off = basis[:, rank:].T @ a @ basis[:, :rank]
    if np.abs(off).max() > 64 * n * _EPS * np.abs(a).max():
        return None
    return basis, rank


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix."""
    n = len(a)
    values, vectors = np.zeros(n), np.zeros((n, n))
    scale = float(np.abs(a).max()) if n else 0.0
    todo, done = [(np.eye(n), (a + a.T) / 2)], 0
    while todo:
        basis, block = todo.pop()
        k = len(block)
        if k == 0:
            continue
        middle = float(np.trace(block)) / k
        apart = np.abs(block - middle * np.eye(k)).max()
        if k == 1 or apart <= 4 * k * _EPS * scale:  # one value: any basis of the block will do
            values[done:done + k], vectors[:, done:done + k] = middle, basis
            done += k
            continue
        found = None
        # the median of the diagonal halves best; others follow where it is too near an eigenvalue
        spread = max(float(np.ptp(np.diag(block))), apart)
        shifts = [float(np.median(np.diag(block))), middle]
        shifts += [middle + spread * s for i in range(1, 17) for s in (i / 37, -i / 37)]
        for shift in shifts:
            found = _split(block, shift)
            if found:
                break
        if found is None:
            raise ArithmeticError(f"no shift parts a block of {k} components")
        own, rank = found
        for part in (own[:, :rank], own[:, rank:]):
            inner = part.T @ block @ part
            todo.append((basis @ part, (inner + inner.T) / 2))
    # blocks are compressed several times: one pass over the whole matrix takes rounding out again
    vectors = _polished(a, vectors)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _polished(a: np.ndarray, x: np.ndarray, rounds: int = 2) -> np.ndarray:
    """Refines near eigenvectors of a symmetric matrix; quadratic where values are apart."""
    for _ in range(rounds):
        left = np.eye(len(x)) - x.T @ x
        turned = x.T @ a @ x
        value = np.diag(turned) / (1 - np.diag(left))
        gap = value[None, :] - value[:, None]
        near = np.abs(gap) <= 64 * len(x) * _EPS * np.abs(a).max() + 2 * (
            np.abs(turned - np.diag(np.diag(turned))).max() + np.abs(a).max() * np.abs(left).max())
        gap[near] = 1.0
        x = x + x @ np.where(near, left / 2, (turned + value[None, :] * left) / gap)
        x = x @ (3 * np.eye(len(x)) - x.T @ x) / 2  # unit and orthogonal to the last digit
    return x


# -- over the rows -----------------------------------------------------------------------------


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part, x as array of long."""
    rows = columns(vectors, vec_id="long", embedding="array<double>")
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = rows.where(fine & (F.size("embedding") > 0))
    lengths = rows.groupBy(F.size("embedding").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("embedding") == F.lit(common["length"] if common else 0)).select(
        "vec_id",
        F.transform("embedding", lambda c: F.floor(c * SCALE).cast("long") + F.lit(SHIFT)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def _fits(x: np.ndarray, factor: int) -> bool:
    """Whether sums of ``factor`` such entries stay within a long."""
    most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    return most * factor < 1 << 62


def scatter(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - total, exactly: longs where they suffice, else Python's own numbers."""
    if _fits(x, n) and max(map(abs, total)) < 1 << 62:
        return n * x - np.array(total, dtype=np.int64)
    return n * x.astype(object) - np.array(total, dtype=object)


def squares(off: np.ndarray) -> list[int | None]:
    """Sum of squares of each row; None beyond a long."""
    most = int(np.abs(off).max()) if off.size else 0
    if off.dtype != object and most * most * off.shape[1] < 1 << 63:
        return (off * off).sum(axis=1).tolist()
    sums = (off.astype(object) ** 2).sum(axis=1).tolist()
    return [s if s < 1 << 63 else None for s in sums]


def _summed(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], each: int) -> np.ndarray:
    """Sum over all vectors of ``of`` their block (``each`` rows of ``width``); ``rows`` is saved.

    Each task sends one matrix; groups of about the root of the number of tasks add them up, so
    neither a group nor the driver holds more than that many.
    """
    groups = max(1, int(np.sqrt(rows.rdd.getNumPartitions())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((each, width)), False
        for batch in batches:
            x = _matrix(batch.column("x")) if batch.num_rows else np.zeros((0, width), np.int64)
            for i in range(0, len(x), BLOCK):
                total, seen = total + of(x[i:i + BLOCK]), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], names=["sums"])

    def add(table: pa.Table) -> pa.Table:
        sums = np.array(table.column("sums").to_pylist()).sum(axis=0)
        return pa.table({"sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "sums array<double>").withColumn(
        "part", F.pmod(F.spark_partition_id(), F.lit(groups)))
    found = parts.groupBy("part").applyInArrow(add, "sums array<double>").collect()
    return sum((np.array(r["sums"]) for r in found), np.zeros(each * width)).reshape(each, width)


class Whitener(NamedTuple):
    """What tasks need: bounded by the number of dimensions."""

    n: int
    total: list[int]
    weights: np.ndarray  # dimensions x components; the root of the eigenvalue divided out
    value: np.ndarray  # eigenvalues of the components
    varies: np.ndarray
    trace: float
    error: float


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Over the distinct vectors of ``rows.x``; None without rows."""
    distinct = saved(rows.select("x").distinct())
    n = distinct.count()
    if not n:
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                own = x if _fits(x, len(x)) else x.astype(object)
                total = [int(s) + t for s, t in zip(own.sum(axis=0), total or [0] * x.shape[1])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array([str(t) for t in total], pa.string())],
            names=["i", "s"])

    sums = distinct.mapInArrow(add, "i int, s string").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")).collect()
    total = [int(r["s"]) for r in sorted(sums)]
    width = len(total)

    def centred(x: np.ndarray) -> np.ndarray:
        return scatter(x, n, total).astype(np.float64) / n

    covariance = _summed(distinct, width, lambda x: centred(x).T @ centred(x), width) / n
    value, vectors = eigen(covariance)
    trace = float(np.trace(covariance))
    value, vectors = value[:components], vectors[:, :components]
    varies = value > width * _EPS * trace
    weights = np.where(varies, vectors / np.sqrt(np.where(varies, value, 1.0)), 0.0)

    def white(x: np.ndarray) -> np.ndarray:
        return centred(x) @ weights

    k = weights.shape[1]
    mean = _summed(distinct, k, lambda x: white(x).sum(axis=0, keepdims=True), 1)[0] / n
    spread = _summed(distinct, k, lambda x: (white(x) - mean).T @ (white(x) - mean), k) / n
    off = np.abs(spread - np.eye(k))[np.ix_(varies, varies)]
    return Whitener(n, total, weights, value, varies, trace, float(off.max()) if off.size else 0.0)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each vector
    and component; the projection is a pass over the table without a shuffle."""
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    spark = vectors.sparkSession
    rows = whole(vectors)
    own = fit(rows, components)
    if own is None:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast(tuple(own))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Whitener(*held.value)
        k = len(own.value)
        share = (np.maximum(own.value, 0.0) / own.trace).tolist() if own.trace > 0 else [None] * k
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                some = batch.slice(i, BLOCK)
                off = scatter(_matrix(some.column("x")), own.n, own.total)
                white = off.astype(np.float64) / own.n @ own.weights
                m = len(off)
                lacking = np.tile(~own.varies, m)
                yield pa.RecordBatch.from_arrays(
                    [some.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, own.n)),
                     pa.array(squares(off), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(white.ravel(), mask=lacking), pa.array(share * m, pa.float64()),
                     pa.array(np.full(m * k, own.error))],
                    names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(project, schema)
