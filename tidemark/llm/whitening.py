"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

1. One pass counts the usable vectors and sums their dimensions (whole numbers, exact).
2. A second pass subtracts the mean and adds up the products of the centred dimensions, per task and then per row of the matrix. What
   is summed has the size of the matrix, whatever the number of vectors.
3. On that one matrix (the number of dimensions squared) the factor is found with pivoting, largest remaining diagonal first, and
   pairs of its columns are rotated until all are orthogonal. Their squared lengths are the eigenvalues of the scatter,
   and the columns, at length one, its eigenvectors: the scatter itself is never diagonalised, so small eigenvalues keep their digits.
4. A third pass takes the covariance of the whitened vectors, to tell how far it is from the identity; a fourth gives the rows.

Vectors that are null, empty, or hold null or non-finite entries are left out. All vectors must have the same length; where they
don't, the length that most have (of several, the largest) counts and other rows are left out. Entries are fixed-point: ``floor(1024 * c) + 100000``,
held within plus and minus 2**52. Components whose eigenvalue is zero next to the largest (equal vectors, fewer vectors than
dimensions) can't be whitened and are not returned. Repeated rows, rows of one vec_id and rows without one each count. Of
components with equal eigenvalues any basis is right. A deviation beyond a bigint is null. Extra columns are not touched. Empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.scratch import materialize

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
_LIMIT = float(1 << 52)
#: A pivot that is smaller than this share of the largest is zero.
TINY = 1e-13
#: Columns are orthogonal when the cosine between any two is below this.
ORTHOGONAL = 1e-15
SWEEPS = 60


def usable(batch: pa.RecordBatch, dims: int | None = None) -> tuple[np.ndarray, pa.Array | np.ndarray, pa.ListArray]:
    """Which rows of ``batch(embedding)`` have whole vectors (of ``dims`` entries), their lengths, and the lists."""
    lists = batch.column("embedding")
    lengths = np.diff(_offsets(lists))
    values = lists.values
    flat = values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    good = np.isfinite(flat)
    bad = np.concatenate([[0], np.cumsum(~good)])
    begins = _offsets(lists)
    whole = (bad[begins[1:]] == bad[begins[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
    return whole if dims is None else whole & (lengths == dims), lengths, flat


def _offsets(lists: pa.ListArray) -> np.ndarray:
    return lists.offsets.to_numpy().astype(np.int64)


def fixed(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are usable, and their entries in fixed point, a row each."""
    whole, _, flat = usable(batch, dims)
    begins = _offsets(batch.column("embedding"))[:-1][whole]
    entries = flat[begins[:, None] + np.arange(dims)]
    return whole, (np.clip(np.floor(SCALE * entries), -_LIMIT, _LIMIT) + SHIFT).astype(np.int64)


def _sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        whole, lengths, _ = usable(batch)
        for dims in np.unique(lengths[whole]).tolist():
            _, x = fixed(batch, dims)
            n, high, low = held.get(dims, (0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)))
            held[dims] = (n + len(x), high + (x >> 26).sum(axis=0), low + (x & ((1 << 26) - 1)).sum(axis=0))
    for dims, (n, high, low) in held.items():
        yield pa.RecordBatch.from_pydict({
            "dims": pa.array([dims] * dims, pa.int32()), "at": pa.array(range(dims), pa.int32()), "n": pa.array([n] * dims, pa.int64()),
            "high": pa.array(high), "low": pa.array(low),
        })


def _products_of(of, width: int):
    """Per task, the sums of ``z`` and of the products of its columns, ``z`` being what ``of`` makes of a batch."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums, task = np.zeros((width, width)), np.zeros(width), TaskContext.get().partitionId()
        for batch in batches:
            z = of(batch)
            total += z.T @ z
            sums += z.sum(axis=0)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, task, np.int32)), pa.array(sums), pa.array(list(total), pa.list_(pa.float64())),
        ], names=["at", "task", "sum", "products"])

    return job


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one place added up, in order of their tasks; partitions are sorted by (at, task)."""
    at, total, sums = None, None, 0.0
    for batch in batches:
        for row, one, products in zip(batch.column("at").to_pylist(), batch.column("sum").to_pylist(), batch.column("products"), strict=True):
            own = products.values.to_numpy()
            if row == at:
                total, sums = total + own, sums + one
                continue
            if at is not None:
                yield _line(at, sums, total)
            at, total, sums = row, own, one
    if at is not None:
        yield _line(at, sums, total)


def _line(at: int, sums: float, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([sums]), pa.array([total], pa.list_(pa.float64()))], names=["at", "sum", "products"])


def products(rows: DataFrame, of, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sums of products over all ``rows``, ``width`` and ``width`` squared numbers."""
    shape = "at int, sum double, products array<double>"
    parts = rows.mapInArrow(_products_of(of, width), shape.replace("sum", "task int, sum"))
    summed = parts.repartition("at").sortWithinPartitions("at", "task").mapInArrow(_added, shape)
    sums, total = np.zeros(width), np.zeros((width, width))
    for row in summed.collect():
        sums[row["at"]], total[row["at"]] = row["sum"], row["products"]
    return sums, total


def pivoted_cholesky(scatter: np.ndarray, tiny: float = TINY) -> np.ndarray:
    """``L`` with as many columns as the rank, ``L @ L.T`` being the matrix; triangular in the order of the pivots."""
    rest, columns = scatter.astype(float).copy(), []
    largest = np.max(np.diag(rest), initial=0.0)
    for _ in range(len(rest)):
        at = int(np.argmax(np.diag(rest)))
        pivot = rest[at, at]
        if not pivot > tiny * largest:
            break
        column = rest[:, at] / np.sqrt(pivot)
        columns.append(column)
        rest -= np.outer(column, column)
        # What was eliminated is zero, not what rounding leaves.
        rest[at, :] = rest[:, at] = 0.0
        rest[at, at] = -1.0
    done = np.array(columns).T.reshape(len(scatter), -1)
    return done


def rounds_of(n: int) -> list[np.ndarray]:
    """All pairs of ``n`` things in rounds of disjoint pairs (a round-robin tournament)."""
    ring = list(range(n + n % 2))
    out = []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[:half], reversed(ring[half:]), strict=True)]
        out.append(np.array([p for p in pairs if p[1] < n], np.int64).reshape(-1, 2))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, near: float = ORTHOGONAL, sweeps: int = SWEEPS) -> np.ndarray:
    """The factor's columns rotated in pairs until all are orthogonal; the pairs of a round are rotated together."""
    columns = factor.T.copy()
    order = rounds_of(len(columns))
    for _ in range(sweeps):
        worst = 0.0
        for pairs in order:
            if not len(pairs):
                continue
            a, b = columns[pairs[:, 0]], columns[pairs[:, 1]]
            alpha, beta, gamma = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
            cosine = np.abs(gamma) / np.sqrt(alpha * beta)
            worst = max(worst, float(cosine.max()))
            turn = cosine > near
            zeta = (beta - alpha) / (2 * np.where(turn, gamma, 1.0))
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            columns[pairs[:, 0]], columns[pairs[:, 1]] = c[:, None] * a - s[:, None] * b, s[:, None] * a + c[:, None] * b
        if worst <= near * 16:
            break
    return columns.T


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above zero in falling order, and their unit vectors as columns; the largest entry of each is positive."""
    rotated = one_sided_jacobi(pivoted_cholesky(scatter))
    lengths = np.sqrt((rotated * rotated).sum(0))
    order = np.argsort(-lengths, kind="stable")
    vectors = rotated[:, order] / lengths[order]
    if vectors.size:
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return lengths[order] ** 2, vectors


@dataclass(frozen=True)
class Model:
    """What whitens vectors: their number, exact sums, and per component the eigenvalue of the covariance and its vector."""

    dims: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        # Whole part and rest apart, so that large sums lose nothing.
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole) - rest

    def whitened(self, x: np.ndarray, components: int) -> np.ndarray:
        return self.centred(x) @ (self.vectors[:, :components] / np.sqrt(self.values[:components]))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums over the dimensions of ``(n * x - S) ** 2``."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], object)
        apart = x - whole
        most = float(np.abs(apart).max(initial=0) + 1) * self.n
        if most * most * self.dims < 2.0**62:
            y = self.n * apart - rest.astype(np.int64)
            return (y * y).sum(axis=1).tolist()
        y = self.n * apart.astype(object) - rest
        out = (y * y).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in out]


def fit(rows: DataFrame) -> Model | None:
    """The model of all usable vectors of ``rows(embedding)``; None if there are none."""
    shape = "dims int, at int, n long, high long, low long"
    # Two halves of a sum, so that neither passes a bigint within a task.
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found = materialize(rows.mapInArrow(_sums_of, shape).groupBy("dims", "at").agg(F.sum("n").alias("n"), *sums), "sums")
    most = found.filter("at = 0").orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    if not most:
        return None
    dims, n = most[0]["dims"], most[0]["n"]
    lines = sorted(found.filter(F.col("dims") == dims).collect(), key=lambda r: r["at"])
    exact = tuple((int(r["high"]) << 26) + int(r["low"]) for r in lines)
    bare = Model(dims, n, exact, np.empty(0), np.empty((dims, 0)), 0.0)
    shift, scatter = products(rows, lambda batch: bare.centred(fixed(batch, dims)[1]), dims)
    # Centred values sum to nearly zero; what rounding of the mean leaves is taken out.
    scatter = scatter - np.outer(shift, shift) / n
    values, vectors = eigen((scatter + scatter.T) / 2)
    return Model(dims, n, exact, values / n, vectors, float(np.trace(scatter)) / n)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``vectors(vec_id, embedding)`` and component, with the quality of the whole fit."""
    rows = vectors.select("vec_id", "embedding")
    shape = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows.select("embedding"))
    k = 0 if model is None else min(components, len(model.values))
    if not k:
        return vectors.sparkSession.createDataFrame([], shape)
    sums, scatter = products(rows.select("embedding"), lambda batch: model.whitened(fixed(batch, model.dims)[1], k), k)
    error = float(np.abs((scatter - np.outer(sums, sums) / model.n) / model.n - np.eye(k)).max())
    explained = model.values[:k] / model.trace

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, x = fixed(batch, model.dims)
            if not len(x):
                continue
            ids = batch.column("vec_id").filter(pa.array(whole))
            size = len(x)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(np.repeat(np.arange(size), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                pa.array(np.full(size * k, model.n, np.int64)), pa.array(np.repeat(np.array(model.deviations(x), object), k).tolist(), pa.int64()),
                pa.array(model.whitened(x, k).ravel()), pa.array(np.tile(explained, size)), pa.array(np.full(size * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(job, shape)
