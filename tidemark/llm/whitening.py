"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Entries become integers x = floor(1024 c) + 100000, so counts, sums and deviations are exact
and do not depend on how rows are dealt. Two passes make sums and the centred scatter as
partial sums of each task, added by dimension; the driver gets one row a dimension. There the
scatter is factored with pivoting into a triangular L, and columns of L are rotated against
each other until all are orthogonal. Their squared norms are the eigenvalues of the scatter,
the columns at length one its eigenvectors. A third pass projects the rows.

Rows are centred at the integer nearest to the mean before they are multiplied; the scatter
about the mean itself follows by taking off n times the remainders' products (each below 1/4).

Defined cases: rows whose vector is null or holds a null or an entry that is not finite are left
out; a vector that is shorter than the longest is read as ending in zeros; entries beyond
2**40 in size count as 2**40; components whose eigenvalue is zero to double precision (equal rows,
dependent dimensions) are not returned, as nothing can be divided by their deviation; a deviation
beyond 64 bits is null; repeated rows and rows without an id are rows of their own; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
COMPONENTS = 8
#: Rows that are multiplied at once.
ROWS = 4096
#: Columns with a smaller cosine are not rotated.
COSINE = 1e-15
MOST_SWEEPS = 60


# ---- vectors -------------------------------------------------------------------------


def usable(vectors: pa.Array) -> np.ndarray:
    """Rows whose vector is not null and has finite entries only."""
    flat = pc.list_flatten(vectors)
    bad = pc.invert(pc.fill_null(pc.is_finite(flat.cast(pa.float64())), False))
    rows = pc.list_parent_indices(vectors).filter(bad)
    good = vectors.is_valid().to_numpy(zero_copy_only=False)
    good[rows.to_numpy()] = False
    return good


def entries(vectors: pa.Array, width: int) -> np.ndarray:
    """Integers of some usable vectors, as rows of ``width``."""
    out = np.zeros((len(vectors), width), np.float64)
    if len(vectors):
        at = pc.list_parent_indices(vectors).to_numpy()
        ends = np.cumsum(pc.list_value_length(vectors).to_numpy())
        place = np.arange(len(at)) - np.concatenate([[0], ends])[at]
        out[at, place] = pc.list_flatten(vectors).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(SCALE * np.clip(out, -LARGEST, LARGEST)).astype(np.int64) + SHIFT


def _matrices(batches, width: int):
    """``vec_id`` and integers of the usable rows, some rows at a time."""
    for batch in batches:
        good = batch.filter(pa.array(usable(batch.column("embedding"))))
        for at in range(0, len(good), ROWS):
            part = good.slice(at, ROWS)
            yield part.column("vec_id"), entries(part.column("embedding"), width)


# ---- sums ----------------------------------------------------------------------------

SUMS = "dim int, n bigint, s bigint"


def _summer(width: int):
    def run(batches):
        n, s = 0, np.zeros(width, np.int64)
        for _, x in _matrices(batches, width):
            n, s = n + len(x), s + x.sum(axis=0)
        if n:
            counts = pa.array(np.full(width, n), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), counts, pa.array(s)], names=["dim", "n", "s"])

    return run


def _scatterer(centre: np.ndarray):
    width = len(centre)

    def run(batches):
        total = np.zeros((width, width))
        rows = 0
        for _, x in _matrices(batches, width):
            y = (x - centre).astype(np.float64)
            total += y.T @ y
            rows += len(x)
        if rows:
            i, j = np.indices(total.shape).reshape(2, -1)
            cells = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.reshape(-1))]
            for at in range(0, len(i), ROWS):
                yield pa.RecordBatch.from_arrays([c.slice(at, ROWS) for c in cells], names=["i", "j", "v"])

    return run


def sums(rows: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Number of usable rows and the exact sum of each dimension."""
    parts = rows.mapInArrow(_summer(width), SUMS).groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    found = sorted(parts.collect())  # one row a dimension
    return (found[0].n, np.array([r.s for r in found], np.int64)) if found else (0, np.zeros(width, np.int64))


def scatter(rows: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """Sum of (x - mean)(x - mean)' over all usable rows."""
    centre = (2 * total + n) // (2 * n)
    cells = rows.mapInArrow(_scatterer(centre), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    lines = cells.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).getField("v").alias("v"))
    out = np.array([r.v for r in lines.orderBy("i").collect()])  # one row a dimension
    rest = (total - n * centre) / n
    out -= n * np.outer(rest, rest)
    return (out + out.T) / 2


# ---- components ----------------------------------------------------------------------


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with ``a`` = L L': a row permutation of a lower triangle, one column for each pivot above rounding."""
    a = a.copy()
    n = len(a)
    columns = []
    least = np.finfo(float).eps * n * max(a.diagonal().max(initial=0), 0)
    open_ = np.ones(n, bool)
    while open_.any():
        k = int(np.argmax(np.where(open_, a.diagonal(), -np.inf)))
        if not a[k, k] > least:
            break
        column = np.where(open_, a[:, k], 0) / np.sqrt(a[k, k])
        a -= np.outer(column, column)
        open_[k] = False
        columns.append(column)
    return np.array(columns).T if columns else np.zeros((n, 0))


def _rounds(n: int):
    """All pairs of n columns as rounds of disjoint pairs (one column stays, the others turn)."""
    ring = list(range(n + n % 2))
    half = len(ring) // 2
    for _ in range(len(ring) - 1):
        pairs = [(ring[k], ring[-1 - k]) for k in range(half)]
        yield np.array([(min(p), max(p)) for p in pairs if max(p) < n])
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms, falling, and directions of the columns of ``factor`` once rotated to be orthogonal."""
    g = factor.copy()
    rounds = [r for r in _rounds(g.shape[1]) if len(r)] if g.shape[1] > 1 else []
    for _ in range(MOST_SWEEPS):
        worst = 0.0
        for pairs in rounds:
            p, q = g[:, pairs[:, 0]], g[:, pairs[:, 1]]
            a, b, c = (p * p).sum(0), (q * q).sum(0), (p * q).sum(0)
            size = np.sqrt(a * b)
            turn = np.abs(c) > COSINE * size
            worst = max(worst, float((np.abs(c) / np.where(size > 0, size, 1)).max(initial=0)))
            zeta = (b - a) / np.where(turn, 2 * c, 1)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            cos = np.where(turn, 1 / np.hypot(1, t), 1.0)
            sin = np.where(turn, cos * t, 0.0)
            g[:, pairs[:, 0]], g[:, pairs[:, 1]] = cos * p - sin * q, sin * p + cos * q
        if worst <= 4 * np.finfo(float).eps * np.sqrt(len(g)):
            break
    values = (g * g).sum(0)
    order = np.argsort(-values, kind="stable")
    values, g = values[order], g[:, order]
    full = values > 0
    return values[full], g[:, full] / np.sqrt(values[full])


# ---- rows ----------------------------------------------------------------------------

ROW = "vec_id bigint, deviation bigint, w array<double>"


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> pa.Array:
    """Exact sums of (n x - S)**2; null beyond 64 bits."""
    most = int(np.abs(x).max(initial=0)) * n + int(np.abs(total).max(initial=0))
    if most * most * max(len(total), 1) < 1 << 63:
        z = n * x - total
        return pa.array((z * z).sum(axis=1), pa.int64())
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, total, strict=True)) for row in x]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def _projector(n: int, total: np.ndarray, axes: np.ndarray):
    """``axes``: a column for each component, divided by its standard deviation."""
    centre = (2 * total + n) // (2 * n)
    rest = (total - n * centre) / n

    def run(batches):
        for ids, x in _matrices(batches, len(total)):
            w = ((x - centre) - rest) @ axes
            width = axes.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(w.reshape(-1)))
            yield pa.RecordBatch.from_arrays([ids, deviations(x, n, total), lists], names=["vec_id", "deviation", "w"])

    return run


def identity_error(rows: DataFrame, width: int) -> float:
    """Largest absolute entry of the covariance of ``w`` less the identity."""
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    w = F.col("w")
    covers = rows.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(covers[k] - (i == j)) for k, (i, j) in enumerate(pairs))


RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row for each usable row of ``vectors`` (vec_id, embedding) and each of the first ``most`` components."""
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
    width = rows.agg(F.max(F.size("embedding")).alias("w")).first().w or 0
    n, total = sums(rows, width) if width > 0 else (0, np.zeros(0, np.int64))
    spread = scatter(rows, n, total) if n else np.zeros((0, 0))
    values, axes = one_sided_jacobi(pivoted_cholesky(spread)) if n else (np.zeros(0), np.zeros((0, 0)))
    values, axes = values[:most], axes[:, :most]
    if not len(values):
        return vectors.sparkSession.createDataFrame([], RESULT)
    projected = rows.mapInArrow(_projector(n, total, axes / np.sqrt(values / n)), ROW)
    projected = stored(projected, "whitened")
    error = identity_error(projected, len(values))
    explained = F.array(*[F.lit(float(v)) for v in values / np.trace(spread)])
    out = projected.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
    return out.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("k")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
