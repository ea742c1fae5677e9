"""Embedding whitening by FEAST contour integration.

The covariance of all vectors is summed by Spark from exact integers, centred
before multiplying; it has the size of the vectors' width squared, whatever the
number of rows.  Its leading eigenpairs are found interval by interval:

* a tridiagonal form of the matrix gives inertia counts (how many eigenvalues
  lie below a shift, by the signs of the pivots); bisection on these counts cuts
  the upper spectrum into intervals of a few eigenvalues, with bounds in gaps;
* each interval is a Spark task: a Gauss-Legendre quadrature of complex shifted
  solves along a circle around the interval projects a block onto its eigenspace,
  Rayleigh-Ritz extracts the pairs, and the block is projected again until the
  residuals are at rounding level;
* the number of pairs found in an interval must equal its inertia count,
  otherwise ``EigenvaluesMissed`` is raised.

Two more passes over the vectors check the covariance of the whitened vectors
against the identity and write the result; nothing is shuffled but sums.

Defined cases: a null vector and one with a null, NaN or infinite entry are left
out; shorter vectors count as followed by zeros up to the longest; an entry beyond
``LARGEST / scale`` counts as that; directions whose eigenvalue is below ``RANK``
of the largest are rounding errors and give no component (so a constant table has
no rows, and a table of few vectors fewer than ``k`` components); equal eigenvalues
give any orthonormal basis; a deviation that does not fit a long is null; null and
repeated ids are rows like any other; an empty table gives no rows.  Only the id
and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.llm.vectors import VECTOR, is_finite, matrix, row_chunks, slot_sums

SCALE = 64
SHIFT = 1_000_000
LARGEST = float(1 << 40)
COMPONENTS = 32
RANK = 1e-12
NODES = 16
PER_INTERVAL = 6
MAX_PROJECTIONS = 60
CHUNK_ROWS = 4_096


class EigenvaluesMissed(RuntimeError):
    """An interval's eigenpairs are fewer or more than its inertia count."""


# -- the matrix ---------------------------------------------------------------

def integers(column: pa.ListArray, width: int) -> np.ndarray:
    """``floor(SCALE * c) + SHIFT`` of each entry."""
    return np.clip(np.floor(matrix(column, width) * SCALE), -LARGEST, LARGEST).astype(np.int64) + SHIFT


class Moments:
    """Number of vectors, their sums, and what a vector is once centred."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.pivot = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``."""
        return (x - self.pivot).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over the entries of ``(n x - S)^2``, null beyond a long."""
        about = ((self.n * self.centred(x)) ** 2).sum(1)
        fits = about < 9.0e18
        far = self.n * np.where(fits[:, None], x - self.pivot, 0) - self.rest * fits[:, None]
        return pa.array((far * far).sum(1), pa.int64(), mask=~fits)


def moments(vectors: DataFrame, width: int) -> Moments:
    def sums(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(1 + width, np.int64)
        for batch in batches:
            total[0] += batch.num_rows
            total[1:] += (integers(batch.column(VECTOR), width) - SHIFT).sum(0)
        return total

    n, *total = slot_sums(vectors, sums, 1 + width, "long").tolist()
    return Moments(n, [s + SHIFT * n for s in total])


def covariance(vectors: DataFrame, width: int, around: Moments, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the centred vectors, divisor n; with ``project`` that of
    their projections, centred again."""
    size = width if project is None else project.shape[1]

    def products(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((1 + size, size))
        for batch in batches:
            c = around.centred(integers(batch.column(VECTOR), width))
            c = c if project is None else c @ project
            total[0] += c.sum(0)
            total[1:] += c.T @ c
        return total.reshape(-1)

    total = slot_sums(vectors, products, (1 + size) * size, "double").reshape(1 + size, size) / around.n
    found = total[1:] - np.outer(total[0], total[0])
    return (found + found.T) / 2


# -- inertia counts -----------------------------------------------------------

def tridiagonal(matrix_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix (reflections)."""
    a = matrix_.copy()
    n = len(a)
    for i in range(n - 2):
        v = a[i + 1:, i].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        a[i + 1:] -= 2 * np.outer(v, v @ a[i + 1:])
        a[:, i + 1:] -= 2 * np.outer(a[:, i + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def counts_above(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift: positive pivots of the
    factorisation of the shifted matrix."""
    tiny = np.finfo(float).tiny ** 0.5 * max(1.0, np.abs(diagonal).max(initial=0))
    above, pivot = np.zeros(len(shifts), np.int64), np.ones(len(shifts))
    for d, b in zip(diagonal, np.append(0.0, beside)):
        pivot = d - shifts - b * b / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        above += pivot > 0
    return above


def intervals(cov: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """``(low, high, count)`` that cover the ``k`` largest eigenvalues (more
    where the last are equal), bounds in the widest gaps."""
    diagonal, beside = tridiagonal(cov)
    norm = np.abs(cov).sum(1).max(initial=0)
    if norm == 0:
        return []
    want = min(len(cov), k + PER_INTERVAL)
    low, high = np.full(want, -1e-3 * norm), np.full(want, norm * (1 + 1e-3))
    for _ in range(60):
        middle = (low + high) / 2
        more = counts_above(diagonal, beside, middle) > np.arange(want)
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    at = np.maximum((low + high) / 2, 0)
    at = at[at > RANK * at[0]]
    gap = at - np.append(at[1:], 0.0)
    last = min(k, len(at))
    while last < len(at) and gap[last - 1] < 1e-9 * at[0]:
        last += 1  # equal to the last one
    out, top, begin = [], norm * (1 + 1e-3), 0
    while begin < last:
        end = min(last, begin + PER_INTERVAL)
        if end < last:
            end = begin + 1 + int(np.argmax(gap[begin:end]))
            while end < last and gap[end - 1] < 1e-9 * at[0]:
                end += 1
        bottom = at[end - 1] - gap[end - 1] / 2
        above = counts_above(diagonal, beside, np.array([bottom, top]))
        out.append((float(bottom), float(top), int(above[0] - above[1])))
        top, begin = bottom, end
    return out


# -- contour integration ------------------------------------------------------

def project(cov: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """Quadrature of the resolvent along the circle over ``[low, high]``: the
    part of ``block`` in the interval's eigenspace (upper half; the lower is its
    conjugate)."""
    node, weight = np.polynomial.legendre.leggauss(NODES)
    middle, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for turn, w in zip(np.exp(1j * np.pi / 2 * (1 - node)), weight):
        solved = np.linalg.solve((middle + radius * turn) * np.eye(len(cov)) - cov, block)
        out += w / 2 * (radius * turn * solved).real
    return out


def feast(cov: np.ndarray, low: float, high: float, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors in ``[low, high]``."""
    size = min(len(cov), 2 * count + 4)
    block = np.random.default_rng(seed).standard_normal((len(cov), size))
    small, settled = 1e-14 * len(cov) * np.linalg.norm(cov, 2), False
    for _ in range(MAX_PROJECTIONS):
        basis = np.linalg.qr(project(cov, block, low, high))[0]
        values, turn = np.linalg.eigh(basis.T @ cov @ basis)
        block = basis @ turn
        residual = np.linalg.norm(cov @ block - block * values, axis=0)
        found = (values > low) & (values <= high) & (residual <= small)  # a mixture of others has a large residual
        if settled and found.sum() == count:  # once more than needed, to rounding level
            return values[found][::-1], block[:, found][:, ::-1]
        settled = found.sum() == count
    raise EigenvaluesMissed(f"{count} eigenvalues in [{low}, {high}], {found.sum()} found")


def leading(spark, cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors; an
    interval is a task."""
    asked = pd.DataFrame([(i, *x) for i, x in enumerate(intervals(cov, k))], columns=["part", "low", "high", "count"])
    if asked.empty:
        return np.zeros(0), np.zeros((len(cov), 0))

    def solve(frames: Iterable[pd.DataFrame]):
        for frame in frames:
            for part, low, high, count in frame.itertuples(index=False):
                values, vectors = feast(cov, low, high, int(count), int(part))
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    found = (spark.createDataFrame(asked, "part long, low double, high double, count long")
             .repartition(len(asked), "part").mapInPandas(solve, "value double, vector array<double>").toPandas())
    found = found.sort_values("value", ascending=False)
    if len(found) != asked["count"].sum():
        raise EigenvaluesMissed(f"{asked['count'].sum()} eigenvalues counted, {len(found)} found")
    return found["value"].to_numpy()[:k], np.array(found["vector"].tolist()).T[:, :k]


# -- the operator -------------------------------------------------------------

def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: ``id_col, component, n, deviation,
    whitened, explained, identity_error``."""
    spark = table.sparkSession
    schema = (f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    vectors = table.where(is_finite(vector_col)).select(F.col(f"`{id_col}`").cast("long").alias("id"),
                                                        F.col(f"`{vector_col}`").alias(VECTOR))
    only = vectors.select(VECTOR)
    width = only.agg(F.max(F.size(VECTOR))).first()[0] or 0
    if not width:
        return spark.createDataFrame([], schema)
    around = moments(only, width)
    cov = covariance(only, width, around)
    values, directions = leading(spark, cov, k)
    if not len(values):
        return spark.createDataFrame([], schema)
    scaled = directions / np.sqrt(values)
    error = float(np.abs(covariance(only, width, around, scaled) - np.eye(len(values))).max())
    explained = values / np.trace(cov)
    components = len(values)

    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in row_chunks(batches, CHUNK_ROWS):
            x = integers(batch.column(VECTOR), width)
            each = np.repeat(np.arange(len(x)), components)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(each)), pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), around.n)), around.deviation(x).take(pa.array(each)),
                pa.array((around.centred(x) @ scaled).reshape(-1)), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(each), error))], schema=arrow)

    arrow = pa.schema([(id_col, pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                       ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    return vectors.mapInArrow(rows, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of all ``embeddings``."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
