"""Embedding whitening by shifted CholeskyQR.

The centred rows are made orthogonal by repeated passes: a pass sums the Gram matrix of all rows over
the cluster, the driver factors that small matrix (the first one with a shift, which keeps it positive
definite), and the next pass divides its rows by the factors so far through triangular solves. The
product of the factors is the R of the centred table. The SVD of R gives the components and variances
without squaring the condition number, as an eigenvalue problem of the covariance would.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import materialize
from etlkit.runtime import require

# Entries become whole numbers floor(64 c) + 1000000, which keeps sums and deviations exact.
SCALE, OFFSET = 64, 1_000_000
# Largest scaled entry that is taken; beyond it whole numbers and doubles part.
ENTRY_LIMIT = 2.0**52
PASSES, ORTHOGONAL = 8, 1e-12
SLICE = 4_096


class Whitening(NamedTuple):
    """A fitted whitening: dimensions, rows, sums, projection (dimension by component), variances, their total, error."""

    dim: int
    n: int
    sums: tuple[int, ...]
    projection: np.ndarray
    variances: np.ndarray
    total: float
    error: float


def rows_of(column: pa.Array, dim: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors of ``dim`` entries and these as whole numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dim)
    flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dim)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(SCALE * flat)
        good = np.isfinite(flat).all(axis=1) & (np.abs(scaled) < ENTRY_LIMIT).all(axis=1)
    return at[good], scaled[good].astype(np.int64) + OFFSET


def deviations(x: np.ndarray, n: int, sums: Sequence[int]) -> np.ndarray:
    """``n x - S``, exact; as Python integers where 64 bits may not hold it."""
    largest = int(np.abs(x).max(initial=0))
    if n * largest < 2**62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array([int(s) for s in sums], dtype=object)


def squares(d: np.ndarray) -> list[int | None]:
    """Exact sums of squares of rows; null where they exceed a long."""
    largest = int(np.abs(d).max(initial=0))
    if largest * largest * max(1, d.shape[1]) < 2**63:
        return (d.astype(np.int64) ** 2).sum(axis=1).tolist()
    found = (d.astype(object) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in found]


def triangular_solve(x: np.ndarray, r: np.ndarray, block: int = 32) -> np.ndarray:
    """``x`` times the inverse of an upper triangular ``r``, by blocks of columns from the left."""
    q = np.empty_like(x)
    for a in range(0, r.shape[0], block):
        b = min(a + block, r.shape[0])
        rest = x[:, a:b] - q[:, :a] @ r[:a, a:b]
        q[:, a:b] = np.linalg.solve(r[a:b, a:b].T, rest.T).T
    return q


def _sums(vectors: DataFrame) -> tuple[int, int, tuple[int, ...]]:
    """Dimension, number and exact sums of the usable vectors of the most frequent dimension (ties: the smallest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            column = batch.column(0)
            lengths = pc.unique(pc.drop_null(pc.list_value_length(column))).to_pylist()
            for dim in filter(None, lengths):
                _, x = rows_of(column, dim)
                n, total = seen.get(dim, (0, np.zeros(dim, dtype=object)))
                seen[dim] = n + len(x), total + x.astype(object).sum(axis=0) if len(x) and np.abs(x).max() > 2**40 else total + x.sum(axis=0)
        for dim, (n, total) in seen.items():
            values = [Decimal(n), *(Decimal(int(v)) for v in total)]
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(dim, pa.int32()), dim + 1), pa.array(np.arange(-1, dim, dtype=np.int32)), pa.array(values, pa.decimal128(38, 0))], names=["dim", "i", "s"])

    parts = vectors.mapInArrow(run, "dim int, i int, s decimal(38,0)").groupBy("dim", "i").agg(F.sum("s").alias("s"))
    parts = materialize(parts, "whitening-sums")
    most = parts.filter("i = -1 AND s > 0").orderBy(F.desc("s"), "dim").first()
    if most is None:
        return 0, 0, ()
    sums = {r.i: int(r.s) for r in parts.filter(F.col("dim") == most.dim).collect()}
    return most.dim, int(most.s), tuple(sums[i] for i in range(most.dim))


def _gram(vectors: DataFrame, dim: int, n: int, sums: Sequence[int], change: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Gram matrix of all changed centred rows with a column of ones after them: products, and sums in the last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            _, x = rows_of(batch.column(0), dim)
            if len(x):
                y = change((deviations(x, n, sums) / n).astype(np.float64))
                y = np.column_stack([y, np.ones(len(y))])
                total += y.T @ y
        at = np.repeat(np.arange(width + 1, dtype=np.int32), width + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.tile(np.arange(width + 1, dtype=np.int32), width + 1)), pa.array(total.ravel())], names=["i", "j", "g"])

    parts = vectors.mapInArrow(run, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).toArrow()
    out = np.zeros((width + 1, width + 1))
    out[parts["i"].to_numpy(), parts["j"].to_numpy()] = parts["g"].to_numpy()
    return out


def _root(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of a Gram matrix, with the smallest tried shift that it needs."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(100 * shift, np.finfo(float).eps * np.trace(gram))


def fit(vectors: DataFrame, embedding: str, components: int) -> Whitening | None:
    """Whitening of all usable vectors, or None if there are none. The driver holds matrices of the dimension's square."""
    rows = vectors.select(embedding)
    dim, n, sums = _sums(rows)
    if not n:
        return None
    factors: list[np.ndarray] = []

    def orthogonalised(x: np.ndarray) -> np.ndarray:
        for r in factors:
            x = triangular_solve(x, r)
        return x

    whole, gram, off = np.eye(dim), np.eye(dim), np.inf
    for k in range(PASSES):
        gram = _gram(rows, dim, n, sums, orthogonalised, dim)[:dim, :dim]
        before, off = off, np.abs(gram - np.eye(dim)).max()
        if off <= ORTHOGONAL or not gram.any() or k > 2 and off > before / 2:
            break
        eps = np.finfo(float).eps / 2
        # The first shift is that of the method's error bound for n rows; later passes need none unless rank is lost.
        r = _root(gram, 11 * (n * dim + dim * (dim + 1)) * eps * np.linalg.norm(gram, 2) if k == 0 else 0.0)
        factors.append(r)
        whole = r @ whole
        gram = np.eye(dim)
    # What is left of the last Gram matrix, where a break found it, corrects R; exact even where rank is lost.
    values, sides = np.linalg.eigh(gram)
    corrected = np.sqrt(np.maximum(values, 0))[:, None] * (sides.T @ whole)
    singular, right = np.linalg.svd(corrected)[1:]
    variances = singular**2 / n
    kept = min(components, dim)
    positive = variances[:kept] > variances[0] * dim * dim * np.finfo(float).eps if variances[0] > 0 else np.zeros(kept, dtype=bool)
    with np.errstate(divide="ignore", invalid="ignore"):
        projection = np.where(positive, right[:kept].T / np.sqrt(variances[:kept]), np.nan)
    error = 0.0
    if positive.any():
        used = projection[:, positive]
        g = _gram(rows, dim, n, sums, lambda x: x @ used, used.shape[1])
        mean = g[-1, :-1] / n
        error = float(np.abs(g[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(mean))).max())
    return Whitening(dim, n, sums, projection, variances[:kept], float(variances.sum()), error)


def whitened(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 32) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of every usable vector and component.

    Entries are taken as whole numbers x = floor(64 c) + 1000000. ``n`` usable vectors with sums S are
    the fit list; ``deviation`` is the exact sum of (n x - S)^2 (null beyond a long), ``whitened`` the centred vector
    on a unit eigenvector of the covariance over its deviation, ``explained`` the component's share of
    all variance, ``identity_error`` the largest departure of the whitened covariance from the identity.

    Vectors that are null, empty, hold null or non-finite entries or entries of 2^46 and more, or
    differ in length from the most frequent length, are left out. A component without variance (equal
    rows, a single row, dependent entries) has a null ``whitened`` and plays no part in the error.
    Repeated rows and null ids are rows like any other; extra columns play no part; a table without usable
    vectors gives no rows. Every pass reads the table anew and shuffles one small matrix a task.
    """
    require(vectors, vec_id, embedding)
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(vectors, embedding, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    kept = len(model.variances)
    explained = model.variances / model.total if model.total > 0 else np.zeros(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                at, x = rows_of(part.column(1), model.dim)
                d = deviations(x, model.n, model.sums)
                values = (d / model.n).astype(np.float64) @ model.projection
                many = len(at)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(at, kept))), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), many)),
                    pa.repeat(pa.scalar(model.n, pa.int64()), many * kept), pa.array(squares(d), pa.int64()).take(pa.array(np.repeat(np.arange(many), kept))),
                    pa.array(values.ravel(), from_pandas=True), pa.array(np.tile(explained, many)), pa.repeat(model.error, many * kept),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding")).mapInArrow(run, schema)
