"""Whitening of embeddings by block Lanczos iteration.

The covariance V of the vectors is never formed.  A pass over all vectors, which
Spark partitions, multiplies V by a block of directions: each task centres its
vectors, projects them on the block and adds up their products with what comes
out, and Spark adds up the tasks' sums.  The driver holds the directions so far
and their products alone, of the size of the dimension.  Each new block is made
orthogonal to all earlier ones, twice; directions that vanish in that
(breakdown) start again at random.  The iteration ends when the residuals
V u - e u of all wanted components have fallen to rounding, or the directions
span the whole space.

Vectors are counted as integers: an entry c is floor(1024 c) + 100000.  The sums
are exact, and so are the deviations that give the trace of V and with it the
share that each component explains.

Defined results: vectors that are null or empty, that hold null or non-finite
entries or one beyond 2^38, are dropped; so are those not of the commonest
length (of several, the greatest).  Repeated rows count and return as often as
they are there, null ids too.  Fewer entries than components give fewer
components.  A component without variance (all vectors equal along it) has
explained 0 and no whitened values.  A deviation that doesn't fit a long is null.
No vectors, no rows.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
#: Entries beyond are out of range: sums of a batch stay exact in a long.
LARGEST = float(1 << 38)
#: Residuals that count as rounding, and those that will do once they fall no more, relative to the largest eigenvalue.
EXACT, ENOUGH = 1e-14, 1e-11
#: Eigenvalues below, relative to the largest one, are no variance.
NOTHING = 1e-12


@dataclass
class Components:
    """What is fitted: count, exact sums, eigenvalues in falling order and unit eigenvectors as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int

    @property
    def positive(self) -> np.ndarray:
        return self.values > NOTHING * max(self.values.max(initial=0), 0)


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them numbers in range."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


# --- inside Arrow-batched functions -----------------------------------------


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(entries * SCALE).astype(np.int64).reshape(-1, dim) + SHIFT


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n, rounded once: the whole part of the mean goes first, as an integer."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.float64) / n
    return (x - whole) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray | list[int]:
    """The sums of (n x - S)^2 over the entries, exactly: as Python's integers where longs may not hold them."""
    whole, rest = np.array([s // n for s in sums], np.int64), [s % n for s in sums]
    most = max(int(np.abs(x - whole).max(initial=0)) + 1, 1) * n
    if most * most * x.shape[1] < 1 << 62:
        part = (x - whole) * n - np.array(rest, np.int64)
        return (part * part).sum(axis=1)
    return [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]


def _summed(rows: DataFrame, dim: int, width: int, kind: str, add: Callable[[np.ndarray], np.ndarray]) -> dict[int, list]:
    """The sums over all rows of a small table that ``add`` makes of each batch, a list for each of its lines."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = add(_integers(batch.column("v"), dim))
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch({"i": np.arange(len(total), dtype=np.int32), "part": pa.array(total.tolist(), pa.list_(pa.int64() if kind == "long" else pa.float64()))})

    parts = rows.select("v").mapInArrow(of, f"i int, part array<{kind}>")
    at = lambda j: F.col("part")[j].cast("decimal(38,0)") if kind == "long" else F.col("part")[j]
    return {r.i: list(r[1:]) for r in parts.groupBy("i").agg(*[F.sum(at(j)).alias(f"s{j}") for j in range(width)]).collect()}


# --- the fit -----------------------------------------------------------------


def _orthogonal(block: np.ndarray, basis: np.ndarray, scale: float, rng: np.random.Generator) -> np.ndarray:
    """Unit columns that are orthogonal to the basis and each other; those that vanish start again at random."""
    found: list[np.ndarray] = []
    for column in block.T:
        fresh = False
        while True:
            if len(found) + basis.shape[1] == len(column):
                return np.array(found).T.reshape(len(column), -1)
            held = np.column_stack([basis, *found]) if found else basis
            before = np.linalg.norm(column)
            for _ in range(2):
                column = column - held @ (held.T @ column)
            after = np.linalg.norm(column)
            if after > (1e-8 * before if fresh else 1e-13 * scale):
                column = column / after
                column = column - held @ (held.T @ column)
                found.append(column / np.linalg.norm(column))
                break
            column, fresh = rng.standard_normal(len(column)), True  # breakdown
    return np.array(found).T


def lanczos(multiply: Callable[[np.ndarray], np.ndarray], dim: int, count: int, block: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """The greatest eigenvalues of a symmetric matrix known by its products, their unit eigenvectors, and the passes taken."""
    rng = np.random.default_rng(5)
    count = min(count, dim)
    width = min(block or count, dim)
    basis = np.zeros((dim, 0))
    products = np.zeros((dim, 0))
    fresh = _orthogonal(rng.standard_normal((dim, width)), basis, 1.0, rng)
    passes, least, still = 0, np.inf, 0
    while True:
        basis, products = np.column_stack([basis, fresh]), np.column_stack([products, multiply(fresh)])
        passes += 1
        small = basis.T @ products
        values, turns = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)[:count]
        values, turns = values[order], turns[:, order]
        vectors = basis @ turns
        worst = np.linalg.norm(products @ turns - vectors * values, axis=0).max()
        scale = max(np.abs(values).max(), np.finfo(float).tiny)
        still = still + 1 if worst > least / 2 else 0
        least = min(least, worst)
        if basis.shape[1] >= count and (worst <= EXACT * scale or (worst <= ENOUGH * scale and still >= 3)) or basis.shape[1] == dim:
            return values, vectors / np.linalg.norm(vectors, axis=0), passes
        fresh = _orthogonal(products[:, -fresh.shape[1] :], basis, scale, rng)


def _prepared(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """The vectors of the commonest length, as ``v``, and that length."""
    fine = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(usable(F.col("v")))
    most = fine.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = most.dim if most else 0
    return fine.filter(F.size("v") == dim), dim


def _fit(vectors: DataFrame, dim: int, count: int) -> Components:
    sums_of = _summed(vectors, dim, dim + 1, "long", lambda x: np.append(x.sum(axis=0), len(x))[None, :])[0]
    sums, n = [int(s) for s in sums_of[:-1]], int(sums_of[-1])
    spread = _summed(vectors, dim, 1, "double", lambda x: np.array([[float(sum(map(float, deviations(x, n, sums))))]]))[0][0]

    def multiply(block: np.ndarray) -> np.ndarray:
        def add(x: np.ndarray) -> np.ndarray:
            centred = _centred(x, n, sums)
            return centred.T @ (centred @ block)

        found = _summed(vectors, dim, block.shape[1], "double", add)
        return np.array([found[i] for i in range(dim)]) / n

    values, axes, passes = lanczos(multiply, dim, count)
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None, :], axis=0) < 0, -1, 1)
    return Components(n, sums, values, axes, spread / n / n / n, passes)


def fit(rows: DataFrame, count: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> Components | None:
    """The components of greatest variance; None where there are no vectors."""
    vectors, dim = _prepared(rows, id_col, vector_col)
    return _fit(vectors, dim, count) if dim else None


# --- what it gives -----------------------------------------------------------


def _projected(x: np.ndarray, c: Components) -> np.ndarray:
    """Whitened values of the components that have variance."""
    return _centred(x, c.n, c.sums) @ c.vectors[:, c.positive] / np.sqrt(c.values[c.positive])


def _identity_error(vectors: DataFrame, dim: int, c: Components) -> float:
    """How far the whitened values' covariance is from the identity, at its worst entry."""
    width = int(c.positive.sum())
    if not width:
        return 0.0

    def add(x: np.ndarray) -> np.ndarray:
        y = _projected(x, c)
        return np.column_stack([y.T @ y, y.sum(axis=0)])

    found = _summed(vectors, dim, width + 1, "double", add)
    table = np.array([found[i] for i in range(width)]) / c.n
    mean = table[:, -1]
    return float(np.abs(table[:, :-1] - np.outer(mean, mean) - np.eye(width)).max())


def whiten(rows: DataFrame, count: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    vectors, dim = _prepared(rows, id_col, vector_col)
    kind = vectors.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not dim:
        return rows.sparkSession.createDataFrame([], schema)
    c = _fit(vectors, dim, count)
    error, size, positive = _identity_error(vectors, dim, c), len(c.values), c.positive
    shares = np.where(positive, c.values / c.trace if c.trace else 0.0, 0.0)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = _integers(batch.column("v"), dim)
            whitened = np.full((rows, size), np.nan)
            whitened[:, positive] = _projected(x, c)
            far = [int(d) if d < 1 << 63 else None for d in deviations(x, c.n, c.sums)]
            each = pa.array(np.repeat(np.arange(rows), size))
            yield pa.record_batch({
                id_col: batch.column("id").take(each), "component": np.tile(np.arange(1, size + 1, dtype=np.int32), rows), "n": np.full(rows * size, c.n),
                "deviation": pa.array(far, pa.int64()).take(each), "whitened": pa.array(whitened.ravel(), mask=np.tile(~positive, rows)),
                "explained": np.tile(shares, rows), "identity_error": np.full(rows * size, error),
            })

    return vectors.mapInArrow(of, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their eight components of greatest variance."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
