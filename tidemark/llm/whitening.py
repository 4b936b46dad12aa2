"""Embedding whitening: covariance by exact sums, spectral divide and conquer by QDWH, projection in tasks.

Entries become integers, so all sums are exact whatever the order of tasks: one pass gives the sums per
dimension, a second the products of entries centred at the rounded mean, from which the covariance follows with
one rounding an entry. Its eigenvectors are found by splitting: the polar factor of the covariance less a shift
(by QR-based dynamically weighted Halley iteration) gives the projector on the eigenvalues above the shift; bases
of its range and of the rest reduce the matrix to two diagonal blocks, and so on down to single vectors. The
whitening matrix (dimensions times components, whatever the rows) is broadcast. A third pass takes the
covariance of the whitened rows, a last one returns them.

Defined results: a row takes part if its vector has no null or non-finite entry, no entry of 2**40 or more in
size and the commonest length (the longer on ties); others are dropped. Repeated rows and ids count as often as
they occur; ids may be null. Components whose variance is not above rounding error (as with fewer rows than
dimensions) have a null ``whitened`` and are left out of ``identity_error``; without any variance ``explained``
and ``identity_error`` are null. A ``deviation`` beyond 64 bits is null. No rows give no rows; extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bound_batches, tidy

EPS = float(np.finfo(np.float64).eps)
COMPONENTS = 32
LARGEST = 2.0**40  # of an entry
SUMS_LEFT = 64  # partial sums that reach the driver
HALF = 1 << 32


@dataclass(frozen=True)
class Whitening:
    """What the tasks need: counts, exact sums, integer centres, eigenvalues and the projection."""

    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray  # mean less centre
    values: np.ndarray  # all eigenvalues, falling
    trace: float
    basis: np.ndarray  # dimensions x components, scaled to variance 1; NaN without variance


# ---- spectral divide and conquer ------------------------------------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QR-based Halley iteration with dynamic weights."""
    size, scale = len(a), float(np.linalg.norm(a))
    if scale == 0:
        return np.eye(size)
    x = a / scale
    low = max(float(np.linalg.norm(np.linalg.inv(x), 2) ** -1) * 0.9, EPS) if np.linalg.cond(x) < 1 / EPS else EPS
    for _ in range(40):
        square = low * low
        step = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + step)
        wa = root + 0.5 * np.sqrt(8 - 4 * step + 8 * (2 - square) / (square * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(size)]))
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:size] @ q[size:].T)
        new = (new + new.T) / 2
        moved, x = float(np.linalg.norm(new - x)), new
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if moved <= 8 * EPS * size and 1 - low < 1e-8:
            break
    return x


def shifts(a: np.ndarray) -> Iterator[float]:
    """Places between the smallest and the largest diagonal entry, so between two eigenvalues."""
    d = np.sort(np.diag(a))
    yield float(np.median(d))
    yield float(d.mean())
    for share in (0.5, 0.382, 0.618, 0.27, 0.73, 0.1, 0.9):
        yield float(d[0] + share * (d[-1] - d[0]))


def divide(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of two invariant subspaces that together span everything."""
    size, best = len(a), None
    for shift in shifts(a):
        projector = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < size:
            continue
        range_, _ = np.linalg.qr(projector @ rng.standard_normal((size, rank)))
        range_, _ = np.linalg.qr(projector @ range_)
        whole, _ = np.linalg.qr(range_, mode="complete")
        above, below = whole[:, :rank], whole[:, rank:]
        left = float(np.linalg.norm(below.T @ a @ above))
        if best is None or left < best[0]:
            best = left, above, below
        if left <= 4 * size * EPS * float(np.linalg.norm(a)):
            break
    if best is None:  # all diagonal entries alike: turn the axes
        turned, _ = np.linalg.qr(rng.standard_normal((size, size)))
        above, below = divide(turned.T @ a @ turned, rng)
        return turned @ above, turned @ below
    return best[1], best[2]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix."""
    rng, floor = np.random.default_rng(7), EPS * float(np.linalg.norm(a)) / max(1, len(a))
    values, vectors = [], []
    waiting = [(a, np.eye(len(a)))] if len(a) else []
    while waiting:
        block, basis = waiting.pop()
        if np.linalg.norm(block - np.diag(np.diag(block))) <= floor:
            values += np.diag(block).tolist()
            vectors += list(basis.T)
            continue
        for part in divide(block, rng):
            inner = part.T @ block @ part
            waiting.append(((inner + inner.T) / 2, basis @ part))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors).reshape(len(a), len(a))[order].T


# ---- passes over the rows -------------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < LARGEST))
    return F.when(fits, vector)


def as_long(column: pa.Array, step: float, shift: int) -> np.ndarray:
    """floor(step * entry) + shift of equally long vectors, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(step * flat).astype(np.int64) + shift).reshape(len(column), -1)


def halves(total: np.ndarray) -> np.ndarray:
    """Exact integers (int64 or Python's) as two 64-bit parts that may be summed many times."""
    wide = total.astype(object)
    return np.concatenate([(wide // HALF).ravel(), (wide % HALF).ravel()]).astype(np.int64)


def summed(rows: DataFrame, count: int, kind: str, parts: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> np.ndarray:
    """Sum of ``count`` numbers that ``parts`` gives for the batches of a task: tasks first, then groups of tasks."""

    def emit(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count, kind)
        for part in parts(tidy(batches)):
            total += part
        yield emit(total)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count, kind)
        for batch in batches:
            for one in batch.column(0):
                total += np.frombuffer(one.as_py(), kind)
        yield emit(total)

    left = rows.mapInArrow(first, "sums binary").repartition(SUMS_LEFT).mapInArrow(again, "sums binary").collect()
    return np.sum([np.frombuffer(r["sums"], kind) for r in left], axis=0) if left else np.zeros(count, kind)


def exact(sums: np.ndarray, count: int) -> list[int]:
    return [int(hi) * HALF + int(lo) for hi, lo in zip(sums[:count], sums[count:])]


def products(z: np.ndarray) -> np.ndarray:
    """z'z exactly: in doubles while no sum can pass 2**53, else in Python's integers."""
    most = int(np.abs(z).max(initial=0))
    if most * most * max(1, len(z)) < 2**53:
        own = z.astype(np.float64)
        return (own.T @ own).astype(np.int64)
    own = z.astype(object)
    return own.T @ own


def fit_whitening(vectors: DataFrame, dims: int, step: float, shift: int, components: int) -> Whitening | None:
    """``vectors`` has one column of usable vectors of ``dims`` entries."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            x = as_long(batch.column(0), step, shift) if batch.num_rows else np.zeros((0, dims), np.int64)
            yield halves(np.append(x.sum(axis=0), len(x)))

    total = exact(summed(vectors, 2 * (dims + 1), "<i8", sums), dims + 1)
    n, own = total[-1], total[:-1]
    if not n:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in own], dtype=np.int64)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            if batch.num_rows:
                yield halves(products(as_long(batch.column(0), step, shift) - centre))

    square = exact(summed(vectors, 2 * dims * dims, "<i8", pairs), dims * dims)
    left = [s - n * int(c) for s, c in zip(own, centre)]  # sums of the centred entries
    cov = np.array([(n * square[i * dims + j] - left[i] * left[j]) / (n * n) for i in range(dims) for j in range(dims)])
    cov = cov.reshape(dims, dims)
    values, basis = eigen(cov)
    kept = values > dims * EPS * max(values[0], 0.0)
    scale = np.where(kept, np.sqrt(np.where(kept, values, 1.0)), np.nan)
    return Whitening(
        n, own, centre, np.array([s / n for s in left]), values, float(np.trace(cov)), (basis / scale)[:, :components]
    )


def deviations(z: np.ndarray, fitted: Whitening) -> list[int | None]:
    """Sum over dimensions of (n x - S)**2, exact; null beyond 64 bits."""
    left = np.array([s - fitted.n * int(c) for s, c in zip(fitted.sums, fitted.centre)], dtype=object)
    bound = fitted.n * int(np.abs(z).max(initial=0)) + max((abs(x) for x in left), default=0)
    if bound * bound * max(1, z.shape[1]) < 2**63:
        return ((fitted.n * z - left.astype(np.int64)) ** 2).sum(axis=1).tolist()
    own = ((fitted.n * z.astype(object) - left) ** 2).sum(axis=1)
    return [v if v < 2**63 else None for v in own]


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", step: float = 64.0, shift: int = 1_000_000,
    components: int = COMPONENTS,
) -> DataFrame:
    """A row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    bound_batches(spark)
    out = T.StructType(
        [T.StructField(id_col, df.schema[id_col].dataType)]
        + [T.StructField(c, t) for c, t in (
            ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
            ("explained", T.DoubleType()), ("identity_error", T.DoubleType()),
        )]
    )
    rows = df.select(id_col, usable(F.col(vector_col)).alias("v")).filter("size(v) > 0")
    longest = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if longest is None:
        return spark.createDataFrame([], out)
    dims = longest["dims"]
    rows = rows.filter(F.size("v") == dims)
    fitted = fit_whitening(rows.select("v"), dims, step, shift, components)
    width = fitted.basis.shape[1]
    shared = spark.sparkContext.broadcast(fitted)

    def projected(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        own = shared.value
        z = as_long(column, step, shift) - own.centre
        return z, (z - own.rest) @ own.basis

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            if batch.num_rows:
                w = projected(batch.column(0))[1]
                yield np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    total = summed(rows.select("v"), width + width * width, "<f8", moments)
    mean = total[:width] / fitted.n
    apart = np.abs(total[width:].reshape(width, width) / fitted.n - np.outer(mean, mean) - np.eye(width))
    error = None if np.isnan(apart).all() else float(np.nanmax(apart))
    share = [float(v) / fitted.trace if fitted.trace > 0 else None for v in fitted.values[:width]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in tidy(batches):
            if not batch.num_rows:
                continue
            z, w = projected(batch.column(1))
            count = len(z)
            each = pa.array(np.repeat(np.arange(count), width))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * width, own.n)),
                    pa.array(deviations(z, own), pa.int64()).take(each),
                    pa.array(w.ravel(), from_pandas=True),
                    pa.array(share * count, pa.float64()),
                    pa.array([error] * (count * width), pa.float64()),
                ],
                names=out.names,
            )

    return rows.mapInArrow(run, out)
