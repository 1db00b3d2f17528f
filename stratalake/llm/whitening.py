"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors are scaled and rounded down to longs; each distinct one is a point of the fit, so repeated
rows weigh nothing. No covariance matrix is formed: a pass over the points gives the centred product
``X'X Q / n`` for a block ``Q`` of a few columns, summed by Spark from one small matrix per task.

The block starts as random orthonormal columns. A filter applies a Chebyshev polynomial of the
covariance to it, one pass for each degree, by the recurrence on whole blocks. The polynomial stays
within one on the unwanted spectrum, from zero to the block's smallest Ritz value, and grows fast
above it. The filtered block is made orthonormal (QR), and Rayleigh-Ritz gives eigenvalues and
vectors with residuals. They are certified when no residual ``|V q - e q|`` is above
``tolerance * e``, or when small ones (``FLOOR * e``, or ``tolerance`` of the first eigenvalue) have
stopped falling, which is as far as rounding lets them. The degree is chosen so that the largest
eigenvalue does not swamp the block.

The driver holds blocks of dimensions x columns, never a vector of the table.

Defined cases: a vector that is NULL or holds a NULL or non-finite entry is left out; shorter vectors
are filled up with zeros to the longest; entries beyond the range of a long take its ends;
components without variance are left out, so equal vectors or a single one give no rows; a NULL id
stays; repeated rows each get theirs; a deviation that does not fit a long is NULL; an empty table
gives an empty result; only the id and the vector column are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.centroids import finite
from stratalake.llm.common import stored

SCALE, COMPONENTS = 256, 4
#: Columns beside the wanted ones; they move the edge of the unwanted spectrum away.
GUARD = 28
TOLERANCE, FLOOR = 1e-13, 1e-9
#: Residuals that were not halved in so many rounds have stopped falling.
PATIENCE = 8
#: Most growth of the first eigenvalue over the unwanted spectrum in one filter, and its degrees.
GROWTH, MAX_DEGREE, MAX_PASSES = 1e8, 12, 2_000
#: Eigenvalues below this share of the first count as zero.
ZERO = 1e-12
#: Points whose products are summed before they leave a task's memory.
ROWS = 8_192


class Fit(NamedTuple):
    """What whitening needs to know of the points; columns of ``vectors`` are the components."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int


def scaled(vector: F.Column, scale: int) -> F.Column:
    """Entries times ``scale``, rounded down to longs."""
    # The ends of long as doubles; the upper one is the greatest double below 2**63.
    low, high = F.lit(-float(2**63)), F.lit(float(2**63 - 1024))
    return F.transform(vector, lambda c: F.floor(F.greatest(low, F.least(
        high, c.cast("double") * float(scale)))).cast("long"))


def _centred(batch: pa.RecordBatch, mean: np.ndarray) -> Iterator[np.ndarray]:
    """Points of a batch less ``mean``, in pieces."""
    for data in batch.column("points").to_pylist():
        points = np.frombuffer(data, "<i8").reshape(-1, len(mean))
        for at in range(0, len(points), ROWS):
            yield points[at:at + ROWS].astype(np.float64) - mean


def _blobs(distinct: DataFrame, dimensions: int) -> DataFrame:
    """Points as rows of many, each a block of whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = batch.column("x").flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([values.astype("<i8").tobytes()], pa.binary()),
                     pa.array([batch.num_rows], pa.int64())], names=["points", "n"])

    return distinct.mapInArrow(run, "points binary, n long")


def _total(points: DataFrame, mean: np.ndarray, shape: tuple[int, ...], of) -> np.ndarray:
    """The sum over all points of the matrix that ``of`` gives for some of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(shape)
        for batch in batches:
            for some in _centred(batch, mean):
                found += of(some)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(found.size), pa.int64()), pa.array(found.reshape(-1))],
            names=["cell", "value"])

    cells = points.select("points").mapInArrow(run, "cell long, value double").groupBy("cell").agg(
        F.sum("value").alias("value"))
    total = np.zeros(int(np.prod(shape)))
    for row in cells.collect():  # one row for each entry of the matrix
        total[row["cell"]] = row["value"]
    return total.reshape(shape)


def _filtered(apply, block: np.ndarray, product: np.ndarray, cut: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of the covariance that stays within one on [0, ``cut``].

    ``product`` is the covariance times the block, known from the step before.
    """
    far = 2 * top / cut - 1
    degree = 1
    while degree < MAX_DEGREE and np.cosh((degree + 1) * np.arccosh(far)) <= GROWTH:
        degree += 1
    former, latest = block, 2 * product / cut - block
    for _ in range(degree - 1):
        former, latest = latest, 2 * (2 * apply(latest) / cut - latest) - former
        size = np.abs(latest).max()
        former, latest = former / size, latest / size
    return latest


def subspace(
    apply, dimensions: int, components: int = COMPONENTS, guard: int = GUARD,
    tolerance: float = TOLERANCE,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Leading eigenvectors, eigenvalues, residuals and passes of what ``apply`` multiplies by."""
    columns, passes = min(dimensions, components + guard), 0
    wanted = min(components, dimensions)
    random = np.random.default_rng(20240403).standard_normal((dimensions, columns))
    block, halved, stalled = random, np.inf, 0

    def counted(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return apply(q)

    while True:
        block = np.linalg.qr(block)[0]
        product = counted(block)
        inner = block.T @ product
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = np.maximum(values[::-1], 0), turn[:, ::-1]
        block, product = block @ turn, product @ turn
        residuals = np.linalg.norm(product - block * values, axis=0)[:wanted]
        own, first = values[:wanted], values[0]
        scale = np.where(own > ZERO * first, own, first)
        worst = (residuals / scale).max() if first > 0 else 0.0
        halved, stalled = (worst, 0) if worst < halved / 2 else (halved, stalled + 1)
        small = bool((residuals <= np.maximum(FLOOR * scale, tolerance * first)).all())
        if worst <= tolerance or (small and stalled >= PATIENCE):
            return block[:, :wanted], own, residuals, passes
        if passes >= MAX_PASSES:
            raise RuntimeError(f"residuals of {worst:.1e} after {passes} passes")
        cut = values[-1]
        # Without an unwanted spectrum one more product is all that is needed.
        block = product if cut <= ZERO * first else _filtered(
            counted, block, product, cut, first)


def fitted(
    points: DataFrame, n: int, sums: list[int], components: int = COMPONENTS, guard: int = GUARD
) -> Fit:
    """Components of the covariance (divisor ``n``) of the points, certified."""
    mean, dimensions = np.array([s / n for s in sums]), len(sums)
    trace = float(_total(points, mean, (1,), lambda x: np.array([np.vdot(x, x)]))[0]) / n

    def apply(block: np.ndarray) -> np.ndarray:
        return _total(points, mean, block.shape, lambda x: x.T @ (x @ block)) / n

    if trace <= 0:
        none = np.zeros(0)
        return Fit(n, sums, np.zeros((dimensions, 0)), none, 0.0, none, 0)
    vectors, values, residuals, passes = subspace(apply, dimensions, components, guard)
    kept = values > ZERO * values[0]
    vectors, values = vectors[:, kept], values[kept]
    # The sign is free: the entry of the largest magnitude is positive.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return Fit(n, sums, vectors, values, trace, residuals[kept], passes)


def _identity_error(points: DataFrame, fit: Fit) -> float:
    """Largest entry by magnitude of the whitened points' covariance less the identity."""
    mean, k = np.array([s / fit.n for s in fit.sums]), len(fit.values)
    turn = fit.vectors / np.sqrt(fit.values)

    def moments(x: np.ndarray) -> np.ndarray:
        white = x @ turn
        return np.vstack([white.T @ white, white.sum(axis=0)]) / fit.n

    *second, first = _total(points, mean, (k + 1, k), moments)
    return float(np.abs(np.array(second) - np.outer(first, first) - np.eye(k)).max())


def _deviations(points: np.ndarray, fit: Fit) -> list[int | None]:
    """Sum over the dimensions of ``(n x - S)**2``, exact; None beyond a long."""
    widest = max(max(map(abs, fit.sums)), fit.n * max(-int(points.min()), int(points.max()), 0))
    if len(fit.sums) * (2 * widest) ** 2 < 1 << 63:
        apart = fit.n * points - np.array(fit.sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    found = [sum((fit.n * x - s) ** 2 for x, s in zip(point, fit.sums)) for point in points.tolist()]
    return [value if value < 1 << 63 else None for value in found]


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
    components: int = COMPONENTS, guard: int = GUARD,
) -> DataFrame:
    """Per vector and component: id, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``."""
    vector = F.col(vector_col)
    rows = vectors.where(finite(vector)).select(
        F.col(id_col).alias("id"), scaled(vector, scale).alias("x"))
    schema = rows.select("id").schema.add("component", "integer").add("n", "long").add(
        "deviation", "long").add("whitened", "double").add("explained", "double").add(
            "identity_error", "double")
    dimensions = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if dimensions:
        rows = rows.withColumn("x", F.when(F.size("x") == dimensions, F.col("x")).otherwise(
            F.concat("x", F.array_repeat(F.lit(0).cast("long"), dimensions - F.size("x")))))
    points = stored(_blobs(rows.select("x").distinct(), max(1, dimensions)))
    n = points.agg(F.sum("n")).first()[0] or 0
    if not dimensions or not n:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    fit = fitted(points, n, _sums(points, dimensions), components, guard)
    error = _identity_error(points, fit) if len(fit.values) else 0.0
    mean, turn = np.array([s / n for s in fit.sums]), fit.vectors / np.sqrt(fit.values)
    k = len(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, n), pa.int64()),
                 pa.array(_deviations(x, fit), pa.int64()).take(each),
                 pa.array(((x.astype(np.float64) - mean) @ turn).reshape(-1)),
                 pa.array(np.tile(fit.values / fit.trace, m)), pa.array(np.full(m * k, error))],
                names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _sums(points: DataFrame, dimensions: int) -> list[int]:
    """Sums of each dimension, exact at any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("points").to_pylist():
                block = np.frombuffer(data, "<i8").reshape(-1, dimensions)
                # Halves of 32 bits cannot overflow in a block.
                high, low = block >> 32, block & 0xFFFFFFFF
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(dimensions), pa.int32()), pa.array(high.sum(axis=0)),
                     pa.array(low.sum(axis=0))], names=["dimension", "high", "low"])

    exact = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("high", "low")]
    found = points.select("points").mapInArrow(run, "dimension int, high long, low long").groupBy(
        "dimension").agg(*exact)
    sums = [0] * dimensions
    for row in found.collect():  # one row for each dimension
        sums[row["dimension"]] = (int(row["high"]) << 32) + int(row["low"])
    return sums
