"""Whitening of embeddings by Chebyshev-filtered subspace iteration over distributed passes."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmill.llm.common import drop, store

SCALE, SHIFT = 64, 1_000_000
COMPONENTS, GUARD = 32, 16
#: Highest degree of a filter, most that it may stretch one wanted direction over another.
DEGREE, STRETCH = 8, 1e8
#: Residual over the largest eigenvalue at which a pair is certain, the one that must be
#: reached when rounding allows no more, and rounds.
CERTAIN, ENOUGH, ROUNDS = 1e-13, 1e-10, 60
#: An eigenvalue below this part of the largest counts as zero.
ZERO = 1e-12
#: An entry beyond this has no exact 64-bit form.
LARGEST = 2.0**50


@dataclass(frozen=True)
class Fit:
    """What the fit list gives: ``n``, exact sums, unit directions in columns, their eigenvalues, trace."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    values: np.ndarray
    trace: float


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """A stored table ``vec_id, x`` of the vectors that take part, as whole numbers.

    Vectors that are null or hold null, non-finite or over-large entries (beyond 2^50) are left
    out, and so are empty ones and those whose length is not the most common (the larger of
    two).
    """
    entry = F.col(vector)
    fine = entry.isNotNull() & F.forall(entry, lambda c: c.isNotNull() & (F.abs(c.cast("double")) <= LARGEST) & ~F.isnan(c))
    x = F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    rows = embeddings.where(F.coalesce(fine, F.lit(False)) & (F.size(entry) > 0)).select("vec_id", x.alias("x"))
    kept = store(rows, "vectors")
    sizes = kept.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.agg(F.max(F.struct("n", "d")).alias("m"), F.count(F.lit(1)).alias("kinds")).first()
    if common["kinds"] > 1:
        return kept.where(F.size("x") == common["m"]["d"])
    return kept


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    first, last = x.offsets[0].as_py(), x.offsets[-1].as_py()
    return x.values.slice(first, last - first).to_numpy().reshape(len(x), -1)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``x - S / n``: the whole part of the mean goes off exactly, then the rest of it."""
    whole = np.array([s // n for s in sums])
    rest = np.array([s % n for s in sums]) / n
    return (x - whole) - rest


def summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of ``part`` of each batch, an array of ``shape``.

    A task adds up its own batches; Spark adds up the tasks, one group per entry, so no more
    than one array reaches the driver.
    """
    width = shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if len(batch):
                total += part(matrix(batch))
        at = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["at", "value"])

    found = rows.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    got = found.toPandas().sort_values("at")["value"].to_numpy()
    return got.reshape(-1, width) if len(got) else np.zeros(shape)


class Covariance:
    """The covariance of the fit list as a linear map: every product is one pass over the rows."""

    def __init__(self, rows: DataFrame, n: int, sums: tuple[int, ...]) -> None:
        self.rows, self.n, self.sums, self.passes = rows, n, sums, 0

    def __call__(self, q: np.ndarray) -> np.ndarray:
        n, sums = self.n, self.sums
        self.passes += 1

        def part(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            return c.T @ (c @ q)

        return summed(self.rows, part, q.shape) / n


def degree(top: float, low: float, high: float) -> int:
    """The highest degree of which the filter stretches the largest eigenvalue at most ``STRETCH``
    times as much as the smallest wanted one."""
    def grown(value: float, m: int) -> float:
        t = 2 * value / high - 1
        return m * math.acosh(t) if t > 1 else 0.0

    for m in range(DEGREE, 1, -1):
        if grown(top, m) - grown(low, m) <= math.log(STRETCH):
            return m
    return 1


def filtered(v: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, top: float, low: float, high: float) -> np.ndarray:
    """``q`` under the Chebyshev polynomial that stays small on the unwanted ``[0, high]``.

    ``vq``, the product with ``q`` that is known already, is the recurrence's first step; every
    step is scaled, so that the largest direction stays of size one.
    """
    half = high / 2
    sigma = first = half / (top - half)
    before, now = q, (vq - half * q) * (sigma / half)
    for _ in range(1, degree(top, low, high)):
        after_sigma = 1 / (2 / first - sigma)
        after = (v(now) - half * now) * (2 * after_sigma / half) - (sigma * after_sigma) * before
        before, now, sigma = now, after, after_sigma
    return now


def dominant(v: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, guard: int = GUARD, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of ``v`` and their unit eigenvectors, certified.

    A block of ``guard`` more directions than wanted is filtered, made orthonormal by QR and
    rotated by Rayleigh-Ritz, until every wanted pair's residual is certain. When rounding
    stops the residuals above that, they must still be below ``ENOUGH``.
    """
    wanted = min(wanted, d)
    size = min(d, wanted + guard)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, size)))[0]
    best, worse = None, 0
    for _ in range(ROUNDS):
        vq = v(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values, kind="stable")
        values, q, vq = np.maximum(values[order], 0), q @ turn[:, order], vq @ turn[:, order]
        top = values[0]
        if top == 0:
            return values[:wanted], q[:, :wanted]
        residual = np.linalg.norm(vq - q * values, axis=0)[:wanted].max() / top
        if best is None or residual < best[0] / 2:
            worse = 0
        else:
            worse += 1
        if best is None or residual < best[0]:
            best = residual, values[:wanted], q[:, :wanted]
        if best[0] <= CERTAIN or (worse >= 4 and best[0] <= ENOUGH):
            break
        high = values[-1] if size < d else 0.0
        if high <= ZERO * top:
            q = np.linalg.qr(vq + ZERO * top * q)[0]
        else:
            q = filtered(v, q, vq, top, max(values[wanted - 1], high), high)
            q = np.linalg.qr(q / np.linalg.norm(q, axis=0))[0]
    if best[0] > ENOUGH:
        raise ArithmeticError(f"not certified after {ROUNDS} rounds: residual {best[0]:.1e}")
    return best[1], best[2]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Sums, covariance directions and trace of all rows; None without rows.

    Directions of eigenvalue zero can't be whitened and are left out, so a list of equal
    vectors has none.
    """
    each = rows.select(F.posexplode("x").alias("pos", "v")).groupBy("pos")
    sums_of = each.agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("pos").collect()
    if not sums_of:
        return None
    n, sums = sums_of[0]["n"], tuple(int(r["s"]) for r in sums_of)
    d = len(sums)
    spread = summed(rows, lambda x: (centred(x, n, sums) ** 2).sum(axis=0, keepdims=True), (1, d))
    trace = float(spread.sum()) / n
    values, directions = dominant(Covariance(rows, n, sums), d, components)
    some = values > ZERO * max(values[0], 0) if len(values) else np.zeros(0, bool)
    return Fit(n, sums, directions[:, some], values[some], trace)


def identity_error(rows: DataFrame, found: Fit) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, in two passes."""
    to = found.directions / np.sqrt(found.values)
    r, n, sums = to.shape[1], found.n, found.sums
    if not r:
        return 0.0
    mean = summed(rows, lambda x: (centred(x, n, sums) @ to).sum(axis=0, keepdims=True), (1, r)) / n

    def part(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ to - mean
        return w.T @ w

    return float(np.abs(summed(rows, part, (r, r)) / n - np.eye(r)).max())


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Sum over the dimensions of ``(n x - S)^2`` of every row, exact."""
    most = n * int(np.abs(x).max()) + max(map(abs, sums))
    if len(sums) * most * most < 1 << 62:
        return ((n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
    away = n * x.astype(object) - np.array(sums, dtype=object)
    if (away**2).sum(axis=1).max() >= 1 << 63:
        raise OverflowError("a deviation has no 64-bit form: the fit list is too large or too wide")
    return (away**2).sum(axis=1).tolist()


def transformed(rows: DataFrame, found: Fit) -> DataFrame:
    """``vec_id, deviation, whitened``: one row per vector, ``whitened`` an array by component."""
    n, sums = found.n, found.sums
    to = found.directions / np.sqrt(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = matrix(batch)
            w = centred(x, n, sums) @ to
            lists = pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviations(x, n, sums), pa.int64()), lists], names=["vec_id", "deviation", "whitened"]
            )

    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every vector and component.

    The fit list is every vector that takes part (see ``usable``). Rows are whitened whatever
    their vec_id, so repeated and missing ids keep their own rows; equal vectors get equal
    rows. No vector, or none that differs from another, gives no rows. Only ``vec_id`` and
    ``embedding`` are read, so other columns may have any names.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings.select(F.col("vec_id").cast("long"), "embedding"))
    found = fit(rows, components)
    if found is None or not len(found.values):
        drop(rows)
        return spark.createDataFrame([], SCHEMA)
    error = identity_error(rows, found)
    explained = F.array(*[F.lit(float(v / found.trace)) for v in found.values])
    return transformed(rows, found).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")
    ).select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
