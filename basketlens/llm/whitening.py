"""Embedding whitening from a covariance that is recovered by polarisation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.shared import fresh, ship

#: An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Components that are returned.
COMPONENTS = 8
#: Rows whose dimension pairs are summed at once, and the numbers below which their squares fit 64 bits.
_ROWS, _SMALL = 256, 1 << 26
#: Entries are held to so much, which keeps every sum within 38 digits.
_LARGEST = 2.0**30


@dataclass(frozen=True)
class Whitening:
    """What is fitted: n vectors, the exact sum of each dimension, the exact covariance times n ** 3, and of the first
    components (unit eigenvectors, one a row) the eigenvalues and their share of the trace."""

    n: int
    sums: tuple[int, ...]
    covariance: tuple[tuple[int, ...], ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def _whole(batch: pa.RecordBatch, column: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a batch remain, and their vectors as whole numbers."""
    lists = batch.column(column)
    of_length = pc.fill_null(pc.equal(pc.list_value_length(lists), dimensions), False).to_numpy(zero_copy_only=False)
    values = pc.list_flatten(lists.filter(pa.array(of_length))).cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    finite = np.isfinite(values).all(axis=1)
    remain = of_length.copy()
    remain[of_length] = finite
    held = np.clip(values[finite], -_LARGEST, _LARGEST)
    return remain, np.floor(SCALE * held).astype(np.int64) + SHIFT


def _exact_sums(vectors: DataFrame, dimensions: int, places: int, sums: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """For each place the sum over all vectors; sums gives those of some rows. Only these sums are shuffled."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(places, object)
        for batch in batches:
            _, whole = _whole(batch, 0, dimensions)
            for i in range(0, len(whole), _ROWS):
                total = total + sums(whole[i : i + _ROWS]).astype(object)
        decimals = pa.array([Decimal(int(x)) for x in total], pa.decimal128(38, 0))
        yield pa.record_batch([pa.array(range(places), pa.int32()), decimals], names=["place", "total"])

    parts = vectors.mapInArrow(task, "place int, total decimal(38,0)")
    found = {r.place: int(r.total) for r in parts.groupBy("place").agg(F.sum("total").alias("total")).collect()}
    return [found.get(k, 0) for k in range(places)]


def _squares(centred: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sums over the rows of the squares of every dimension and of every sum of two."""
    if np.abs(centred).max(initial=0) >= _SMALL:
        centred = centred.astype(object)
    both = centred[:, pairs[0]] + centred[:, pairs[1]]
    return np.concatenate([(centred * centred).sum(axis=0), (both * both).sum(axis=0)])


def dimensions_of(vectors: DataFrame, column: str = "embedding") -> int:
    """Entries of the longest vector that has no null and no non-finite entry; 0 if there is none."""
    fine = F.forall(column, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    return vectors.where(fine).select(F.max(F.size(column))).first()[0] or 0


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fits a whitening to all vectors without null or non-finite entries.

    Var(a + b) - Var(a) - Var(b) is twice Cov(a, b), so squares are all that is summed: for each dimension and each sum of
    two dimensions those of the vectors less the whole number next to the mean; what that misses of the mean is known
    exactly and taken off at the end. All sums are whole numbers, which do not depend on the order of rows or on tasks
    that run again. d * (d + 1) / 2 of them come to the driver, where the covariance of d dimensions is decomposed.

    A vector shorter than the longest lacks entries and is left out like one with nulls. Entries beyond 2 ** 30 count
    as that. Without vectors there are no components.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{column}`").alias("v"))
    d = dimensions_of(rows, "v")
    if not d:
        return Whitening(0, (), (), np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    counted = _exact_sums(rows, d, d + 1, lambda x: np.append(x.sum(axis=0), len(x)))
    sums, n = counted[:d], counted[d]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    missed = [s - n * m for s, m in zip(sums, middle)]
    left, right = np.triu_indices(d, 1)
    centre = np.array(middle, np.int64)
    squares = _exact_sums(rows, d, d + len(left), lambda x: _squares(x - centre, (left, right)))
    # n ** 3 times the variances: the sum of (n * y - t) ** 2 over all n rows, where the y add up to t
    alone = [n * n * q - n * t * t for q, t in zip(squares, missed)]
    scaled = [[0] * d for _ in range(d)]
    for i in range(d):
        scaled[i][i] = alone[i]
    for i, j, q in zip(left.tolist(), right.tolist(), squares[d:]):
        together = n * n * q - n * (missed[i] + missed[j]) ** 2
        scaled[i][j] = scaled[j][i] = (together - alone[i] - alone[j]) // 2
    covariance = np.array([[x / n**3 for x in row] for row in scaled])
    values, vectors_ = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    chosen = vectors_[:, order].T
    signs = np.sign(chosen[np.arange(len(chosen)), np.abs(chosen).argmax(axis=1)])
    trace = sum(alone) / n**3
    found = np.maximum(values[order], 0.0)
    # what rounding leaves of a component without variance
    found[found <= 1e-12 * found.max(initial=0)] = 0.0
    explained = found / trace if trace else np.zeros(len(found))
    return Whitening(n, tuple(sums), tuple(map(tuple, scaled)), chosen * signs[:, None], found, explained)


def _projection(fitted: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """The sums, and the matrix that takes n * x - S to the components; without variance it is not a number."""
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(fitted.eigenvalues > 0, 1 / np.sqrt(fitted.eigenvalues), np.nan)
    return np.array(fitted.sums, np.int64), (fitted.components * scale[:, None]).T / max(fitted.n, 1)


def _deviations(centred: np.ndarray) -> pa.Array:
    """Exact sums of squares; null where one is beyond 64 bits."""
    if np.abs(centred).max(initial=0) < 2**31 / max(1, centred.shape[1]) ** 0.5:
        return pa.array((centred * centred).sum(axis=1), pa.int64())
    exact = (centred.astype(object) ** 2).sum(axis=1)
    return pa.array([int(x) if x < 2**63 else None for x in exact], pa.int64())


def whiten(vectors: DataFrame, fitted: Whitening, column: str = "embedding") -> DataFrame:
    """The rows of vectors that have no null or non-finite entry and the length of the fitted ones, all columns, with
    `deviation` (long: the sum over dimensions of (n * x - S) ** 2) and `whitened` (an array of double by component, null
    for one without variance). A column of vectors with one of these names is kept and the new one gets a
    trailing underscore. Rows alike are whitened alike."""
    ship(vectors.sparkSession)
    names = vectors.columns
    added = fresh(vectors, "deviation", "whitened")
    place, d, k = names.index(column), len(fitted.sums), len(fitted.eigenvalues)
    new = [T.StructField(added[0], T.LongType()), T.StructField(added[1], T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*vectors.schema.fields, *new])
    if not d:
        return vectors.sparkSession.createDataFrame([], schema)
    sums, matrix = _projection(fitted)
    n = fitted.n

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            remain, whole = _whole(batch, place, d)
            centred = n * whole - sums
            flat = (centred @ matrix).reshape(-1)
            offsets = pa.array(np.arange(len(whole) + 1, dtype=np.int32) * k)
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.float64(), mask=np.isnan(flat)))
            kept = batch.filter(pa.array(remain))
            yield pa.RecordBatch.from_arrays([*kept.columns, _deviations(centred), lists], names=[*names, *added])

    return vectors.mapInArrow(task, schema)


def identity_error(vectors: DataFrame, fitted: Whitening, column: str = "embedding") -> float | None:
    """Largest absolute entry of the covariance of the whitened vectors, as it is measured over all of them, minus the
    identity; components without variance aside. None without components."""
    ship(vectors.sparkSession)
    d, k = len(fitted.sums), int((fitted.eigenvalues > 0).sum())
    if not k:
        return None
    sums, matrix = _projection(fitted)
    n = fitted.n
    left, right = np.triu_indices(k)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(left))
        for batch in batches:
            # these are centred: n * x - S adds up to 0
            own = (n * _whole(batch, 0, d)[1] - sums) @ matrix[:, :k]
            total += (own.T @ own)[left, right]
        yield pa.record_batch([pa.array(range(len(left)), pa.int32()), pa.array(total)], names=["place", "total"])

    parts = vectors.select(F.col(f"`{column}`").alias("v")).mapInArrow(task, "place int, total double")
    found = {r.place: r.total for r in parts.groupBy("place").agg(F.sum("total").alias("total")).collect()}
    return max(abs(found.get(p, 0.0) / n - (left[p] == right[p])) for p in range(len(left)))


def by_component(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Fits and whitens: vec_id, component (from 1), n, deviation, whitened, explained and identity_error, a row for each
    remaining vector and component; see `fit` and `whiten`."""
    fitted = fit(vectors, column)
    error = identity_error(vectors, fitted, column)
    shares = F.array(*[F.lit(float(x)) for x in fitted.explained]).cast("array<double>")
    rows = whiten(vectors.select("vec_id", F.col(f"`{column}`").alias("v")), fitted, "v")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
