"""Embedding whitening from polarised covariances.

Entries become whole numbers ``x = floor(scale * c) + offset``, so all sums are exact and fall out the same however the rows are dealt
to tasks. The covariance of two dimensions is not summed as a product: by polarisation, 2 cov(i, j) = var(i + j) - var(i) - var(j).

1. Every task sums its rows per dimension: ``n`` and ``S``.
2. With values centred on the whole part of the mean, ``d = x - S // n``, every task sums ``d_i ** 2`` for each dimension and
   ``(d_i + d_j) ** 2`` for each pair; the sums of all tasks are added by pair. What is left of the mean is taken off exactly:
   n ** 2 var(i + j) = n * sum((d_i + d_j) ** 2) - (T_i + T_j) ** 2 with T = S - n * (S // n).
3. The driver assembles the matrix of all variances and covariances, each rounded once from whole numbers, and splits it with
   ``eigh``. It gets one number per pair of dimensions (8 * D * D bytes for the matrix), nothing per row.
4. The components (at most ``MAX_COMPONENTS`` times D doubles) are broadcast, and each row is projected on its own.

Sums are kept in 64 bits as long as a bound on them allows, else in Python integers, and cross the shuffle as decimals.

Rows are left out if the vector is null or empty, or has an entry that is null, not finite or of ``2 ** 40`` and more, or if its length
is not the most frequent one (ties: the longer). Repeated rows and null ids count row by row. Components whose variance is not above
1e-11 of the first one's can't be scaled to one and are not returned; so equal rows, one row or an empty table give no component.
Each component's largest entry (ties: the first) is positive. A deviation beyond 64 bits is null. Other columns pass through; a column
named as the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, OFFSET = 64, 1_000_000
MAX_COMPONENTS = 32
LARGEST = float(1 << 40)
SMALLEST_SHARE = 1e-11
#: Numbers of 64 bits that are safe to add up.
ROOM = 1 << 62
#: Rows that are worked on at once times pairs of dimensions.
CELLS = 1 << 22

SUMS = "i int, j int, n long, total decimal(38,0)"
FLOAT_SUMS = "i int, j int, total double"
WHITENED = T.StructType([T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])


def usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & sound, F.lit(False))


def usable_rows(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows with a sound vector of the most frequent length."""
    rows = embeddings.where(usable(F.col(vector)))
    sizes = rows.groupBy(F.size(vector).alias("size")).count()
    best = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size(vector) == (best["size"] if best else 0))


def whole_numbers(column: pa.Array, scale: int, offset: int) -> np.ndarray:
    """(rows, dimensions) of a column of lists of doubles that have the same length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(flat * scale)).astype(np.int64).reshape(len(column), -1) + offset


class ExactSums:
    """Sums of whole numbers per place: 64 bits while a bound allows, then Python integers."""

    def __init__(self, places: int):
        self.low, self.bound = np.zeros(places, np.int64), 0
        self.high = np.zeros(places, object)

    def add(self, sums: np.ndarray, bound: int) -> None:
        if sums.dtype == object:
            self.high = self.high + sums
            return
        if self.bound + bound >= ROOM:
            self.high, self.low, self.bound = self.high + self.low.astype(object), np.zeros_like(self.low), 0
        self.low += sums
        self.bound += bound

    def totals(self) -> list[int]:
        return [int(a) + int(b) for a, b in zip(self.low, self.high)]


def fitting(x: np.ndarray, bound: int) -> np.ndarray:
    """The numbers in 64 bits if sums below ``bound`` are safe, else as Python integers."""
    return x if bound < ROOM else x.astype(object)


def largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def sum_rows(vectors: Iterator[np.ndarray]) -> tuple[int, list[int]]:
    n, sums = 0, None
    for x in vectors:
        if len(x):
            sums = sums or ExactSums(x.shape[1])
            bound = len(x) * largest(x)
            sums.add(fitting(x, bound).sum(axis=0), bound)
            n += len(x)
    return n, sums.totals() if sums else []


def squares_of_pairs(vectors: Iterator[np.ndarray], centre: np.ndarray) -> list[int]:
    """Sums of d_i ** 2 on the diagonal and (d_i + d_j) ** 2 beside it, row by row of the upper triangle."""
    size = len(centre)
    starts = np.cumsum([0, *range(size, 0, -1)])
    sums = ExactSums(int(starts[-1]))
    step = max(1, CELLS // size)
    for x in vectors:
        for at in range(0, len(x), step):
            d = x[at : at + step] - centre
            bound = len(d) * 4 * largest(d) ** 2
            d = fitting(d, bound)
            squares = np.zeros(len(sums.low), d.dtype)
            for i in range(size):
                pair = d[:, i, None] + d[:, i:]
                pair[:, 0] = d[:, i]
                squares[starts[i] : starts[i + 1]] = (pair * pair).sum(axis=0)
            sums.add(squares, bound)
    return sums.totals()


@dataclass(frozen=True)
class Whitening:
    """What the fit has found: the rows, their sums, and the components with their variances."""

    n: int
    sums: list[int]
    components: np.ndarray  # (dimensions, components), unit columns
    variances: np.ndarray
    trace: float
    scale: int = SCALE
    offset: int = OFFSET

    @property
    def centre(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64) if self.n else np.zeros(0, np.int64)

    @property
    def rest(self) -> list[int]:
        """What the sums are above n times the centre."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.variances]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centred = (x - self.centre) - np.array(self.rest, float) / max(self.n, 1)
        return centred @ self.components / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums over the dimensions of (n * x - S) ** 2."""
        d, rest = x - self.centre, self.rest
        bound = (self.n * largest(d) + max(rest, default=0)) ** 2 * max(x.shape[1], 1)
        y = fitting(d, bound) * self.n - np.array(rest, np.int64 if bound < ROOM else object)
        return [v if v < 1 << 63 else None for v in map(int, (y * y).sum(axis=1))]


def split_covariance(n: int, sums: list[int], squares: list[int], most: int, scale: int, offset: int) -> Whitening:
    """Covariances from the variances of dimensions and of sums of two, and their largest components."""
    size = len(sums)
    rest = [s - n * (s // n) for s in sums]
    place = iter(squares)
    spread: dict[tuple[int, int], int] = {}  # n ** 2 times the variance of dimension i, or of the sum of i and j
    for i in range(size):
        for j in range(i, size):
            t = rest[i] if i == j else rest[i] + rest[j]
            spread[i, j] = n * next(place) - t * t
    matrix = np.empty((size, size))
    for (i, j), s in spread.items():
        matrix[i, j] = matrix[j, i] = s / n**2 if i == j else (s - spread[i, i] - spread[j, j]) / (2 * n**2)
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = int(np.sum(values[:most] > max(values[0], 0) * SMALLEST_SHARE)) if size else 0
    vectors = vectors[:, :kept]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    return Whitening(n, sums, vectors * signs, values[:kept].copy(), float(np.trace(matrix)), scale, offset)


def fit_whitening(
    rows: DataFrame, vector: str = "embedding", most: int = MAX_COMPONENTS, scale: int = SCALE, offset: int = OFFSET
) -> Whitening:
    """Fit on all of ``usable_rows``."""
    entries = rows.select(F.col(vector).cast("array<double>").alias("v"))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return (whole_numbers(b.column("v"), scale, offset) for b in batches if b.num_rows)

    def table(places: list[tuple[int, int]], n: int, totals: list[int]) -> pa.RecordBatch:
        i, j = zip(*places) if places else ((), ())
        values = pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0))
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([n] * len(places), pa.int64()), values]
        return pa.RecordBatch.from_arrays(columns, names=["i", "j", "n", "total"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = sum_rows(numbers(batches))
        yield table([(i, i) for i in range(len(sums))], n, sums)

    def merged(sums: DataFrame) -> list:
        added = sums.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        return sorted((r["i"], r["j"], r["n"], int(r["total"])) for r in added.collect())

    found = merged(entries.mapInArrow(first, SUMS))
    if not found:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, scale, offset)
    n, sums = found[0][2], [total for *_, total in found]
    centre = np.array([s // n for s in sums], np.int64)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [(i, j) for i in range(len(centre)) for j in range(i, len(centre))]
        totals = squares_of_pairs(numbers(batches), centre)
        if any(totals):  # a task whose rows all lie on the centre adds nothing
            yield table(places, 0, totals)

    squares = dict(((i, j), total) for i, j, _, total in merged(entries.mapInArrow(second, SUMS)))
    pairs = [squares.get((i, j), 0) for i in range(len(centre)) for j in range(i, len(centre))]
    return split_covariance(n, sums, pairs, most, scale, offset)


def whitened_rows(rows: DataFrame, fitted: Whitening, vector: str = "embedding", into: str = "whitening") -> DataFrame:
    """``usable_rows`` with a struct ``into``: the exact deviation and the whitened components."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)

    @F.arrow_udf(WHITENED)
    def projected(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fit = shared.value
        for batch in batches:
            if len(batch) == 0:
                yield pa.StructArray.from_arrays([pa.array([], pa.int64()), pa.array([], pa.list_(pa.float64()))], WHITENED.names)
                continue
            x = whole_numbers(batch, fit.scale, fit.offset)
            values = fit.whitened(x)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * values.shape[1]
            lists = pa.ListArray.from_arrays(offsets, values.ravel())
            yield pa.StructArray.from_arrays([pa.array(fit.deviations(x), pa.int64()), lists], WHITENED.names)

    return rows.withColumn(into, projected(F.col(vector).cast("array<double>")))


def identity_error(rows: DataFrame, fitted: Whitening, vector: str = "embedding") -> float:
    """Largest entry of the covariance of the whitened rows, as computed, minus the identity."""
    size = len(fitted.variances)
    if not size:
        return 0.0
    shared = rows.sparkSession.sparkContext.broadcast(fitted)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                w = fit.whitened(whole_numbers(batch.column("v"), fit.scale, fit.offset))
                total += w.T @ np.column_stack([w, np.ones(len(w))])
        i, j = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "total"])

    parts = rows.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(products, FLOAT_SUMS)
    sums = np.zeros((size, size + 1))
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        sums[r["i"], r["j"]] = r["total"]
    mean = sums[:, size] / fitted.n
    return float(np.abs(sums[:, :size] / fitted.n - np.outer(mean, mean) - np.eye(size)).max())


def whiten(
    embeddings: DataFrame, vector: str = "embedding", into: str = "whitening", most: int = MAX_COMPONENTS
) -> tuple[DataFrame, Whitening, float]:
    """The usable rows with their whitened vectors, the fit, and how far their covariance is from the identity."""
    rows = usable_rows(embeddings, vector)
    fitted = fit_whitening(rows, vector, most)
    return whitened_rows(rows, fitted, vector, into), fitted, identity_error(rows, fitted, vector)
