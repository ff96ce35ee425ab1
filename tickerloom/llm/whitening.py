"""Embedding whitening: principal components of all vectors, with unit variance each.

Entries become integers, so sums and products of the distributed covariance are exact: each
task multiplies its vectors, centred on the rounded mean, and Spark adds the tasks' products by
matrix entry. The driver holds one matrix of the vectors' dimension; `refined_eigenvectors`
starts from its float32 eigenvectors and corrects them in higher precision. The input is read
four times (sums, products, check of the result, result); store a costly one first.

Defined cases: a vector that is null, empty, or holds a null or non-finite entry is dropped,
also one whose length is not the most frequent (ties: the longest); null ids stay; repeated rows
count each; other columns are ignored; an empty table gives no row. A component without variance
(e at most 2^-50 of the largest) has whitened 0 and takes no part in the identity error. Entries
beyond 2^40, or deviations beyond a long, end in an OverflowError.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.llm.common import ship
from tickerloom.llm.eigen_refine import HIGH, refined_eigenvectors

SCALE = 64
OFFSET = 1_000_000
BATCH_ROWS = 4096
LARGEST = 2.0**40
NO_VARIANCE = 2.0**-50


def as_integers(entries: np.ndarray) -> np.ndarray:
    if len(entries) and np.abs(entries).max() > LARGEST:
        raise OverflowError(f"embedding entries beyond {LARGEST:.0f}")
    return np.floor(SCALE * entries).astype(np.int64) + OFFSET


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return as_integers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension))


def usable(column: str) -> Column:
    """Whether a vector holds finite numbers only, and some."""
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce((F.size(column) > 0) & finite, F.lit(False))


def entry_sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """The vectors' dimension, their number and the sum of every entry; (0, 0, []) without vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            column = batch.column("vector")
            lengths = pc.list_value_length(column)
            for length in pc.unique(lengths).to_pylist():
                x = _matrix(column.filter(pc.equal(lengths, length)), length)
                held = totals.setdefault(length, [0, np.zeros(length, dtype=object)])
                held[0] += len(x)
                held[1] = held[1] + x.sum(axis=0).astype(object)
        rows = [(length, i, n, str(total)) for length, (n, sums) in totals.items() for i, total in enumerate(sums)]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["length", "entry", "n", "total"]
        )

    parts = vectors.select("vector").mapInArrow(run, "length int, entry int, n long, total string")
    sums = parts.groupBy("length", "entry").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    lengths = sums.groupBy("length").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("entry", "total"))).alias("sums"))
    best = lengths.orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    if not best:
        return 0, 0, []
    return best[0]["length"], best[0]["n"], [int(row["total"]) for row in best[0]["sums"]]


@dataclass(frozen=True)
class Centre:
    """Rounded means to take off first, and what is left of the sums then: sum(x - middle) = rest, |rest| <= n/2."""

    n: int
    middle: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        middle = [(2 * s + n) // (2 * n) for s in sums]
        return cls(n, np.array(middle, dtype=np.int64), np.array([s - n * m for s, m in zip(sums, middle)], dtype=np.int64))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, as doubles where all fit exactly, else as Python integers."""
        y = x - self.middle
        if float(np.abs(y).max(initial=0) + 1) * self.n < 2.0**53:
            return y * self.n - self.rest
        return y.astype(object) * self.n - self.rest.astype(object)


def exact_product(y: np.ndarray) -> np.ndarray:
    """y'y of integers, by float64 products as long as no sum can round."""
    largest = float(np.abs(y).max(initial=0)) ** 2 * len(y)
    if largest < 2.0**53:
        z = y.astype(np.float64)
        return (z.T @ z).astype(np.int64)
    if largest < 2.0**62:
        return y.T @ y
    raise OverflowError("products of embedding entries beyond a long")


def _entry_rows(values: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    i, j = np.triu_indices(len(values))
    return pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values[i, j], kind)], names=["i", "j", "value"]
    )


def covariance(vectors: DataFrame, centre: Centre) -> np.ndarray:
    """The exact covariance over all vectors (divisor n), rounded once to longdouble."""
    size = len(centre.middle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bound = np.zeros((size, size), dtype=np.int64), 0.0
        for batch in batches:
            x = _matrix(batch.column("vector"), size)
            for at in range(0, len(x), BATCH_ROWS):
                y = x[at : at + BATCH_ROWS] - centre.middle
                product = exact_product(y)
                largest = float(np.trace(product))
                if bound + largest > 2.0**62:
                    yield _entry_rows(held, pa.int64())
                    held, bound = np.zeros_like(held), 0.0
                held, bound = held + product, bound + largest
        yield _entry_rows(held, pa.int64())

    parts = vectors.select("vector").mapInArrow(run, "i int, j int, value long")
    # One row per task and entry; the sums per entry are what comes to the driver.
    total = parts.groupBy("i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    result = np.zeros((size, size), dtype=HIGH)
    rest = [int(r) for r in centre.rest]
    square = HIGH(centre.n) * HIGH(centre.n)
    for row in total.collect():
        i, j = row["i"], row["j"]
        result[i, j] = result[j, i] = HIGH(centre.n * int(row["value"]) - rest[i] * rest[j]) / square
    return result


@dataclass(frozen=True)
class Whitener:
    centre: Centre
    explained: list[float]
    projection: np.ndarray

    @classmethod
    def of(cls, centre: Centre, matrix: np.ndarray, components: int) -> Whitener:
        values, basis = refined_eigenvectors(matrix)
        top = range(min(components, len(values)))
        has_variance = [bool(values[k] > 0 and values[k] > NO_VARIANCE * values[0]) for k in top]
        trace = np.trace(matrix)
        scaled = []
        for k in top:
            vector = basis[:, k]
            # The sign is free; the largest entry is positive.
            vector = vector * np.sign(vector[np.abs(vector).argmax()])
            scaled.append(vector / np.sqrt(values[k]) if has_variance[k] else vector * 0)
        explained = [float(values[k] / trace) if has_variance[k] else 0.0 for k in top]
        return cls(centre, explained, np.array(scaled, dtype=HIGH).T.astype(np.float64))

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.centre.n).astype(np.float64) @ self.projection


def identity_error(vectors: DataFrame, whitener: Whitener) -> float:
    """The largest entry of |covariance - identity| of the whitened vectors themselves, over all of them."""
    size = len(whitener.centre.middle)
    width = len(whitener.explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A last row and column of ones carries the sums beside the products.
        held = np.zeros((width + 1, width + 1))
        for batch in batches:
            x = _matrix(batch.column("vector"), size)
            for at in range(0, len(x), BATCH_ROWS):
                z = whitener.whitened(whitener.centre.deviations(x[at : at + BATCH_ROWS]))
                z = np.column_stack([z, np.ones(len(z))])
                held += z.T @ z
        yield _entry_rows(held, pa.float64())

    parts = vectors.select("vector").mapInArrow(run, "i int, j int, value double")
    totals = {(r["i"], r["j"]): r["value"] for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    n = whitener.centre.n
    mean = [totals[i, width] / n for i in range(width)]
    errors = [
        abs(value / n - mean[i] * mean[j] - (i == j))
        for (i, j), value in totals.items()
        if j < width and whitener.explained[i] > 0 and whitener.explained[j] > 0
    ]
    return float(max(errors, default=0.0))


def whiten(embeddings: DataFrame, column: str = "embedding", components: int = 32) -> DataFrame:
    """One row per usable vector: vec_id, n, deviation, `whitened` and `explained` (arrays by component), identity_error."""
    ship(embeddings.sparkSession)
    vectors = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector")
    ).where(usable("vector"))
    size, n, sums = entry_sums(vectors)
    schema = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if not n:
        return embeddings.sparkSession.createDataFrame([], schema)
    vectors = vectors.where(F.size("vector") == size)
    centre = Centre.of(n, sums)
    whitener = Whitener.of(centre, covariance(vectors, centre), components)
    error = identity_error(vectors, whitener)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), size)
            for at in range(0, len(x), BATCH_ROWS):
                deviations = centre.deviations(x[at : at + BATCH_ROWS])
                if float(np.abs(deviations).max(initial=0)) ** 2 * size < 2.0**62:
                    squares = (deviations * deviations).sum(axis=1)
                else:
                    squares = (deviations.astype(object) ** 2).sum(axis=1)
                z = whitener.whitened(deviations)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").slice(at, len(z)),
                        pa.array(squares, pa.int64()),
                        pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], z.ravel()),
                    ],
                    names=["vec_id", "deviation", "whitened"],
                )

    result = vectors.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")
    return result.select(
        "vec_id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(e) for e in whitener.explained]).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def by_component(whitened: DataFrame) -> DataFrame:
    """Rows of `whiten` dealt out: one per vector and component, numbered from 1."""
    return whitened.select(
        "vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "value")
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("value").alias("whitened"),
        F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
    )
