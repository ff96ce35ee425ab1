"""Counts, moments and cross products of many columns in one pass over the rows.

A task keeps the rows of a batch as a matrix of values beside a matrix of their presence; products of the
two hold, for every pair of columns, the number, sums, squares and cross product of the
rows that have both. Batches, and then tasks, are merged by the formulas for two samples' moments, which
work on differences of means and lose no digits to large values. A pass costs one product
per batch whatever the number of columns, and no generated code grows with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickerloom.session import ship_package

# A sum of squares below this share of what centring took off is rounding, not spread.
ROUNDING = 1e-13
PAIR_FIELDS = ("n", "mean_x", "mean_y", "xx", "yy", "xy")
COLUMN_FIELDS = ("rows", "n", "infinite", "mean", "squares", "least", "largest")


def _values(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """The batch's columns as doubles, one row per record; a missing value is a mask's zero (see `_presence`)."""
    return np.column_stack([batch.column(n).fill_null(0.0).to_numpy(zero_copy_only=False) for n in names])


def _presence(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(n).is_valid().to_numpy(zero_copy_only=False) for n in names])


def _centred(x: np.ndarray, present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values less a centre of their column, 0 where missing, and the centres. A constant column becomes exact zeros."""
    count = present.sum(axis=0)
    first = x[present.argmax(axis=0), np.arange(x.shape[1])]
    y = np.where(present, x - first, 0.0)
    rest = y.sum(axis=0) / np.maximum(count, 1)
    return np.where(present, y - rest, 0.0), first + rest


def merge_moments(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Moments of two samples together: means by counts, products with the shift between the means."""
    n = a["n"] + b["n"]
    whole = np.maximum(n, 1)
    dx = np.where(a["n"] * b["n"] > 0, b["mean_x"] - a["mean_x"], 0.0)
    dy = np.where(a["n"] * b["n"] > 0, b["mean_y"] - a["mean_y"], 0.0)
    shift = a["n"] * b["n"] / whole
    return {
        "n": n,
        "mean_x": np.where(a["n"] > 0, a["mean_x"] + dx * b["n"] / whole, b["mean_x"]),
        "mean_y": np.where(a["n"] > 0, a["mean_y"] + dy * b["n"] / whole, b["mean_y"]),
        "xx": a["xx"] + b["xx"] + shift * dx * dx,
        "yy": a["yy"] + b["yy"] + shift * dy * dy,
        "xy": a["xy"] + b["xy"] + shift * dx * dy,
    }


def pair_products(x: np.ndarray, px: np.ndarray, y: np.ndarray, py: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of every pair (column of x, column of y) over the rows that have both."""
    zx, cx = _centred(x, px)
    zy, cy = _centred(y, py)
    mx, my = px.astype(float), py.astype(float)
    n = mx.T @ my
    whole = np.maximum(n, 1)
    sx, sy = zx.T @ my, mx.T @ zy
    raw_x, raw_y = (zx * zx).T @ my, mx.T @ (zy * zy)
    xx, yy = raw_x - sx * sx / whole, raw_y - sy * sy / whole
    return {
        "n": n,
        "mean_x": cx[:, None] + sx / whole,
        "mean_y": cy[None, :] + sy / whole,
        "xx": np.where(xx > ROUNDING * raw_x, xx, 0.0),
        "yy": np.where(yy > ROUNDING * raw_y, yy, 0.0),
        "xy": zx.T @ zy - sx * sy / whole,
    }


def _merged_rows(fields: tuple[str, ...], key: str, merge: Callable) -> Callable:
    """Merges rows of equal key, which follow one another; one is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, None
        done: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                own = {f: np.array(row[f], dtype=float) for f in fields}
                if row[key] == current:
                    held = merge(held, own)
                    continue
                if held is not None:
                    done.append((current, held))
                current, held = row[key], own
        if held is not None:
            done.append((current, held))
        arrays = [pa.array([k for k, _ in done], pa.int32())]
        arrays += [pa.array([v[f].tolist() for _, v in done], pa.list_(pa.float64())) for f in fields]
        yield pa.RecordBatch.from_arrays(arrays, names=[key, *fields])

    return run


def _by_key(parts: DataFrame, key: str, n_keys: int, fields: tuple[str, ...], merge: Callable, schema: str) -> DataFrame:
    return parts.repartition(min(n_keys, 200), key).sortWithinPartitions(key).mapInArrow(_merged_rows(fields, key, merge), schema)


def pair_moments(df: DataFrame, left: Iterable[str], right: Iterable[str]) -> DataFrame:
    """One row (left, right, n, mean_x, mean_y, xx, yy, xy) per pair of numeric columns; products are about the means."""
    left, right = list(left), list(right)
    both = list(dict.fromkeys([*left, *right]))
    if not left or not right:
        return df.sparkSession.createDataFrame([], "left string, right string, n double, mean_x double, mean_y double, xx double, yy double, xy double")
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                own = pair_products(_values(batch, left), _presence(batch, left), _values(batch, right), _presence(batch, right))
                held = own if held is None else merge_moments(held, own)
        if held is not None:
            arrays = [pa.array(range(len(left)), pa.int32())]
            arrays += [pa.array(held[f].tolist(), pa.list_(pa.float64())) for f in PAIR_FIELDS]
            yield pa.RecordBatch.from_arrays(arrays, names=["place", *PAIR_FIELDS])

    schema = "place int, " + ", ".join(f"{f} array<double>" for f in PAIR_FIELDS)
    parts = df.select(*[F.col(name).cast("double").alias(name) for name in both]).mapInArrow(run, schema)
    merged = _by_key(parts, "place", len(left), PAIR_FIELDS, merge_moments, schema)
    zipped = F.arrays_zip(F.array(*[F.lit(n) for n in right]).alias("right"), *PAIR_FIELDS)
    rows = merged.select(F.get(F.array(*[F.lit(n) for n in left]), F.col("place")).alias("left"), F.inline(zipped))
    return rows.toDF("left", "right", *PAIR_FIELDS)


def correlations(df: DataFrame, left: Iterable[str], right: Iterable[str]) -> DataFrame:
    """(left, right, correlation) over pairwise present rows; null without spread."""
    moments = pair_moments(df, left, right)

    def spread(squares: str, mean: str):
        return (F.col(squares) > 0) & (F.sqrt(F.col(squares) / F.col("n")) > ROUNDING * F.abs(mean))

    has_spread = spread("xx", "mean_x") & spread("yy", "mean_y")
    return moments.select("left", "right", F.when(has_spread, F.col("xy") / (F.sqrt("xx") * F.sqrt("yy"))).alias("correlation"))


def merge_columns(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    n = a["n"] + b["n"]
    whole = np.maximum(n, 1)
    with np.errstate(invalid="ignore"):
        step = np.where(a["n"] * b["n"] > 0, b["mean"] - a["mean"], 0.0)
        mean = np.where(a["n"] > 0, a["mean"] + step * b["n"] / whole, b["mean"])
        squares = a["squares"] + b["squares"] + step * step * a["n"] * b["n"] / whole
    return {
        "rows": a["rows"] + b["rows"],
        "n": n,
        "infinite": a["infinite"] + b["infinite"],
        "mean": mean,
        "squares": squares,
        "least": np.fmin(a["least"], b["least"]),
        "largest": np.maximum(a["largest"], b["largest"]),
    }


def column_sums(x: np.ndarray, present: np.ndarray) -> dict[str, np.ndarray]:
    n = present.sum(axis=0).astype(float)
    with np.errstate(invalid="ignore"):
        z, centre = _centred(x, present)
        squares = (z * z).sum(axis=0)
    nothing = n == 0
    return {
        "rows": np.full(x.shape[1], float(len(x))),
        "n": n,
        "infinite": (np.isinf(x) & present).sum(axis=0).astype(float),
        "mean": np.where(nothing, 0.0, centre),
        "squares": squares,
        # Not a number is larger than all numbers, as in an ORDER BY.
        "least": np.fmin.reduce(np.where(present, x, np.inf), axis=0, initial=np.inf),
        "largest": np.where(present, x, -np.inf).max(axis=0, initial=-np.inf),
    }


def column_moments(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row per column: `column`, `rows`, `count` of present values, `infinite_count`, `mean`, `std`, `min`, `max`.

    Columns that are not numbers are only counted; their moments are null, as are those of a column without values.
    """
    columns = list(columns)
    kinds = dict(df.dtypes)
    numeric = {n for n in columns if kinds[n].split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")}
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                own = column_sums(_values(batch, columns), _presence(batch, columns))
                held = own if held is None else merge_columns(held, own)
        if held is not None:
            rows = [[held[f][i] for f in COLUMN_FIELDS] for i in range(len(columns))]
            arrays = [pa.array(range(len(columns)), pa.int32())]
            arrays += [pa.array([[row[k]] for row in rows], pa.list_(pa.float64())) for k in range(len(COLUMN_FIELDS))]
            yield pa.RecordBatch.from_arrays(arrays, names=["place", *COLUMN_FIELDS])

    schema = "place int, " + ", ".join(f"{f} array<double>" for f in COLUMN_FIELDS)
    narrow = [
        F.col(n).cast("double").alias(n) if n in numeric else F.when(F.col(n).isNotNull(), F.lit(0.0)).alias(n) for n in columns
    ]
    merged = _by_key(df.select(*narrow).mapInArrow(run, schema), "place", len(columns), COLUMN_FIELDS, merge_columns, schema)
    # An empty table has a row per column too.
    names = df.sparkSession.createDataFrame(
        [(i, n, n in numeric) for i, n in enumerate(columns)], "place int, column string, is_numeric boolean"
    )
    at = lambda f: F.get(f, F.lit(0))
    counted = lambda f: F.coalesce(at(f), F.lit(0.0)).cast("long")
    some = F.col("is_numeric") & (at("n") > 0)
    return names.join(merged, "place", "left").select(
        "column",
        counted("rows").alias("rows"),
        counted("n").alias("count"),
        F.when(F.col("is_numeric"), counted("infinite")).otherwise(0).alias("infinite_count"),
        F.when(some, at("mean")).alias("mean"),
        F.when(some & (at("n") > 1), F.sqrt(at("squares") / (at("n") - 1))).alias("std"),
        F.when(some, at("least")).alias("min"),
        F.when(some, at("largest")).alias("max"),
    )
