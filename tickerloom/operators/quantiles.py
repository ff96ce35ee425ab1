"""Exact quantiles and running totals over an order, without one task holding it all.

Split points come from an approximate quantile sketch (a few hundred numbers on the
driver). They cut the value range into buckets of similar size; totals per bucket are
small, and only the buckets that hold a wanted rank are ordered row by row. The result
does not depend on where the split points fall.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 256
# The sketch's rank error is at most 1/ACCURACY of the values.
ACCURACY = 10000
RUNNING = (Window.unboundedPreceding, Window.currentRow)


def split_points(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> list[list[float]]:
    """Strictly increasing bucket bounds per column, open at both ends."""
    shares = [i / buckets for i in range(1, buckets)]
    sketches = df.stat.approxQuantile(columns, shares, 1 / (4 * buckets))
    return [[float("-inf"), *sorted(set(points)), float("inf")] for points in sketches]


def with_buckets(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Adds `_bucket_<column>` per column; a missing value gets a bucket of its own."""
    splits = split_points(df, columns, buckets)
    names = [f"_bucket_{name}" for name in columns]
    return Bucketizer(
        inputCols=columns, outputCols=names, splitsArray=splits, handleInvalid="keep"
    ).transform(df)


def _zone(value: Column, bounds: list[tuple[Column, Column]]) -> tuple[Column, Column]:
    """The interval between bounds a value lies in, counted upwards, and whether a bracket covers it."""
    steps = [(value >= low).cast("int") + (value > high).cast("int") for low, high in bounds]
    inside = [(value >= low) & (value <= high) for low, high in bounds]
    return sum(steps[1:], steps[0]), functools.reduce(operator.or_, inside)


def quantile_profile(
    df: DataFrame,
    columns: Iterable[str],
    shares: dict[str, float],
    by: Iterable[str] = (),
    measures: Callable[[str], list[Column]] = lambda name: [],
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Exact linear-interpolated quantiles beside other aggregates: one row per (`by`, `column`).

    The first pass aggregates `measures(column)` and a mergeable sketch of every column, which gives a
    bracket around each wanted rank, 4/accuracy of the values wide. The second pass counts:
    values inside a bracket by value, all others by the interval they lie in, so that little
    leaves a task. The wanted values are read off the running counts. Without `by`, brackets are
    literals (two numbers per column and share); else they join on the group. `by` columns are not null.
    """
    columns, by = list(columns), list(by)
    slack = 2 / accuracy
    wanted = [p for share in shares.values() for p in (max(0.0, share - slack), min(1.0, share + slack))]
    points = F.array(*[F.lit(p) for p in wanted])
    value = {name: F.col(name).cast("double") for name in columns}
    records = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(value[name]).alias("_present"),
            F.percentile_approx(value[name], points, F.lit(accuracy)).alias("_bounds"),
            *measures(name),
        ).alias(f"_c{i}")
        for i, name in enumerate(columns)
    ]
    wide = df.groupBy(*by).agg(*records)
    if not by:
        # One row: the second pass then holds numbers instead of a join.
        schema = wide.schema
        wide = df.sparkSession.createDataFrame(wide.collect(), schema)
        only = wide.first()
    first = wide.select(*by, F.inline(F.array(*[F.col(f"_c{i}") for i in range(len(columns))])))

    def bounds_of(i: int) -> list[tuple[Column, Column]]:
        if by:
            listed = [F.get(F.col(f"_c{i}._bounds"), F.lit(k)) for k in range(len(wanted))]
        else:
            listed = [F.lit(b).cast("double") for b in only[f"_c{i}"]["_bounds"] or [None] * len(wanted)]
        return list(zip(listed[::2], listed[1::2]))

    entries = []
    for i, name in enumerate(columns):
        zone, inside = _zone(value[name], bounds_of(i))
        entries.append(
            F.struct(F.lit(name).alias("column"), value[name].alias("value"), zone.alias("zone"), inside.alias("inside"))
        )
    rows = df.join(wide.select(*by, *[F.col(f"_c{i}") for i in range(len(columns))]), by) if by else df
    counts = (
        rows.select(*by, F.inline(F.array(*entries)))
        .where(F.col("value").isNotNull())
        .groupBy(*by, "column", "zone", F.when(F.col("inside"), F.col("value")).alias("at"))
        .agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("largest"))
    )
    group = [*by, "column"]
    upto = Window.partitionBy(*group).orderBy("zone", "at").rowsBetween(*RUNNING)
    ranked = (
        counts.withColumn("stop", F.sum("n").over(upto))
        .withColumn("start", F.col("stop") - F.col("n"))
        .withColumn("total", F.sum("n").over(Window.partitionBy(*group)))
    )

    def at(place: Column) -> Column:
        # Between brackets only the ends are known, and only they can be next to a wanted rank.
        end = F.when(F.col("start") == place, F.col("least")).when(F.col("stop") - 1 == place, F.col("largest"))
        return F.max(F.when((F.col("start") <= place) & (place < F.col("stop")), F.coalesce("at", end)))

    found = []
    for name, share in shares.items():
        position = (F.col("total") - 1) * F.lit(share)
        low, high = at(F.floor(position)), at(F.ceil(position))
        fraction = F.max(position - F.floor(position))
        found.append((low + (high - low) * fraction).alias(name))
    return first.drop("_bounds").join(ranked.groupBy(*group).agg(*found), group, "left")


def exact_quantiles(
    df: DataFrame, columns: Iterable[str], shares: dict[str, float], by: Iterable[str] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """Linear-interpolated quantiles of the columns that have values: one row per (`by`, `column`).

    `shares` maps result names to shares, e.g. {"median": 0.5}.
    """
    return quantile_profile(df, columns, shares, by, accuracy=accuracy).where("_present > 0").drop("_present")
