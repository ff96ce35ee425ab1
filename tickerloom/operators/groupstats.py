"""Statistics of a row's (ticker, day) group written back to the row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.functions.numeric import sample_skewness
from tickerloom.operators.quantiles import exact_quantiles

STATISTICS = ("mean", "median", "std", "min", "max", "skew")


def group_statistics(df: DataFrame, columns: Iterable[str], by: Iterable[str]) -> DataFrame:
    """Mean, median, deviation, extremes and skewness of every column per group.

    The moments come from one partial aggregate, the medians from bucketed ranks, so
    no group is held by one task.
    """
    columns, by = list(columns), list(by)
    measures: list[Column] = []
    for name in columns:
        measures += [
            F.avg(name).alias(f"{name}_mean"),
            F.stddev_samp(name).alias(f"{name}_std"),
            F.min(name).alias(f"{name}_min"),
            F.max(name).alias(f"{name}_max"),
            sample_skewness(name).alias(f"{name}_skew"),
        ]
    moments = df.groupBy(*by).agg(*measures)
    medians = exact_quantiles(df, columns, {"median": 0.5}, by)
    wide = medians.groupBy(*by).agg(
        *[F.max(F.when(F.col("column") == name, F.col("median"))).alias(f"{name}_median") for name in columns]
    )
    joined = moments.join(wide, by, "left")
    return joined.select(*by, *[f"{name}_{kind}" for name in columns for kind in STATISTICS])


def sentiment_group_features(
    df: DataFrame, columns: Iterable[str], by: Iterable[str] | None = None, one_row_per_group: bool = False
) -> DataFrame:
    """Adds `<column>_<statistic>` of the row's group to every row.

    A panel has one row per (ticker, day). `one_row_per_group` says so and spares the
    shuffles: every statistic of a single value is the value, spread is missing.
    """
    columns = list(columns)
    if by is None:
        by = ["ticker", "trading_date" if "trading_date" in df.columns else "date"]
    if one_row_per_group:
        added: dict[str, Column] = {}
        for name in columns:
            for kind in STATISTICS:
                spread = kind in ("std", "skew")
                added[f"{name}_{kind}"] = F.lit(None).cast("double") if spread else F.col(name).cast("double")
        return df.withColumns(added)
    return df.join(group_statistics(df, columns, by), list(by), "left")
