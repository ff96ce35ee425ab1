"""Temporal splits, time folds and scaling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from tickerloom.operators import ordered

SPLITS = ("train", "val", "test")


def date_cuts(df: DataFrame, train: float = 0.7, val: float = 0.15) -> tuple:
    """Last train date and last validation date by position in the distinct dates."""
    # The distinct dates are as many as the calendar has; so is this ordering.
    dates = df.select("date").distinct()
    count = dates.agg(F.count("*")).scalar()
    numbered = dates.select(
        "date",
        F.row_number().over(Window.orderBy("date")).alias("n"),
        F.floor(count * F.lit(train)).alias("train_n"),
        F.floor(count * F.lit(train + val)).alias("val_n"),
    )
    cuts = numbered.agg(
        F.max(F.when(F.col("n") == F.col("train_n"), F.col("date"))).alias("train_end"),
        F.max(F.when(F.col("n") == F.col("val_n"), F.col("date"))).alias("val_end"),
    ).first()
    return cuts["train_end"], cuts["val_end"]


def split_by_date(df: DataFrame, train: float = 0.7, val: float = 0.15) -> dict[str, DataFrame]:
    """Train, validation and test by distinct dates; plain date filters, so scans prune."""
    train_end, val_end = date_cuts(df, train, val)
    date = F.col("date")
    return {
        "train": df.where(date <= F.lit(train_end)),
        "val": df.where((date > F.lit(train_end)) & (date <= F.lit(val_end))),
        "test": df.where(date > F.lit(val_end)),
    }


def with_row_split(df: DataFrame, train: float = 0.7, until_val: float = 0.85) -> DataFrame:
    """Adds `split` by row position in (date, ticker) order."""
    ranked = ordered.row_rank(df)
    rank, rows = F.col("_rank"), F.col("_rows")
    name = (
        F.when(rank < F.floor(rows * F.lit(train)), "train")
        .when(rank < F.floor(rows * F.lit(until_val)), "val")
        .otherwise("test")
    )
    return ranked.withColumn("split", name).drop("_rank", "_rows")


def with_tail_split(df: DataFrame, share: float = 0.2) -> DataFrame:
    """Adds `is_validation` for the last `share` of the rows in (date, ticker) order."""
    ranked = ordered.row_rank(df)
    cut = F.floor(F.col("_rows") * F.lit(1 - share))
    return ranked.withColumn("is_validation", F.col("_rank") >= cut).drop("_rank", "_rows")


def with_time_blocks(df: DataFrame, folds: int = 5) -> DataFrame:
    """Adds `block`: rows in (date, ticker) order cut into folds + 1 equal blocks.

    Fold i trains on the blocks up to i and tests on block i + 1; rows beyond the last
    full block get a null block.
    """
    ranked = ordered.row_rank(df)
    size = F.floor(F.col("_rows") / (folds + 1))
    block = F.floor(F.col("_rank") / size).cast("int")
    return ranked.withColumn("block", F.when(block <= folds, block)).drop("_rank", "_rows")


def time_folds(blocked: DataFrame, folds: int = 5) -> DataFrame:
    """Row counts and date ranges of every expanding fold."""
    roles = F.flatten(
        F.array(
            *[
                F.array(
                    F.struct(
                        F.lit(i).alias("fold"),
                        F.when(F.col("block") <= i, "train").when(F.col("block") == i + 1, "test").alias("role"),
                    )
                )
                for i in range(folds)
            ]
        )
    )
    per_block = blocked.groupBy("block").agg(
        F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    return (
        per_block.select("n", "first", "last", F.col("block"), F.inline(roles))
        .where(F.col("role").isNotNull())
        .groupBy("fold", "role")
        .agg(F.sum("n").alias("rows"), F.min("first").alias("first_date"), F.max("last").alias("last_date"))
    )


def scaling_statistics(df: DataFrame, columns: Iterable[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, missing taken as 0; no spread gives 1."""
    columns = list(columns)
    filled = {name: F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in columns}
    row = df.agg(
        *[
            F.struct(F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation")).alias(name)
            for name, value in filled.items()
        ]
    ).first()
    return {name: (row[name]["mean"], row[name]["deviation"] or 1.0) for name in columns}


def scaled(df: DataFrame, statistics: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """(x - mean)/deviation with given statistics; a suffix keeps the raw columns."""
    return df.withColumns(
        {
            name + suffix: (F.coalesce(F.col(name).cast("double"), F.lit(0.0)) - mean) / deviation
            for name, (mean, deviation) in statistics.items()
        }
    )


def scale_features(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Adds `<column>_scaled`, standardised by the table's own statistics."""
    return scaled(df, scaling_statistics(df, columns), "_scaled")


def scale_splits(splits: dict[str, DataFrame], columns: Iterable[str]) -> dict[str, DataFrame]:
    """All splits standardised by the train split's statistics."""
    statistics = scaling_statistics(splits["train"], columns)
    return {name: scaled(df, statistics) for name, df in splits.items()}


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n/(k * n_c) per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    return counts.select(label, F.col("n").alias("count"), (total / (classes * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Adds the balanced weight of the row's class.

    The weights (one per class) are a map from a scalar subquery: a join on the label
    would shuffle every row to as many tasks as there are classes.
    """
    weights = class_weights(df, label)
    mapped = weights.agg(F.map_from_entries(F.collect_list(F.struct(label, "weight")))).scalar()
    return df.withColumn(name, F.element_at(mapped, F.col(label)))


def with_stratified_fold(df: DataFrame, label: str, keys: Iterable[str], folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds `fold`: every class spread evenly and at random over the folds.

    Rows are dealt within hash buckets of a class, so no task orders a whole class; fold
    sizes per class differ by at most one row per bucket.
    """
    order = F.md5(F.concat_ws("|", *[F.col(key).cast("string") for key in keys], F.lit(str(seed))).cast("binary"))
    bucket = F.conv(F.substring(order, 1, 3), 16, 10).cast("int")
    dealt = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_order", *keys))
    return (
        df.withColumns({"_order": order, "_bucket": bucket})
        .withColumn("fold", F.pmod(dealt + F.col("_bucket"), F.lit(folds)).cast("int"))
        .drop("_order", "_bucket")
    )
