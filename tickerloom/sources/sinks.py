"""Sinks: Parquet or CSV tables, the six split tables and JSON metadata."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickerloom.operators import profile, technical


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}.manifest"


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    skip_empty: bool = False,
    order: tuple[str, ...] = (),
) -> bool:
    """Write a table; with `skip_empty` an empty one is left out. Says whether it wrote.

    With `order` the table is clustered: rows are dealt into ranges of the order, as many as its bytes need
    (adaptive execution joins small ones), sorted within files, and a manifest beside the
    table lists every file with its rows and its first and last key. Files are then in order
    one after the other, which is what sorted output needs at any size.
    """
    if skip_empty and df.isEmpty():
        return False
    clustered = df.repartitionByRange(*[F.asc_nulls_first(name) for name in order]).sortWithinPartitions(*order) if order else df
    writer = clustered.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("escape", '"').csv(path, header=True)
    else:
        writer.format(fmt).save(path)
    if order and fmt == "parquet":
        key = F.struct(*order)
        back = df.sparkSession.read.schema(df.schema).parquet(path)
        files = back.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))
        files.coalesce(1).write.mode("overwrite").parquet(manifest_path(path))
    return True


def write_news(news: DataFrame, folder: str, name: str = "combined_news") -> bool:
    """Articles in the order of their time; an empty table is left out."""
    return write_table(news, f"{folder}/{name}.parquet", skip_empty=True, order=("timestamp",) if "timestamp" in news.columns else ())


def write_bars(bars: DataFrame, folder: str) -> bool:
    """Bars by ticker, so a ticker filter prunes folders, in date order, with a summary row per ticker."""
    if not write_table(bars, f"{folder}/stock_prices.parquet", partition_by=("ticker",), skip_empty=True, order=("ticker", "date")):
        return False
    stored = bars.sparkSession.read.schema(bars.schema).parquet(f"{folder}/stock_prices.parquet")
    priced = stored if "daily_return" in bars.columns else stored.withColumn("daily_return", technical.simple_return())
    return write_table(profile.price_summary(priced), f"{folder}/price_summary.parquet", order=("ticker",))


def write_panel(panel: DataFrame, path: str) -> bool:
    return write_table(panel, path, order=("ticker", "date"))


def write_metadata(spark: SparkSession, values: Mapping[str, Any], path: str) -> None:
    """A small mapping as a one-record JSON table."""
    spark.createDataFrame([(json.dumps(dict(values)),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_splits(
    raw: Mapping[str, DataFrame], scaled: Mapping[str, DataFrame], folder: str, metadata: Mapping[str, Any]
) -> None:
    for kind, parts in (("raw", raw), ("scaled", scaled)):
        for part, df in parts.items():
            write_table(df, f"{folder}/{part}_data_{kind}.parquet", order=("date", "ticker"))
    any_part = next(iter(raw.values()))
    write_metadata(any_part.sparkSession, metadata, f"{folder}/metadata.json")
