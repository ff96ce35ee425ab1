"""Cleaning: keyed de-duplication, validity and outlier filters, fills, news cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from tickerloom.functions import calendar, fixed_values as fixed, text
from tickerloom.functions.numeric import count_true, infinite_to_null


def keep_first(df: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """One row per key, the first by `order`.

    An aggregate, not a window: map tasks reduce copies before the shuffle, so a key
    holding any share of the rows costs one row per map task. Null keys are equal.
    """
    keys = list(keys)
    rest = [name for name in df.columns if name not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    return df.groupBy(*keys).agg(first).select(*[F.col(k) if k in keys else F.col(f"first.{k}") for k in df.columns])


def drop_missing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def valid_bars(df: DataFrame) -> DataFrame:
    """Close and volume present, close above zero, volume not negative."""
    return drop_missing(df, ["close", "volume"]).where((F.col("close") > 0) & (F.col("volume") >= 0))


def positive_prices(df: DataFrame) -> DataFrame:
    """Drop rows with any price at or below zero; a missing price does not drop a row."""
    bad = [F.coalesce(F.col(name) <= 0, F.lit(False)) for name in ("open", "high", "low", "close")]
    return df.where(~(bad[0] | bad[1] | bad[2] | bad[3]))


def within_sigma(df: DataFrame, column: str = "daily_return", sigmas: float = 3.0) -> DataFrame:
    """Rows within mean +- sigmas sample deviations over the whole table; missing dropped.

    The bounds are one scalar subquery: a partial aggregate and a single filter, no join.
    """
    mean, deviation = F.avg(column), F.stddev_samp(column)
    bounds = df.agg(
        F.struct((mean - sigmas * deviation).alias("low"), (mean + sigmas * deviation).alias("high")).alias("b")
    ).scalar()
    return df.where(F.col(column).between(bounds["low"], bounds["high"]))


def clean_and_validate(df: DataFrame) -> DataFrame:
    """Validity and, where `daily_return` exists, the 3-sigma filter. Sort at the sink."""
    valid = valid_bars(df)
    return within_sigma(valid) if "daily_return" in df.columns else valid


def removed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts around a cleaning step and the share removed."""
    kept = after.agg(F.count("*")).scalar()
    return before.agg(F.count("*").alias("rows_before")).select(
        "rows_before",
        kept.alias("rows_after"),
        (F.col("rows_before") - kept).alias("rows_removed"),
        F.try_divide(F.col("rows_before") - kept, F.col("rows_before")).alias("removed_share"),
    )


def long_enough(df: DataFrame, headline: int = 10, content: int = 20) -> DataFrame:
    return df.where((F.length("headline") > headline) & (F.length("content") > content))


def trading_days(df: DataFrame, date: str = "date") -> DataFrame:
    return df.where(calendar.is_weekday(F.col(date)))


def few_missing(df: DataFrame, features: Iterable[str], share: float = 0.5) -> DataFrame:
    """Rows with fewer missing features than `share` of them."""
    features = list(features)
    missing = count_true([F.col(name).isNull() for name in features])
    return df.where(missing < share * len(features))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill missing values of existing columns; add columns that are absent."""
    filled = df.na.fill({name: value for name, value in defaults.items() if name in df.columns})
    absent = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return filled.withColumns(absent) if absent else filled


def finite_or_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Infinite, NaN and missing values become 0."""
    return df.withColumns({name: F.coalesce(infinite_to_null(F.col(name)), F.lit(0.0)) for name in columns})


def fill_unknown(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.na.fill("unknown", subset=list(columns))


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, StringType)]


def columns_with(names: Iterable[str], keywords: Iterable[str]) -> list[str]:
    keywords = tuple(keywords)
    return [name for name in names if any(word in name.lower() for word in keywords)]


def sentiment_columns(df: DataFrame) -> list[str]:
    return columns_with(df.columns, fixed.SENTIMENT_KEYWORDS)


# Columns that look ahead or identify a row; never model inputs.
ROW_IDS = ("ticker", "date", "timestamp", "trading_date")
FORWARD_PREFIXES = ("target_", "future_", "next_")


def target_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name.startswith(("target_", "future_"))]


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns that neither identify a row nor look ahead."""
    return [
        name for name in numeric_columns(df) if name not in ROW_IDS and not name.startswith(FORWARD_PREFIXES)
    ]


def in_tickers(df: DataFrame, tickers: Iterable[str]) -> DataFrame:
    return df.where(F.col("ticker").isin(list(tickers)))


def clean_news(news: DataFrame, order: Iterable[str]) -> DataFrame:
    """De-duplicate by (headline, content), strip wire prefixes, drop short and undated.

    `order` names the ingest order that decides which copy stays. Sort at the sink.
    """
    first = keep_first(news, ["headline", "content"], order)
    timestamp: Column = F.col("timestamp")
    if isinstance(news.schema["timestamp"].dataType, StringType):
        timestamp = calendar.parse_feed_time(timestamp)
    cleaned = first.withColumns(
        {
            "headline": text.strip(text.remove_headline_prefixes(F.col("headline"))),
            "content": text.strip(F.col("content")),
            "timestamp": timestamp,
        }
    )
    return drop_missing(long_enough(cleaned), ["timestamp"])
