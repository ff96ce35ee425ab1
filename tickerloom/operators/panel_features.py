"""Calendar, interaction, target and text-length features; the whole feature set."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.functions import calendar, fixed_values as fixed
from tickerloom.functions.numeric import direction, five_bins, flag, rolling, three_classes
from tickerloom.functions.text import length_or_zero, text_statistics
from tickerloom.operators import cleaning, groupstats, technical


def temporal_features(panel: DataFrame, date: str = "date") -> DataFrame:
    """Calendar parts, flags, cycles and days since the first date of the table."""
    day = F.col(date)
    start = panel.agg(F.min(date)).scalar()
    return panel.withColumns(
        {
            **calendar.calendar_parts(day),
            **calendar.calendar_flags(day),
            **calendar.cyclical_parts(day),
            "days_since_start": F.date_diff(day, start),
        }
    )


def market_calendar_features(bars: DataFrame, zone: str = fixed.MARKET_TIMEZONE) -> DataFrame:
    """Calendar columns of the bar's instant (midnight UTC for a date) in market time."""
    local = calendar.market_time(F.col("date").cast("timestamp"), zone)
    day = F.to_date(local)
    flags = calendar.calendar_flags(day)
    return bars.withColumns(
        {
            "date_local": local,
            "day_of_week": F.weekday(day),
            "is_monday": flags["is_monday"],
            "is_friday": flags["is_friday"],
            "month": F.month(day),
            "quarter": F.quarter(day),
            "is_month_end": flags["is_month_end"],
            "is_month_start": flags["is_month_start"],
        }
    )


def interaction_features(panel: DataFrame) -> DataFrame:
    """Sentiment against volume, volatility and market regime, and sentiment strength."""
    have = set(panel.columns)
    added: dict[str, Column] = {}
    composite = F.col("composite_sentiment")
    if {"composite_sentiment", "volume_ratio"} <= have:
        added["sentiment_volume_interaction"] = composite * F.col("volume_ratio")
    if {"composite_sentiment", "volatility_5d"} <= have:
        added["sentiment_volatility_interaction"] = composite * F.col("volatility_5d")
    for name in panel.columns:
        if "composite_sentiment" in name:
            added[f"{name}_strength"] = F.abs(F.col(name))
    if "sma_20" in have:
        regime = flag(F.col("close") > F.col("sma_20"))
        added["market_regime"] = regime
        if "composite_sentiment" in have:
            added["sentiment_bull_market"] = composite * regime
            added["sentiment_bear_market"] = composite * (1 - regime)
    return panel.withColumns(added) if added else panel


def news_interactions(panel: DataFrame) -> DataFrame:
    """Sentiment by log volume, articles by volatility, headline-content gap, momentum."""
    volatility = [name for name in panel.columns if "volatility" in name.lower()]
    spread = (
        F.col(volatility[0]) if volatility else rolling(F.stddev_samp, "daily_return", 5, min_periods=1)
    )
    tone = F.col("headline_vader_compound_mean")
    return panel.withColumns(
        {
            "sentiment_volume_interaction": tone * F.log1p("volume"),
            "news_volatility_interaction": F.col("article_count") * spread,
            "sentiment_consistency": F.abs(tone - F.col("content_vader_compound_mean")),
            "price_momentum_3d": technical.simple_return(3),
            "price_momentum_5d": technical.simple_return(5),
        }
    )


def target_variables(panel: DataFrame, horizons: Iterable[int] = (1, 3)) -> DataFrame:
    """Forward returns with direction and three-class labels, and forward volatility."""
    horizons = tuple(horizons)
    ahead = {f"target_return_{days}d": technical.forward_return(days) for days in horizons}
    ahead.update({f"target_volatility_{days}d": technical.forward_volatility(days) for days in (3, 5)})
    labels: dict[str, Column] = {}
    for days in horizons:
        value = F.col(f"target_return_{days}d")
        labels[f"target_direction_{days}d"] = direction(value)
        labels[f"target_multiclass_{days}d"] = three_classes(value)
    return panel.withColumns(ahead).withColumns(labels)


def future_targets(panel: DataFrame, horizons: Iterable[int] = (1, 2, 5)) -> DataFrame:
    """One-day returns found 1, 2 and 5 rows ahead, their sign and bin, and volatility."""
    horizons = tuple(horizons)
    ahead = {f"future_return_{days}d": technical.shifted_return(days) for days in horizons}
    ahead.update({f"future_volatility_{days}d": technical.shifted_rolling_volatility(days) for days in (1, 5)})
    labels: dict[str, Column] = {}
    for days in horizons:
        value = F.col(f"future_return_{days}d")
        labels[f"future_return_{days}d_positive"] = direction(value)
        labels[f"future_return_{days}d_categorical"] = five_bins(value)
    return panel.withColumns(ahead).withColumns(labels)


def basic_text_features(df: DataFrame) -> DataFrame:
    added = {f"{name}_length": length_or_zero(F.col(name)) for name in ("title", "summary") if name in df.columns}
    return df.withColumns(added) if added else df


def text_features(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns(text_statistics(F.col(column)))


TEXT_COLUMNS = ("title", "summary", "text", "combined_text")


def all_features(
    panel: DataFrame, sentiment_lags: Iterable[int] = (1, 3, 5), horizons: Iterable[int] = (1, 3)
) -> DataFrame:
    """Technical, calendar, sentiment, text, lag, target and interaction columns in order."""
    features = temporal_features(technical.technical_features(panel))
    sentiment = cleaning.sentiment_columns(features)
    if sentiment:
        features = groupstats.sentiment_group_features(features, sentiment, one_row_per_group=True)
    if any(name in features.columns for name in TEXT_COLUMNS):
        features = basic_text_features(features)
    features = technical.lag_features(features, sentiment_lags)
    return interaction_features(target_variables(features, horizons))
