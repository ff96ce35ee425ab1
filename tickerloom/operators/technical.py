"""Price and volume features per ticker.

All window expressions of one level share one specification, so a level is one
exchange on `ticker`, one sort and one window pass; a second level (over results of
the first) reuses the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickerloom.functions.numeric import (
    by_ticker,
    direction,
    ema,
    flag,
    lag_change,
    rolling,
    rolling_median,
    running,
    three_classes,
)

SMA_WINDOWS = (5, 10, 20, 50)
MACD_SPANS = (12, 26)
SIGNAL_SPAN = 9
VOLATILITY_WINDOWS = (5, 10, 20)
POSITION = "_position"


def simple_return(periods: int = 1) -> Column:
    return lag_change("close", periods)


def log_return() -> Column:
    price = F.ln("close")
    return price - F.lag(price, 1).over(by_ticker())


def forward_return(days: int) -> Column:
    """Price change over the next `days` rows."""
    return F.try_divide(F.lead("close", days).over(by_ticker()), F.col("close")) - 1


def shifted_return(days: int) -> Column:
    """The one-day return found `days` rows ahead (not cumulative)."""
    return F.lead("daily_return", days).over(by_ticker())


def forward_volatility(days: int) -> Column:
    """Sample deviation of the next `days` one-day returns, all of them present."""
    frame = by_ticker().rowsBetween(1, days)
    ahead = F.col("daily_return")
    return F.when(F.count(ahead).over(frame) == days, F.stddev_samp(ahead).over(frame))


def shifted_rolling_volatility(days: int) -> Column:
    """Like `forward_volatility`, but missing on a ticker's first `days - 1` rows."""
    return F.when(F.row_number().over(by_ticker()) >= days, forward_volatility(days))


def with_returns(bars: DataFrame) -> DataFrame:
    return bars.withColumns({"daily_return": simple_return(), "log_return": log_return()})


def _gain_and_loss() -> tuple[Column, Column]:
    change = F.col("close") - F.lag("close", 1).over(by_ticker())
    gain = F.when(change > 0, change).otherwise(0.0)
    loss = F.when(change < 0, -change).otherwise(0.0)
    return gain, loss


def _relative_strength(gain: Column, loss: Column) -> Column:
    """100 - 100/(1 + gain/loss); only gains make 100, no move at all is missing."""
    return F.when(loss > 0, 100 - 100 / (1 + F.try_divide(gain, loss))).when(gain > 0, 100.0)


def with_rsi(bars: DataFrame, rows: int = 14) -> DataFrame:
    gain, loss = _gain_and_loss()
    moves = bars.withColumns({"_gain": gain, "_loss": loss})
    means = moves.withColumns(
        {"_gain": rolling(F.avg, "_gain", rows), "_loss": rolling(F.avg, "_loss", rows)}
    )
    strength = _relative_strength(F.col("_gain"), F.col("_loss"))
    return means.withColumn(f"rsi_{rows}", strength).drop("_gain", "_loss")


def with_ema(bars: DataFrame, spans: Iterable[int] = SMA_WINDOWS) -> DataFrame:
    spans = tuple(spans)
    placed = bars.withColumn(POSITION, F.row_number().over(by_ticker()) - 1)
    means = {f"ema_{span}": ema("close", span, F.col(POSITION)) for span in spans}
    return placed.withColumns(means).drop(POSITION)


def with_macd(bars: DataFrame) -> DataFrame:
    """Difference of two exponential means, its own exponential mean, and the gap."""
    fast, slow = MACD_SPANS
    position = F.col(POSITION)
    placed = bars.withColumn(POSITION, F.row_number().over(by_ticker()) - 1)
    macd = placed.withColumn(
        "macd", ema("close", fast, position) - ema("close", slow, position)
    )
    signal = macd.withColumn("macd_signal", ema("macd", SIGNAL_SPAN, position))
    return signal.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).drop(POSITION)


def bollinger(sma: Column, deviation: Column, close: Column, width: float = 2.0) -> dict[str, Column]:
    upper, lower = sma + width * deviation, sma - width * deviation
    return {
        "bb_upper": upper,
        "bb_lower": lower,
        "bb_width": F.try_divide(upper - lower, sma),
        "bb_position": F.try_divide(close - lower, upper - lower),
    }


def technical_features(bars: DataFrame, volatility_windows: Iterable[int] = VOLATILITY_WINDOWS) -> DataFrame:
    """Means, exponential means, volatility, RSI, MACD, bands, volume and pattern columns.

    Needs `daily_return`. Three window levels: moves and positions; rolling means and
    exponential means; the exponential mean of the MACD line.
    """
    close, position = F.col("close"), F.col(POSITION)
    gain, loss = _gain_and_loss()
    first = bars.withColumns(
        {
            POSITION: F.row_number().over(by_ticker()) - 1,
            "_gain": gain,
            "_loss": loss,
            "_spread": F.try_divide(F.col("high") - F.col("low"), close),
        }
    )

    level: dict[str, Column] = {}
    for rows in SMA_WINDOWS:
        level[f"sma_{rows}"] = rolling(F.avg, "close", rows)
        level[f"ema_{rows}"] = ema("close", rows, position)
    for rows in volatility_windows:
        level[f"volatility_{rows}d"] = rolling(F.stddev_samp, "daily_return", rows)
        level[f"high_low_ratio_{rows}d"] = rolling(F.avg, "_spread", rows)
    level["_gain"] = rolling(F.avg, "_gain", 14)
    level["_loss"] = rolling(F.avg, "_loss", 14)
    level["_fast"], level["_slow"] = (ema("close", span, position) for span in MACD_SPANS)
    level["_deviation"] = rolling(F.stddev_samp, "close", 20)
    level["volume_sma_10"] = rolling(F.avg, "volume", 10)
    for days in (1, 3, 5):
        level[f"price_change_{days}d"] = simple_return(days)
    level["is_new_high_20d"] = flag(F.col("high") == rolling(F.max, "high", 20))
    level["is_new_low_20d"] = flag(F.col("low") == rolling(F.min, "low", 20))
    second = first.withColumns(level)

    derived = {f"price_vs_sma_{rows}": close / F.col(f"sma_{rows}") - 1 for rows in SMA_WINDOWS}
    derived["rsi_14"] = _relative_strength(F.col("_gain"), F.col("_loss"))
    derived["macd"] = F.col("_fast") - F.col("_slow")
    derived.update(bollinger(F.col("sma_20"), F.col("_deviation"), close))
    derived["volume_ratio"] = F.try_divide(F.col("volume"), F.col("volume_sma_10"))
    derived["price_volume"] = close * F.col("volume")
    third = second.withColumns(derived)

    signal = third.withColumn("macd_signal", ema("macd", SIGNAL_SPAN, position))
    return signal.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).drop(
        POSITION, "_gain", "_loss", "_spread", "_fast", "_slow", "_deviation"
    )


def returns_and_features(bars: DataFrame) -> DataFrame:
    """Returns, short volatilities, means, RSI, bands, volume and next-day targets."""
    close = F.col("close")
    gain, loss = _gain_and_loss()
    first = with_returns(bars).withColumns({"_gain": gain, "_loss": loss})
    second = first.withColumns(
        {
            "next_day_return": shifted_return(1),
            "next_3day_return": forward_return(3),
            "volatility_5d": rolling(F.stddev_samp, "daily_return", 5),
            "volatility_10d": rolling(F.stddev_samp, "daily_return", 10),
            "sma_5": rolling(F.avg, "close", 5),
            "sma_10": rolling(F.avg, "close", 10),
            "sma_20": rolling(F.avg, "close", 20),
            "_deviation": rolling(F.stddev_samp, "close", 20),
            "_gain": rolling(F.avg, "_gain", 14),
            "_loss": rolling(F.avg, "_loss", 14),
            "volume_sma_10": rolling(F.avg, "volume", 10),
        }
    )
    bands = bollinger(F.col("sma_20"), F.col("_deviation"), close)
    return second.withColumns(
        {
            "rsi_14": _relative_strength(F.col("_gain"), F.col("_loss")),
            "volume_ratio": F.try_divide(F.col("volume"), F.col("volume_sma_10")),
            "price_vs_sma5": close / F.col("sma_5") - 1,
            "price_vs_sma10": close / F.col("sma_10") - 1,
            "bb_upper": bands["bb_upper"],
            "bb_lower": bands["bb_lower"],
            "bb_position": bands["bb_position"],
            "target_binary": direction(F.col("next_day_return")),
            "target_multiclass": three_classes(F.col("next_day_return")),
        }
    ).drop("_gain", "_loss", "_deviation")


def market_regime_features(panel: DataFrame) -> DataFrame:
    """Volatility regimes, trend strength, losing streaks and large moves per ticker."""
    level: dict[str, Column] = {}
    for rows in VOLATILITY_WINDOWS:
        name = f"volatility_{rows}d"
        if name in panel.columns:
            median = rolling_median(F.col(name), 60, 30)
            level[f"high_vol_regime_{rows}d"] = flag(F.col(name) > 1.5 * median)
            level[f"low_vol_regime_{rows}d"] = flag(F.col(name) < 0.5 * median)
    for rows in (10, 20, 50):
        sma = F.col(f"sma_{rows}")
        if f"sma_{rows}" in panel.columns:
            gap = F.try_divide(F.col("close") - sma, sma)
            level[f"trend_strength_{rows}d"] = rolling(F.stddev_samp, gap, rows)
    if "daily_return" in panel.columns:
        negative = F.coalesce(F.col("daily_return") < 0, F.lit(False))
        row = F.row_number().over(by_ticker())
        panel = panel.withColumns({"_row": row, "_not_down": F.when(~negative, row)})
        last_up = F.coalesce(F.max("_not_down").over(running()), F.lit(0))
        level["consecutive_down_days"] = F.when(negative, F.col("_row") - last_up).otherwise(0)
        deviation = rolling(F.stddev_samp, "daily_return", 60, min_periods=30)
        level["large_move_indicator"] = flag(F.abs("daily_return") > 2 * deviation)
    return panel.withColumns(level).drop("_row", "_not_down")


def lag_features(panel: DataFrame, sentiment_lags: Iterable[int] = (1, 3, 5)) -> DataFrame:
    """Lags of sentiment, returns and volume ratio; rolling moments of return and composite."""
    from tickerloom.operators.cleaning import sentiment_columns

    added: dict[str, Column] = {}
    for name in sentiment_columns(panel):
        for lag in sentiment_lags:
            added[f"{name}_lag_{lag}"] = F.lag(name, lag).over(by_ticker())
    if "daily_return" in panel.columns:
        for lag in (1, 2, 3, 5):
            added[f"return_lag_{lag}"] = F.lag("daily_return", lag).over(by_ticker())
    if "volume_ratio" in panel.columns:
        for lag in (1, 3):
            added[f"volume_ratio_lag_{lag}"] = F.lag("volume_ratio", lag).over(by_ticker())
    for name in ("daily_return", "composite_sentiment"):
        if name in panel.columns:
            for rows in (3, 5, 10):
                added[f"{name}_rolling_mean_{rows}"] = rolling(F.avg, name, rows)
                added[f"{name}_rolling_std_{rows}"] = rolling(F.stddev_samp, name, rows)
    return panel.withColumns(added)


def news_lags_and_means(
    panel: DataFrame, columns: Iterable[str], lags: Iterable[int] = (1, 2, 3, 5), windows: Iterable[int] = (3, 5, 10)
) -> DataFrame:
    """Lags and rolling means (from the first row on) of daily news variables."""
    columns = list(columns)
    added = {f"{name}_lag_{lag}": F.lag(name, lag).over(by_ticker()) for name in columns for lag in lags}
    added.update(
        {f"{name}_ma_{rows}": rolling(F.avg, name, rows, min_periods=1) for name in columns for rows in windows}
    )
    return panel.withColumns(added)


def fill_forward_backward(panel: DataFrame, columns: Iterable[str], zero: bool = True) -> DataFrame:
    """Per ticker: last earlier value, else first later value, else 0.

    Without an earlier value the ticker's first value is the next one, so both come from
    frames that grow once over the ticker (a frame shrinking from the end would be read
    anew for every row).
    """
    whole = by_ticker().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def filled(name: str) -> Column:
        choices = [F.last(name, ignorenulls=True).over(running()), F.first(name, ignorenulls=True).over(whole)]
        return F.coalesce(*choices, *([F.lit(0)] if zero else []))

    return panel.withColumns({name: filled(name) for name in columns})


def first_close(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker").agg(
        F.min_by("close", "date").alias("first_close"), F.min("date").alias("first_date")
    )
