"""Window formulas against pandas, and what they must not look at."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickerloom.operators import panel_features, technical


def frame(df):
    return df.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)


def same(left, right, tolerance=1e-9):
    left, right = np.asarray(left, float), np.asarray(right, float)
    assert (np.isnan(left) == np.isnan(right)).all()
    present = ~np.isnan(left)
    np.testing.assert_allclose(left[present], right[present], rtol=tolerance, atol=1e-12)


def with_returns(bars):
    return bars.withColumn("daily_return", technical.simple_return())


def test_technical_features_equal_pandas(bars, bars_pandas):
    ours = frame(technical.technical_features(with_returns(bars)))
    parts = []
    for _, rows in bars_pandas.groupby("ticker", sort=True):
        rows = rows.sort_values("date").reset_index(drop=True)
        returns = rows["close"].pct_change()
        out = {"sma_50": rows["close"].rolling(50).mean(), "ema_5": rows["close"].ewm(span=5).mean()}
        out["ema_50"] = rows["close"].ewm(span=50).mean()
        out["volatility_10d"] = returns.rolling(10).std()
        change = rows["close"].diff()
        gain, loss = change.clip(lower=0).fillna(0), (-change).clip(lower=0).fillna(0)
        strength = gain.rolling(14).mean() / loss.rolling(14).mean()
        out["rsi_14"] = 100 - 100 / (1 + strength)
        macd = rows["close"].ewm(span=12).mean() - rows["close"].ewm(span=26).mean()
        out["macd"], out["macd_signal"] = macd, macd.ewm(span=9).mean()
        out["is_new_high_20d"] = (rows["high"] == rows["high"].rolling(20).max()).astype(float)
        parts.append(pd.DataFrame(out))
    theirs = pd.concat(parts, ignore_index=True)
    for name in theirs:
        same(ours[name], theirs[name])


def test_ema_across_blocks_and_gaps(spark):
    """Longer than two blocks of the shortest span, with missing values."""
    rows = 700
    values = np.random.default_rng(3).normal(50, 5, rows)
    values[[0, 10, 11, 300]] = np.nan
    dates = pd.date_range("2020-01-01", periods=rows).date
    data = [("A", d, None if np.isnan(v) else float(v)) for d, v in zip(dates, values)]
    df = spark.createDataFrame(data, "ticker string, date date, close double")
    ours = frame(technical.with_ema(df, (5, 9)))
    for span in (5, 9):
        same(ours[f"ema_{span}"], pd.Series(values).ewm(span=span).mean())


def test_regime_features_equal_pandas(bars, bars_pandas):
    prepared = technical.technical_features(with_returns(bars))
    ours = frame(technical.market_regime_features(prepared))
    for ticker, rows in ours.groupby("ticker"):
        median = rows["volatility_5d"].rolling(60, min_periods=30).median()
        assert (rows["high_vol_regime_5d"] == (rows["volatility_5d"] > 1.5 * median).astype(int)).all()
        down = (rows["daily_return"] < 0).astype(int)
        streak = down.groupby((down != down.shift()).cumsum()).cumsum() * down
        assert (rows["consecutive_down_days"] == streak).all()
        gap = (rows["close"] - rows["sma_20"]) / rows["sma_20"]
        same(rows["trend_strength_20d"], gap.rolling(20).std())


def test_forward_targets_equal_pandas(bars):
    ours = frame(panel_features.target_variables(with_returns(bars)))
    for _, rows in ours.groupby("ticker"):
        same(rows["target_return_3d"], rows["close"].shift(-3) / rows["close"] - 1)
        same(rows["target_volatility_5d"], rows["daily_return"].rolling(5).std().shift(-5))
        assert rows["target_direction_1d"].iloc[-1] == 0 and rows["target_multiclass_1d"].iloc[-1] == 1


def test_fill_equals_forward_then_backward(spark):
    rows = [("A", i, v) for i, v in enumerate([None, 1.0, None, 3.0, None])] + [("B", 0, None), ("B", 1, None)]
    df = spark.createDataFrame(rows, "ticker string, n int, x double").withColumn(
        "date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n"))
    )
    filled = frame(technical.fill_forward_backward(df, ["x"]))
    assert filled["x"].tolist() == [1.0, 1.0, 1.0, 3.0, 3.0, 0.0, 0.0]


def test_features_ignore_the_future_and_other_tickers(bars):
    panel = with_returns(bars).withColumn("composite_sentiment", F.col("open") / F.col("close") - 1)
    last = bars.agg(F.max("date")).first()[0]
    moved = panel.withColumns(
        {name: F.when(F.col("date") == last, F.col(name) * 3).otherwise(F.col(name)) for name in ("close", "high", "volume")}
    ).withColumn("daily_return", technical.simple_return())
    before, after = frame(panel_features.all_features(panel)), frame(panel_features.all_features(moved))
    earlier = (before["date"] < last) & (before["ticker"] == "AAA")
    other = before["ticker"] == "BBB"
    for name in before.columns:
        if not name.startswith("target_"):
            assert before.loc[earlier, name].equals(after.loc[earlier, name]), name
        assert before.loc[other, name].equals(after.loc[other, name]), name
    assert len(before) == panel.count()
