"""Hot keys, bucketed order statistics and pooled series against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickerloom.operators import cleaning, daily_news, groupstats, merge, metrics, ordered, quantiles, splits


def test_keep_first_of_a_hot_key(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), (-F.col("id")).alias("n")
    )
    kept = cleaning.keep_first(df, ["k"], ["n"])
    assert kept.count() == df.select("k").distinct().count()
    assert kept.where("k = 'hot'").first()["n"] == -4998


def test_keep_first_of_null_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, n int")
    assert sorted(row["n"] for row in cleaning.keep_first(df, ["k"], ["n"]).collect()) == [1, 3]


def test_a_hot_day_is_cut_into_parts_that_join_to_the_whole(spark):
    news = spark.range(400).select(
        F.col("id").alias("n"),
        F.when(F.col("id") < 380, "HOT").otherwise("COLD").alias("ticker"),
        F.lit("2024-08-05 12:00:00").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("word"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("headline"),
        F.lit("story").alias("content"),
    )
    parts = daily_news.daily_text(news, ["timestamp", "n"], partitions=6)
    assert parts.where("ticker = 'HOT'").count() > 2
    whole = {row["ticker"]: row["combined_text"] for row in daily_news.join_parts(parts).collect()}
    expected = [f"word{''.join(chr(97 + int(d)) for d in str(i))} story" for i in range(400)]
    assert whole["HOT"] == " ".join(expected[:380]) and whole["COLD"] == " ".join(expected[380:])


@pytest.mark.parametrize("buckets", [2, 7, 256])
def test_exact_quantiles(spark, buckets):
    draw = np.random.default_rng(1)
    data = pd.DataFrame({"g": draw.integers(0, 3, 900), "x": np.round(draw.normal(size=900), 2), "y": draw.normal(size=900)})
    data.loc[data.index % 10 == 0, "x"] = None
    data.loc[data["g"] == 2, "y"] = 5.0
    df = spark.createDataFrame(data).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    shares = {"a": 0.05, "b": 0.5, "c": 0.95}
    found = quantiles.exact_quantiles(df, ["x", "y"], shares, ["g"], buckets).collect()
    assert len(found) == 6
    for row in found:
        values = data.loc[data["g"] == row["g"], row["column"]].dropna()
        for name, share in shares.items():
            assert row[name] == pytest.approx(np.percentile(values, share * 100), abs=1e-12)
    total = {row["column"]: row["b"] for row in quantiles.exact_quantiles(df, ["x", "y"], {"b": 0.5}).collect()}
    assert total["y"] == pytest.approx(data["y"].median())


def test_group_statistics_equal_pandas(spark):
    draw = np.random.default_rng(5)
    data = pd.DataFrame({"ticker": draw.choice(["A", "B"], 60), "date": "d", "vader": draw.normal(size=60)})
    found = groupstats.group_statistics(spark.createDataFrame(data), ["vader"], ["ticker", "date"]).toPandas()
    expected = data.groupby("ticker")["vader"].agg(["mean", "median", "std", "min", "max", "skew"])
    for _, row in found.iterrows():
        for kind in groupstats.STATISTICS:
            assert row[f"vader_{kind}"] == pytest.approx(expected.loc[row["ticker"], kind])


def panel(spark, tickers=6, days=40):
    draw = np.random.default_rng(2)
    rows = [
        (f"T{t}", d, float(draw.normal(0, 0.02)), int(draw.integers(-1, 2)))
        for d in pd.date_range("2024-01-01", periods=days).date
        for t in range(tickers)
        if draw.random() > 0.2
    ]
    df = spark.createDataFrame(rows, "ticker string, date date, r double, signal int")
    return df, pd.DataFrame(rows, columns=["ticker", "date", "r", "signal"]).sort_values(["date", "ticker"], ignore_index=True)


def test_pooled_series_equals_one_ordered_array(spark):
    df, data = panel(spark)
    curve = ordered.with_drawdown(ordered.with_growth(df, "r", "g"), "g", "dd")
    steps = ordered.with_previous(curve, "signal", "before", 0)
    found = steps.toPandas().sort_values(["date", "ticker"], ignore_index=True)
    growth = (1 + data["r"]).cumprod()
    np.testing.assert_allclose(found["g"], growth)
    np.testing.assert_allclose(found["dd"], growth / growth.cummax() - 1, atol=1e-12)
    assert found["before"].tolist() == data["signal"].shift(1).fillna(0).astype(int).tolist()


def test_row_rank_and_splits(spark):
    df, data = panel(spark)
    ranked = ordered.row_rank(df).toPandas().sort_values(["date", "ticker"], ignore_index=True)
    assert ranked["_rank"].tolist() == list(range(len(data)))
    tagged = splits.with_row_split(df).groupBy("split").count().collect()
    counts = {row["split"]: row["count"] for row in tagged}
    assert counts["train"] == int(0.7 * len(data)) and counts["train"] + counts["val"] == int(0.85 * len(data))


def test_leave_one_out_equals_other_rows(spark):
    df, data = panel(spark)
    found = merge.leave_one_out(df, "r").toPandas()
    for _, row in found.iterrows():
        others = data[(data["date"] == row["date"]) & (data["ticker"] != row["ticker"])]["r"]
        if len(others) > 1:
            assert row["market_return"] == pytest.approx(others.mean())
            assert row["market_volatility"] == pytest.approx(others.std())


def test_auc_equals_all_pairs(spark):
    draw = np.random.default_rng(9)
    y, s = draw.integers(0, 2, 300), np.round(draw.random(300), 2)
    df = spark.createDataFrame(pd.DataFrame({"y_true": y, "y_proba": s}))
    gaps = s[y == 1][:, None] - s[y == 0][None, :]
    expected = ((gaps > 0) + 0.5 * (gaps == 0)).mean()
    assert metrics.roc_auc(df).first()[0] == pytest.approx(expected)
    assert metrics.roc_auc(df.where("y_true = 1")).first()[0] is None


def test_stratified_folds_are_even(spark):
    df = spark.range(20000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    counts = splits.with_stratified_fold(df, "y", ["id"]).groupBy("y", "fold").count().toPandas()
    for _, part in counts.groupby("y"):
        assert len(part) == 5 and part["count"].max() < 1.25 * part["count"].min()


def test_exponential_means_of_mixed_spans(spark):
    import numpy as np
    import pandas as pd

    from tickerloom.operators import technical

    days = pd.date_range("2000-01-01", periods=5000).date
    close = 100 + np.random.default_rng(3).normal(0, 1, 5000).cumsum() * 0.1
    df = spark.createDataFrame(pd.DataFrame({"ticker": "A", "date": days, "close": close}))
    ours = technical.with_ema(df, (2, 200)).toPandas().sort_values("date")
    for span in (2, 200):
        want = pd.Series(close).ewm(span=span, adjust=True).mean()
        np.testing.assert_allclose(ours[f"ema_{span}"], want, rtol=1e-9)


def test_pooled_drawdown_stays_finite(spark):
    import numpy as np
    import pandas as pd

    from tickerloom.operators import ordered

    draw = np.random.default_rng(5)
    returns = draw.normal(0.01, 0.05, 200_000)
    days = np.repeat(pd.date_range("1990-01-01", periods=200).date, 1000)
    frame = pd.DataFrame({"ticker": np.tile([f"T{i:04d}" for i in range(1000)], 200), "date": days, "r": returns})
    ours = ordered.with_return_drawdown(spark.createDataFrame(frame), "r", "dd").toPandas().sort_values(["date", "ticker"])
    log = np.cumsum(np.log1p(returns))
    np.testing.assert_allclose(ours["dd"], np.expm1(log - np.maximum.accumulate(log)), rtol=1e-6, atol=1e-9)
