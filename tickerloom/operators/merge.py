"""Joins: news to bars, leave-one-out market return, sector means, valuation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tickerloom.functions import fixed_values as fixed
from tickerloom.operators import daily_news

NEWS_DEFAULTS = {
    "article_count": 0,
    "total_headline_chars": 0,
    "total_content_chars": 0,
    "avg_article_length": 0.0,
    "combined_text": "",
}


def attach_daily_news(bars: DataFrame, news: DataFrame, day: str = "trading_date") -> DataFrame:
    """Left join on (ticker, day); both sides have one row per key. Counts default to 0.

    `total_chars_sum` stays null on days without news, as it is not among the defaults.
    """
    right = news.withColumnRenamed(day, "date") if day != "date" else news
    joined = bars.join(right, ["ticker", "date"], "left")
    defaults = {name: value for name, value in NEWS_DEFAULTS.items() if name in right.columns}
    return joined.na.fill(defaults) if defaults else joined


def attach_zero_filled(bars: DataFrame, news: DataFrame) -> DataFrame:
    """Left join on (ticker, date) with every missing news number as 0."""
    measures = [name for name in news.columns if name not in ("ticker", "date")]
    return bars.join(news, ["ticker", "date"], "left").na.fill(0, subset=measures)


def merge_news_and_bars(news: DataFrame, bars: DataFrame) -> DataFrame:
    """Prepare texts, assign trading dates, aggregate and join onto the bars."""
    articles = daily_news.with_trading_date(daily_news.prepare_articles(news))
    return attach_daily_news(bars, daily_news.daily_news(articles))


def leave_one_out(panel: DataFrame, value: str = "daily_return") -> DataFrame:
    """Mean and sample deviation of the other tickers' returns on the same date.

    From one aggregate per date (count, mean, squared deviations), from which a row's
    own share is taken out: no pairs of tickers are formed and no date is collected.
    """
    x = F.col(value)
    per_date = panel.groupBy("date").agg(
        F.count("*").alias("rows"),
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.var_pop(value).alias("variance"),
    )
    own = x.isNotNull().cast("int")
    others = F.col("n") - own
    gap = F.coalesce(x - F.col("mean"), F.lit(0.0))
    squares = F.col("variance") * F.col("n") - F.coalesce(
        F.try_divide(gap * gap * F.col("n"), others), F.lit(0.0)
    )
    market_return = F.col("mean") - F.try_divide(gap, others)
    return (
        panel.join(per_date, "date", "left")
        .withColumns(
            {
                "market_return": F.when(others > 0, market_return),
                "market_volatility": F.when(
                    others > 1, F.sqrt(F.try_divide(F.greatest(squares, F.lit(0.0)), others - 1))
                ),
            }
        )
        .withColumn("relative_to_market", x - F.col("market_return"))
        .drop("rows", "n", "mean", "variance")
    )


def sector_means(panel: DataFrame, tickers: tuple[str, ...], name: str) -> DataFrame:
    return (
        panel.where(F.col("ticker").isin(list(tickers)))
        .groupBy("date")
        .agg(F.avg("daily_return").alias(f"{name}_sector_return"))
    )


def attach_sector_means(
    panel: DataFrame, sectors: Mapping[str, tuple[str, ...]] = fixed.SECTORS
) -> DataFrame:
    """Mean return of every sector on the date; all sectors in one aggregate and join."""
    measures = [
        F.avg(F.when(F.col("ticker").isin(list(tickers)), F.col("daily_return"))).alias(f"{name}_sector_return")
        for name, tickers in sectors.items()
    ]
    members = sorted({ticker for tickers in sectors.values() for ticker in tickers})
    per_date = panel.where(F.col("ticker").isin(members)).groupBy("date").agg(*measures)
    return panel.join(per_date, "date", "left")


def cross_asset_features(panel: DataFrame, sectors: Mapping[str, tuple[str, ...]] = fixed.SECTORS) -> DataFrame:
    return attach_sector_means(leave_one_out(panel), sectors)


def holdings_value(shares: DataFrame, bars: DataFrame) -> DataFrame:
    """Value of constant holdings (`ticker`, `shares`) per date."""
    return (
        bars.select("ticker", "date", "close")
        .join(shares.select("ticker", "shares"), "ticker")
        .groupBy("date")
        .agg(F.sum(F.col("shares") * F.col("close")).alias("value"))
    )
