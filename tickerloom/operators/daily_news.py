"""Article tables to (ticker, day): trading dates, text preparation, daily aggregates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from tickerloom.functions import calendar, fixed_values as fixed, sentiment, text


def prepare_articles(news: DataFrame) -> DataFrame:
    """Preprocessed texts, the combined text and character counts per article."""
    prepared = text.with_preprocessed(news, {"headline_clean": "headline", "content_clean": "content"})
    return prepared.withColumns(
        {
            "combined_text": F.concat_ws(" ", "headline_clean", "content_clean"),
            "headline_chars": F.length("headline_clean"),
            "content_chars": F.length("content_clean"),
            "total_chars": F.length("headline_clean") + F.length("content_clean"),
        }
    )


def with_trading_date(news: DataFrame, zone: str = fixed.MARKET_TIMEZONE) -> DataFrame:
    return news.withColumns(
        {
            "timestamp_local": calendar.market_time(F.col("timestamp"), zone),
            "trading_date": calendar.trading_date(F.col("timestamp"), zone),
        }
    )


def daily_news(articles: DataFrame) -> DataFrame:
    """Character sums, mean length and article count per (ticker, trading_date).

    Distributive aggregates only, so a ticker-day of any size is reduced map-side.
    """
    return articles.groupBy("ticker", "trading_date").agg(
        F.sum("headline_chars").alias("total_headline_chars"),
        F.sum("content_chars").alias("total_content_chars"),
        F.sum("total_chars").alias("total_chars_sum"),
        F.bround(F.avg("total_chars"), 2).alias("avg_article_length"),
        F.count("headline").alias("article_count"),
    )


def daily_text(news: DataFrame, order: Iterable[str], partitions: int | None = None) -> DataFrame:
    """The day's preprocessed texts joined by blanks in article order, as numbered parts.

    Articles are range-partitioned on (ticker, day, order), which cuts a hot day into
    several sorted partitions; every partition prepares and joins its own stretch.
    Ordinary days have one part, and the parts of a day in order are the whole text.
    The ranges are drawn before the texts are prepared, since drawing reads the input
    once more. Articles that have their `combined_text` are not prepared again.
    """
    order = list(order)
    keys = ["ticker", "trading_date"]
    texts = ["combined_text"] if "combined_text" in news.columns else ["headline", "content"]
    raw = with_trading_date(news).select(*keys, *[name for name in order if name not in keys], *texts)
    ranges = [F.col(name) for name in keys + order]
    ranged = raw.repartitionByRange(partitions, *ranges) if partitions else raw.repartitionByRange(*ranges)
    prepared = ranged if "combined_text" in texts else prepare_articles(ranged)
    articles = prepared.select(*keys, *order, "combined_text", F.spark_partition_id().alias("stretch"))
    stretch = F.array_sort(F.collect_list(F.struct(*order, "combined_text")))
    parts = articles.groupBy(*keys, "stretch").agg(
        F.array_join(F.transform(stretch, lambda row: row["combined_text"]), " ").alias("combined_text")
    )
    numbered = Window.partitionBy(*keys).orderBy("stretch")
    return parts.select(
        *keys, (F.row_number().over(numbered) - 1).alias("part"), "combined_text"
    )


def join_parts(parts: DataFrame) -> DataFrame:
    """Whole daily texts, for days short enough to be one value."""
    ordered = F.array_sort(F.collect_list(F.struct("part", "combined_text")))
    return parts.groupBy("ticker", "trading_date").agg(
        F.array_join(F.transform(ordered, lambda row: row["combined_text"]), " ").alias("combined_text")
    )


def daily_keywords(articles: DataFrame, column: str = "combined_text") -> DataFrame:
    """Keyword counts and ratio of a day's whole text.

    Joining texts by blanks keeps words apart, so the day's counts are the sums of the
    articles' counts and the long daily text never has to exist.
    """
    positive, negative = sentiment.keyword_counts(F.col(column))
    scored = articles.select("ticker", "trading_date", positive.alias("p"), negative.alias("n"))
    return (
        scored.groupBy("ticker", "trading_date")
        .agg(F.sum("p").alias("finance_positive_count"), F.sum("n").alias("finance_negative_count"))
        .withColumn(
            "finance_sentiment_ratio",
            sentiment.sentiment_ratio(F.col("finance_positive_count"), F.col("finance_negative_count")),
        )
    )


HEADLINE_SCORES = ("headline_vader_compound", "headline_textblob_polarity", "headline_finbert_positive")
CONTENT_SCORES = ("content_vader_compound", "content_textblob_polarity", "content_finbert_positive")


def daily_sentiment(
    scored: DataFrame,
    date: str = "date",
    headline_scores: Iterable[str] = HEADLINE_SCORES,
    content_scores: Iterable[str] = CONTENT_SCORES,
) -> DataFrame:
    """Article count, spread of headline scores and means of content scores per day.

    A day with one article has deviation 0.
    """
    measures = [F.count("headline").alias("article_count")]
    for name in headline_scores:
        measures += [
            F.avg(name).alias(f"{name}_mean"),
            F.coalesce(F.stddev_samp(name), F.lit(0.0)).alias(f"{name}_std"),
            F.min(name).alias(f"{name}_min"),
            F.max(name).alias(f"{name}_max"),
        ]
    measures += [F.avg(name).alias(f"{name}_mean") for name in content_scores]
    return scored.groupBy("ticker", date).agg(*measures)


def daily_lengths(news: DataFrame) -> DataFrame:
    """Article count and mean lengths per (ticker, calendar day)."""
    return news.groupBy("ticker", F.to_date("timestamp").alias("date")).agg(
        F.count("headline").alias("article_count"),
        F.avg(F.length("headline")).alias("headline_length"),
        F.avg(F.length("content")).alias("content_length"),
    )


def articles_per_day(news: DataFrame) -> DataFrame:
    return news.groupBy(F.to_date("timestamp").alias("date")).agg(F.count("*").alias("articles"))


def news_quality(news: DataFrame, as_of) -> DataFrame:
    """Age against `as_of`, market-hours and credible-source flags, score agreement."""
    from tickerloom.functions.numeric import row_max_abs, row_std

    added = {}
    if "timestamp" in news.columns:
        added["news_age_hours"] = calendar.age_hours(F.col("timestamp"), as_of)
        added["market_hours_news"] = calendar.in_market_hours(F.col("timestamp"))
    if "source" in news.columns:
        added["credible_source"] = text.credible_source(F.col("source"))
    scores = [F.col(name) for name in news.columns if "sentiment" in name.lower()]
    if len(scores) >= 2:
        added["sentiment_consensus"] = row_std(scores)
        added["sentiment_extremity"] = row_max_abs(scores)
    return news.withColumns(added) if added else news
