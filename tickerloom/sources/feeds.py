"""News feeds in JSON: nested articles and flat articles to the common layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickerloom import schemas


def first_for_ticker(entries: Column, ticker: Column) -> Column:
    """First element of a struct array whose `ticker` matches, else null."""
    return F.get(F.filter(entries, lambda entry: entry["ticker"] == ticker), F.lit(0))


def nested_feed_rows(feed: DataFrame, ticker: Column) -> DataFrame:
    """One row per article of `feed[]`, with the ticker's own sentiment entry."""
    articles = feed.select(F.explode("feed").alias("article"), ticker.alias("ticker"))
    entry = first_for_ticker(F.col("article.ticker_sentiment"), F.col("ticker"))

    def text(name: str) -> Column:
        return F.coalesce(F.col(f"article.{name}"), F.lit(""))

    return articles.withColumn("entry", entry).select(
        "ticker",
        text("title").alias("headline"),
        text("summary").alias("content"),
        text("time_published").alias("timestamp"),
        text("source").alias("source"),
        text("url").alias("url"),
        F.coalesce(F.col("article.overall_sentiment_score"), F.lit(0.0)).alias("overall_sentiment_score"),
        text("overall_sentiment_label").alias("overall_sentiment_label"),
        F.when(
            F.col("entry").isNotNull(),
            F.coalesce(F.col("entry.relevance_score").try_cast("double"), F.lit(0.0)),
        ).alias("ticker_sentiment_score"),
        F.when(
            F.col("entry").isNotNull(), F.coalesce(F.col("entry.ticker_sentiment_label"), F.lit(""))
        ).alias("ticker_sentiment_label"),
    )


def read_nested_feed(spark: SparkSession, path: str, ticker: str) -> DataFrame:
    feed = spark.read.schema(schemas.NESTED_FEED).json(path, multiLine=True)
    return nested_feed_rows(feed, F.lit(ticker))


def flat_feed_rows(feed: DataFrame, ticker: Column) -> DataFrame:
    names = {
        "headline": "title",
        "content": "text",
        "timestamp": "publishedDate",
        "source": "site",
        "url": "url",
        "image": "image",
        "symbol": "symbol",
    }
    return feed.select(
        ticker.alias("ticker"),
        *[F.coalesce(F.col(old), F.lit("")).alias(new) for new, old in names.items()],
    )


def read_flat_feed(spark: SparkSession, path: str, ticker: str) -> DataFrame:
    return flat_feed_rows(spark.read.schema(schemas.FLAT_FEED).json(path, multiLine=True), F.lit(ticker))


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all sources, columns by name, absent columns null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
