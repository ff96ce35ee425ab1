"""Declared schemas of the stored tables; scans never infer."""

from pyspark.sql import types as T

BARS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ]
)

# Articles of either feed; columns one feed lacks stay null.
NEWS = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("headline", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("overall_sentiment_score", T.DoubleType()),
        T.StructField("overall_sentiment_label", T.StringType()),
        T.StructField("ticker_sentiment_score", T.DoubleType()),
        T.StructField("ticker_sentiment_label", T.StringType()),
    ]
)

# Columns a merge of bars and news cannot do without.
REQUIRED_NEWS = ("ticker", "headline", "content", "timestamp")
REQUIRED_BARS = ("ticker", "date", "open", "high", "low", "close", "volume")
REQUIRED_PANEL = ("date", "ticker")

TICKER_SENTIMENT = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("relevance_score", T.StringType()),
        T.StructField("ticker_sentiment_score", T.StringType()),
        T.StructField("ticker_sentiment_label", T.StringType()),
    ]
)

NESTED_FEED = T.StructType(
    [
        T.StructField(
            "feed",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("title", T.StringType()),
                        T.StructField("summary", T.StringType()),
                        T.StructField("time_published", T.StringType()),
                        T.StructField("source", T.StringType()),
                        T.StructField("url", T.StringType()),
                        T.StructField("overall_sentiment_score", T.DoubleType()),
                        T.StructField("overall_sentiment_label", T.StringType()),
                        T.StructField("ticker_sentiment", T.ArrayType(TICKER_SENTIMENT)),
                    ]
                )
            ),
        )
    ]
)

FLAT_FEED = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("publishedDate", T.StringType()),
        T.StructField("site", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("symbol", T.StringType()),
    ]
)

TRADES = T.StructType(
    [
        T.StructField("strategy", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("direction", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("entry_price", T.DoubleType()),
        T.StructField("exit_price", T.DoubleType()),
        T.StructField("entry_date", T.DateType()),
        T.StructField("exit_date", T.DateType()),
    ]
)
