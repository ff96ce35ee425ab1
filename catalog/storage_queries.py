"""Round trips: derived tables are written by the sinks and read back by the scans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window, functions as F

from catalog.cleaning_queries import RETURNS
from catalog.registry import query
from tickerloom import schemas
from tickerloom.operators import splits, technical
from tickerloom.plans import jobs
from tickerloom.session import checkpoint_folder
from tickerloom.sources import files, sinks


def fresh_folder(t, name: str) -> str:
    return f"{checkpoint_folder(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def feed_rows(t) -> DataFrame:
    """Articles in the stored layout of a feed."""
    known = {"timestamp": F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), **{n: F.col(n) for n in ("ticker", "headline", "content", "source", "url")}}
    return t.news.select(*[known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.NEWS])


@query(
    "stored_news",
    "overall_sentiment_score ticker_sentiment_score",
    """SELECT ticker, headline, content, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, source, url, NULL::DOUBLE AS overall_sentiment_score,
         NULL::VARCHAR AS overall_sentiment_label, NULL::DOUBLE AS ticker_sentiment_score, NULL::VARCHAR AS ticker_sentiment_label FROM news""",
)
def stored_news(t):
    folder = fresh_folder(t, "news")
    # The second choice of the scan: no combined file is there.
    sinks.write_news(feed_rows(t), folder, "fmp_news")
    return files.read_news(t.spark, folder, ".parquet")


@query("stored_bars", "", "SELECT date, ticker, open, high, low, close, volume FROM bars")
def stored_bars(t):
    folder = fresh_folder(t, "bars")
    sinks.write_bars(t.bars, folder)
    return files.read_bars(t.spark, f"{folder}/stock_prices.parquet")


@query(
    "stored_price_summary",
    "close_min:4 close_max:4 close_mean:4 volume_mean:4 return_mean:4 return_std:4",
    f"""SELECT ticker, min(date) AS date_min, max(date) AS date_max, count(date) AS date_count, round_even(min(close), 4)::DOUBLE AS close_min,
          round_even(max(close), 4)::DOUBLE AS close_max, round_even(avg(close), 4)::DOUBLE AS close_mean, round_even(avg(volume), 4)::DOUBLE AS volume_mean,
          round_even(avg(daily_return), 4)::DOUBLE AS return_mean, round_even(stddev_samp(daily_return), 4)::DOUBLE AS return_std
        FROM ({RETURNS}) GROUP BY ticker""",
)
def stored_price_summary(t):
    folder = fresh_folder(t, "bars")
    sinks.write_bars(t.bars, folder)
    return t.spark.read.parquet(f"{folder}/price_summary.parquet")


@query(
    "sorted_files",
    "",
    """SELECT count(*) AS "rows", (SELECT ticker FROM bars ORDER BY ticker, date LIMIT 1) AS first_ticker,
         (SELECT date FROM bars ORDER BY ticker DESC, date DESC LIMIT 1) AS last_date, 0::BIGINT AS overlapping_files FROM bars""",
)
def sorted_files(t):
    """The manifest of a stored panel: files follow one another in (ticker, date) order without overlap."""
    path = f"{fresh_folder(t, 'panel')}/panel.parquet"
    sinks.write_panel(t.bars, path)
    listed = t.spark.read.parquet(sinks.manifest_path(path))
    # One row per file: their order is a small window.
    before = F.lag("last").over(Window.orderBy("first"))
    return (
        listed.withColumn("overlaps", before >= F.col("first"))
        .agg(
            F.sum("rows").alias("rows"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.count_if("overlaps").alias("overlapping_files"),
        )
        .select("rows", F.col("first.ticker").alias("first_ticker"), F.col("last.date").alias("last_date"), "overlapping_files")
    )


@query(
    "stored_panel",
    "target_return_1d",
    "SELECT date, ticker, close, lead(close, 1) OVER (PARTITION BY ticker ORDER BY date) / close - 1 AS target_return_1d FROM bars",
)
def stored_panel(t):
    path = f"{fresh_folder(t, 'panel')}/panel.parquet"
    sinks.write_panel(t.bars.select("date", "ticker", "close", technical.forward_return(1).alias("target_return_1d")), path)
    return files.read_panel(t.spark, path)


SPLIT_SQL = """WITH d AS (SELECT date, row_number() OVER (ORDER BY date) AS n, count(*) OVER () AS c FROM (SELECT DISTINCT date FROM bars)),
    p AS (SELECT ticker, bars.date, close, volume, CASE WHEN n <= floor(c * 0.7::DOUBLE) THEN 'train'
        WHEN n <= floor(c * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM bars JOIN d ON d.date = bars.date),
    s AS (SELECT avg(close) AS a, stddev_pop(close) AS b, avg(volume) AS v, stddev_pop(volume) AS w FROM p WHERE split = 'train')
  SELECT ticker, date, split, (close - a) / b AS scaled_close, (volume - v) / w AS scaled_volume FROM p, s"""


@query("stored_splits", "scaled_close scaled_volume", SPLIT_SQL)
def stored_splits(t):
    """The three scaled splits, written with the raw ones and read back."""
    raw = splits.split_by_date(t.bars.select("ticker", "date", "close", "volume"))
    folder = fresh_folder(t, "splits")
    sinks.write_splits(raw, splits.scale_splits(raw, ["close", "volume"]), folder, {})
    result = None
    for name, df in files.read_splits(t.spark, folder).items():
        part = df.select("ticker", "date", F.lit(name).alias("split"), F.col("close").alias("scaled_close"), F.col("volume").alias("scaled_volume"))
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "split_metadata",
    "",
    """SELECT 2::BIGINT AS total_features, train_samples, val_samples, n - train_samples - val_samples AS test_samples, ['close', 'volume'] AS feature_columns
       FROM (SELECT n, floor(n * 0.7::DOUBLE)::BIGINT AS train_samples, floor(n * (0.7::DOUBLE + 0.15::DOUBLE))::BIGINT - floor(n * 0.7::DOUBLE)::BIGINT AS val_samples
         FROM (SELECT count(*) AS n FROM bars))""",
)
def split_metadata(t):
    folder = fresh_folder(t, "splits")
    jobs.split_job(t.bars.select("ticker", "date", "close", "volume"), folder, ["close", "volume"])
    return files.read_metadata(t.spark, f"{folder}/metadata.json").select(
        "total_features", "train_samples", "val_samples", "test_samples", "feature_columns"
    )


def text_scorer():
    """A scorer of the text's length, which two parts of one day would not share."""
    return lambda texts: {"vader_compound": [len(text) % 7 / 7 for text in texts], "textblob_polarity": [len(text) % 5 / 5 for text in texts]}


@query("scored_panel", "vader_compound textblob_polarity composite_sentiment")
def scored_panel(t):
    """The merged panel with its days' texts scored part by part."""
    panel = jobs.merged_panel(t.news, t.bars, ["doc_id"], factories=[text_scorer])
    return panel.select("ticker", "date", "article_count", "vader_compound", "textblob_polarity", "composite_sentiment")
