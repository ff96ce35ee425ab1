"""Feeds, file scans, sinks and the stored jobs."""

import json

import pytest
from pyspark.sql import functions as F

from tickerloom import session
from tickerloom.operators import technical
from tickerloom.plans import jobs
from tickerloom.sources import feeds, files, sinks

ARTICLES = [
    {
        "title": "First",
        "summary": "One",
        "time_published": "20240805T133000",
        "source": "Wire",
        "url": "u1",
        "overall_sentiment_score": 0.25,
        "overall_sentiment_label": "Bullish",
        "ticker_sentiment": [
            {"ticker": "GD", "relevance_score": "0.9", "ticker_sentiment_label": "Neutral"},
            {"ticker": "AMD", "relevance_score": "0.4", "ticker_sentiment_label": "Bearish"},
            {"ticker": "AMD", "relevance_score": "0.1", "ticker_sentiment_label": "Bullish"},
        ],
    },
    {"title": "Second", "summary": "Two", "ticker_sentiment": []},
    {"title": "Third", "ticker_sentiment": [{"ticker": "AMD"}]},
]


def test_nested_feed(spark, tmp_path):
    (tmp_path / "feed.json").write_text(json.dumps({"items": "3", "feed": ARTICLES}))
    rows = feeds.read_nested_feed(spark, str(tmp_path / "feed.json"), "AMD").orderBy("headline").collect()
    assert [row["ticker_sentiment_score"] for row in rows] == [0.4, None, 0.0]
    assert [row["ticker_sentiment_label"] for row in rows] == ["Bearish", None, ""]
    assert rows[1]["overall_sentiment_score"] == 0 and rows[2]["content"] == "" and rows[0]["ticker"] == "AMD"


def test_flat_feed(spark, tmp_path):
    article = {"title": "T", "text": "X", "publishedDate": "2024-08-05 10:00:00", "site": "S", "symbol": "AMD"}
    (tmp_path / "flat.json").write_text(json.dumps([article]))
    row = feeds.read_flat_feed(spark, str(tmp_path / "flat.json"), "AMD").first()
    assert (row["headline"], row["content"], row["source"], row["image"]) == ("T", "X", "S", "")


def test_news_files_in_order_of_preference(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        files.read_news(spark, folder)
    header = "ticker,headline,content,timestamp,source,url,a,b,c,d\n"
    (tmp_path / "fmp_news.csv").write_text(header + 'A,"Flat, quoted","two\nlines",2024-08-05,S,u,,,,\n')
    assert files.read_news(spark, folder).first()["content"] == "two\nlines"
    (tmp_path / "combined_news.csv").write_text(header)
    with pytest.raises(ValueError, match="no articles"):
        files.read_news(spark, folder)


def test_bars_round_trip_with_pruned_folders(spark, bars, tmp_path):
    assert sinks.write_bars(bars, str(tmp_path))
    back = files.read_bars(spark, f"{tmp_path}/stock_prices.parquet")
    assert back.count() == bars.count()
    plan = back.where("ticker = 'AAA'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ticker" in plan
    assert not sinks.write_news(spark.createDataFrame([], "ticker string"), str(tmp_path))


def test_range_filter_reaches_the_scan(spark, bars, tmp_path):
    bars.write.parquet(f"{tmp_path}/b.parquet")
    scan = files.read_bars(spark, f"{tmp_path}/b.parquet").where(files.in_range(F.col("date"), "2024-02-01", "2024-03-01"))
    assert "GreaterThanOrEqual(date,2024-02-01)" in scan._jdf.queryExecution().toString()
    assert scan.agg(F.max("date")).first()[0].isoformat() < "2024-03-01"


def test_panel_checks(spark, tmp_path):
    spark.createDataFrame([("2024-01-02", "A", 1.0)], "date string, ticker string, x double").write.parquet(f"{tmp_path}/p.parquet")
    with pytest.raises(ValueError, match="no target"):
        files.read_panel(spark, f"{tmp_path}/p.parquet")


def test_feature_and_split_jobs(spark, bars, tmp_path):
    panel = technical.with_returns(bars).withColumns(
        {"article_count": F.lit(1), "combined_text": F.when(F.dayofmonth("date") % 2 == 0, "profit surge").otherwise("loss")}
    )
    features = jobs.feature_job(panel, str(tmp_path))
    assert features.where("target_return_1d IS NULL").isEmpty()
    assert {row[0] for row in features.select("finance_sentiment_ratio").distinct().collect()} == {1.0, -1.0}
    metadata = spark.read.csv(f"{tmp_path}/feature_metadata", header=True)
    assert metadata.where("feature_name = 'sma_20' AND feature_type = 'technical'").count() == 1
    tables = jobs.feature_summary(features)
    assert tables["top_features"].count() == 9

    columns = ["close", "volume", "rsi_14"]
    jobs.split_job(features.select("ticker", "date", *columns, "target_direction_1d"), str(tmp_path / "splits"), columns)
    parts = files.read_splits(spark, str(tmp_path / "splits"))
    row = parts["train"].agg(F.avg("close"), F.stddev_pop("volume")).first()
    assert abs(row[0]) < 1e-9 and abs(row[1] - 1) < 1e-9
    stored = json.loads(spark.read.text(f"{tmp_path}/splits/metadata.json").first()[0])
    assert stored["train_samples"] + stored["val_samples"] + stored["test_samples"] == features.count()


def test_checkpoint_folder_is_the_named_one(spark):
    current = session.checkpoint_folder(spark)
    assert current and session.checkpoint_folder(spark) == current
    cut = session.materialize(spark.range(5))
    assert cut.count() == 5
