"""Jobs on the driver tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from catalog.tables import Tables
from tickerloom.operators import daily_news, technical, trades
from tickerloom.plans import jobs
from tickerloom.session import pin_semantics
from tickerloom.sources import sinks

FOLDER = "/root/testdata/sf0.001"


def with_copies(bars):
    """Every bar twice more: once as it is, once with higher values."""
    higher = bars.withColumns({name: F.col(name) + 1 for name in jobs.BAR_ORDER})
    return bars.unionByName(higher).unionByName(bars)


def rows(df, *columns):
    kinds = dict(df.dtypes)
    shown = [F.round(c, 9).alias(c) if kinds[c] == "double" else F.col(c) for c in columns]
    return sorted(tuple(r) for r in df.select(*shown).collect())


def test_repeated_bars_leave_the_panel_as_it_is(spark):
    t = Tables(pin_semantics(spark), FOLDER)
    once = jobs.merged_panel(t.news, t.bars, ["doc_id"])
    repeated = jobs.merged_panel(t.news, with_copies(t.bars), ["doc_id"])
    columns = ("ticker", "date", "open", "close", "volume", "article_count")
    expected = rows(once, *columns)
    assert expected and rows(repeated, *columns) == expected
    assert repeated.groupBy("ticker", "date").count().where("count > 1").isEmpty()


def test_windows_and_positions_on_a_panel_of_repeated_bars(spark):
    t = Tables(pin_semantics(spark), FOLDER)
    strategy = trades.Strategy("rising", "daily_return > 0", "1", "0.5D", 3)
    found = []
    for bars in (t.bars, with_copies(t.bars)):
        panel = jobs.merged_panel(t.news, bars, ["doc_id"])
        features = technical.technical_features(panel)
        found.append(
            (
                rows(features.na.fill(0), "ticker", "date", "close", "sma_5", "volatility_5d"),
                rows(trades.positions(panel, strategy).where("exit_date IS NOT NULL"), "ticker", "entry_date", "exit_date", "exit_price"),
            )
        )
    assert found[0][0] and found[0][1]
    assert found[0] == found[1]


def make_scorer():
    """Functions of a test module cannot be imported by workers; ones made here travel whole."""

    def length_scorer():
        return lambda texts: {"vader_compound": [len(text) % 7 / 7 for text in texts]}

    return length_scorer


def test_days_are_scored_part_by_part(spark):
    rows = [("A", f"head {k}", f"body number {k} " + "word " * (k % 5), "2024-03-04 10:00:00", k) for k in range(40)]
    rows += [("B", "single", "one article of the day with words", "2024-03-05 10:00:00", 99)]
    news = spark.createDataFrame(rows, "ticker string, headline string, content string, timestamp string, doc_id long")
    news = news.withColumn("timestamp", F.to_timestamp("timestamp"))
    parts = daily_news.daily_text(news, ["doc_id"]).collect()
    got = {r["ticker"]: r["vader_compound"] for r in jobs.scored_days(news, ["doc_id"], [make_scorer()]).collect()}
    for ticker in ("A", "B"):
        texts = [r["combined_text"] for r in parts if r["ticker"] == ticker]
        weights = [max(1, len(t)) for t in texts]
        expected = sum(len(t) % 7 / 7 * w for t, w in zip(texts, weights)) / sum(weights)
        assert abs(got[ticker] - expected) < 1e-12
    assert sum(r["ticker"] == "B" for r in parts) == 1


def test_scorers_reach_the_panel_or_are_refused(spark):
    t = Tables(pin_semantics(spark), FOLDER)
    panel = jobs.merged_panel(t.news, t.bars, ["doc_id"], factories=[make_scorer()])
    scored = jobs.with_sentiment(panel, [make_scorer()])
    assert scored.where("article_count > 0 AND vader_compound > 0").count() > 0
    assert scored.where("article_count = 0 AND vader_compound <> 0").isEmpty()
    with pytest.raises(ValueError, match="no text to score"):
        jobs.with_sentiment(t.bars, [make_scorer()])


def test_files_to_panel(spark, tmp_path):
    t = Tables(pin_semantics(spark), FOLDER)
    folder = str(tmp_path)
    sinks.write_news(t.news.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")), folder)
    sinks.write_bars(t.bars, folder)
    panel = jobs.panel_job(spark, folder, f"{folder}/stock_prices.parquet", f"{folder}/out", ["timestamp", "url"])
    assert panel.count() == spark.read.json(f"{folder}/out/data_summary.json").first()["rows"] > 0
    manifest = spark.read.parquet(sinks.manifest_path(f"{folder}/out/merged_panel.parquet"))
    assert manifest.agg(F.sum("rows")).first()[0] == panel.count()
    assert spark.read.parquet(f"{folder}/out/price_summary.parquet").count() == panel.select("ticker").distinct().count()


def test_panel_prepares_every_text_once(spark, monkeypatch):
    """Counts, keywords and scores read stored articles; a text is prepared in one plan only."""
    rows = [(n, "A", f"headline number {n}", f"profit and loss of item {n} grew.", datetime.datetime(2024, 1, 2 + n % 3, 15)) for n in range(12)]
    news = spark.createDataFrame(rows, "doc_id long, ticker string, headline string, content string, timestamp timestamp")
    days = [("A", datetime.date(2024, 1, 1 + n), 1.0, 1.0, 1.0, 1.0 + n / 10, 5.0) for n in range(8)]
    bars = spark.createDataFrame(days, "ticker string, date date, open double, high double, low double, close double, volume double")
    calls, prepare = [], jobs.daily_news.prepare_articles
    monkeypatch.setattr(jobs.daily_news, "prepare_articles", lambda df: calls.append(1) or prepare(df))
    panel = jobs.merged_panel(news, bars, ["doc_id"], factories=[make_scorer()])
    assert calls == [1]
    plan = panel._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "min_by" not in plan.lower()
    assert panel.agg(F.sum("article_count")).first()[0] > 0 and panel.where("finance_positive_count > 0").count() > 0
