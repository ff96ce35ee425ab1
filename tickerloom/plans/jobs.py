"""The three jobs: raw files to merged panel, panel to features, features to models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickerloom.models import training
from tickerloom.operators import cleaning, daily_news, merge, metrics, panel_features, profile, scoring, splits, technical
from tickerloom.session import materialize, written
from tickerloom.sources import files, sinks


BAR_ORDER = ("open", "high", "low", "close", "volume")


def merged_panel(
    news: DataFrame,
    bars: DataFrame,
    order: Iterable[str],
    bar_order: Iterable[str] = BAR_ORDER,
    factories: Iterable[scoring.ScorerFactory] = (),
) -> DataFrame:
    """Cleaned news joined onto bars with returns, then validity and outlier filters.

    Of several bars of a ticker and day the first by `bar_order` counts; every window over a
    ticker rests on that. Keyword sentiment comes from the articles' counts; with `factories` the
    days' texts are scored as well, in ordered parts (see `scored_days`), and the panel has all
    scores and their composite.
    """
    order, factories = list(order), list(factories)
    bars = cleaning.keep_first(bars, ["ticker", "date"], bar_order)
    cleaned = cleaning.clean_news(news, order)
    prepared = daily_news.with_trading_date(daily_news.prepare_articles(cleaned))
    kept = {*order, "ticker", "timestamp", "trading_date", "headline", "headline_chars", "content_chars", "total_chars", "combined_text"}
    # Preparing texts is the expensive step: its result is stored, and every aggregate reads its own columns.
    articles = written(prepared.select(*[name for name in prepared.columns if name in kept]), "articles")
    stats = daily_news.daily_news(articles)
    keywords = daily_news.daily_keywords(articles)
    daily = stats.join(keywords, ["ticker", "trading_date"])
    priced = technical.with_returns(bars)
    filled = ["finance_positive_count", "finance_negative_count", "finance_sentiment_ratio"]
    if factories:
        daily = daily.join(scored_days(articles, order, factories), ["ticker", "trading_date"], "left")
        filled += scoring.EXTERNAL_SCORES
    # A row per ticker and day, which the filters read twice.
    panel = materialize(merge.attach_daily_news(priced, daily).na.fill(0, subset=filled))
    if factories:
        inputs = ("vader_compound", "textblob_polarity", "finbert_positive", "finbert_negative", "finance_sentiment_ratio")
        panel = panel.withColumn("composite_sentiment", scoring.sentiment.composite_sentiment(*map(F.col, inputs)))
    return cleaning.clean_and_validate(panel)


def scored_days(articles: DataFrame, order: Iterable[str], factories: Iterable[scoring.ScorerFactory]) -> DataFrame:
    """Scores of every ticker-day's text, from its ordered parts.

    A day's text is scored part by part and the scores are averaged by the parts' lengths, so a day of any
    size is never one string; a day of one part, which is any ordinary day, has its text's own scores.
    """
    parts = daily_news.daily_text(articles, order)
    scored = scoring.external_scores(parts, "combined_text", factories)
    length = F.greatest(F.length("combined_text"), F.lit(1))
    return scored.groupBy("ticker", "trading_date").agg(
        *[(F.sum(F.col(name) * length) / F.sum(length)).alias(name) for name in scoring.EXTERNAL_SCORES]
    )


def panel_job(spark: SparkSession, news_folder: str, bars_path: str, folder: str, order: Iterable[str], suffix: str = ".parquet") -> DataFrame:
    """Files to panel: reads and checks both tables, merges them, stores the panel in order with its summaries."""
    news = files.read_news(spark, news_folder, suffix)
    bars = files.read_bars(spark, bars_path)
    path = f"{folder}/merged_panel.parquet"
    sinks.write_panel(merged_panel(news, bars, order), path)
    stored = spark.read.parquet(path)
    sinks.write_table(profile.dataset_summary(stored), f"{folder}/data_summary.json", "json")
    sinks.write_table(profile.price_summary(stored), f"{folder}/price_summary.parquet", order=("ticker",))
    return stored


def with_sentiment(panel: DataFrame, factories: Iterable[scoring.ScorerFactory] = ()) -> DataFrame:
    """Sentiment columns, unless the panel has them.

    From `combined_text` where the panel carries it, else from the days' scores (`merged_panel` with
    scorers) and its keyword ratio. Scorers for a panel that carries neither are an error.
    """
    factories = list(factories)
    if cleaning.sentiment_columns(panel):
        return panel
    if "combined_text" in panel.columns:
        return scoring.analyze_dataframe(panel, "combined_text", factories)
    if factories:
        raise ValueError("the panel has no text to score: give the scorers to merged_panel")
    if "finance_sentiment_ratio" in panel.columns:
        zero = F.lit(0.0)
        composite = scoring.sentiment.composite_sentiment(zero, zero, zero, zero, F.col("finance_sentiment_ratio"))
        return panel.withColumn("composite_sentiment", composite)
    return panel


def feature_panel(
    panel: DataFrame,
    sentiment_lags: Iterable[int] = (1, 3, 5),
    horizons: Iterable[int] = (1, 3),
    max_missing: float = 0.5,
) -> DataFrame:
    """All features; rows without the first target or with too many gaps leave, gaps are filled."""
    features = panel_features.all_features(panel, sentiment_lags, horizons)
    targets = cleaning.target_columns(features)
    kept = cleaning.drop_missing(features, targets[:1])
    names = [
        name for name in features.columns if not name.startswith(("ticker", "date", "target_"))
    ]
    numeric = set(cleaning.numeric_columns(features))
    filled = technical.fill_forward_backward(
        cleaning.few_missing(kept, names, max_missing), [name for name in names if name in numeric]
    )
    return filled


def feature_job(
    panel: DataFrame, folder: str, factories: Iterable[scoring.ScorerFactory] = (), **options: Any
) -> DataFrame:
    """Scores, builds, fills and stores the features with their metadata.

    Text scoring is the expensive stage, so its result is stored before the features
    are derived; a lost executor then costs no second scoring.
    """
    spark = panel.sparkSession
    scored_path = f"{folder}/data_with_sentiment.parquet"
    sinks.write_table(with_sentiment(panel, factories), scored_path)
    features = feature_panel(spark.read.parquet(scored_path), **options)
    sinks.write_panel(features, f"{folder}/features.parquet")
    stored = spark.read.parquet(f"{folder}/features.parquet")
    sinks.write_table(profile.feature_metadata(stored), f"{folder}/feature_metadata", "csv")
    return stored


def feature_summary(features: DataFrame) -> dict[str, DataFrame]:
    """The numbers of the feature report as tables."""
    targets = cleaning.target_columns(features)
    inputs = cleaning.feature_columns(features)
    spark = features.sparkSession
    families = list(profile.feature_families(features.columns).items())
    tables = {
        "families": spark.createDataFrame(families, "family string, features int"),
        "quality": profile.null_overview(features),
        "top_features": profile.top_correlated(features, inputs, targets[0]),
    }
    for name in targets[:3]:
        labels = "direction" in name or "multiclass" in name
        tables[name] = profile.value_counts(features, name) if labels else profile.describe(features, [name])
    return tables


def split_job(panel: DataFrame, folder: str, features: Iterable[str]) -> dict[str, DataFrame]:
    """Row splits in time order, scaled by the train split, stored raw and scaled."""
    features = list(features)
    tagged = materialize(splits.with_row_split(panel))
    raw = {name: tagged.where(F.col("split") == name).drop("split") for name in splits.SPLITS}
    scaled = splits.scale_splits(raw, features)
    metadata = {
        "feature_columns": features,
        "target_columns": cleaning.target_columns(panel),
        "categorical_columns": cleaning.string_columns(panel),
        "date_column": "date",
        "total_features": len(features),
        **{f"{name}_samples": df.count() for name, df in raw.items()},
    }
    sinks.write_splits(raw, scaled, folder, metadata)
    return scaled


def training_job(
    spark: SparkSession,
    features: DataFrame,
    target: str,
    names: Mapping[str, Mapping[str, Any]],
    folder: str,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Date splits, all models, validation results, the best model and a soft vote of three.

    The prepared rows are cut from their lineage once and read by every fit.
    """
    columns = list(columns) if columns is not None else cleaning.feature_columns(features)
    ready = materialize(features.select("ticker", "date", *columns, target))
    parts = splits.split_by_date(ready)
    fitted, results = training.train_all(parts["train"], parts["val"], target, columns, names)
    ranked = metrics.best_first(materialize(results), "accuracy")
    best = [row["model"] for row in metrics.best_first(ranked, "accuracy", 3).select("model").collect()]
    fitted[best[0]].save(spark, f"{folder}/best_model")
    both = parts["train"].unionByName(parts["val"])
    refitted = [training.train(both, target, columns, name, names[name]) for name in best]
    voted = training.soft_vote(refitted, parts["test"])
    ensemble = metrics.classification_metrics(voted, target, "ensemble_prediction", "ensemble_probability")
    sinks.write_table(ranked, f"{folder}/results.json", "json")
    return ranked.unionByName(ensemble.withColumn("model", F.lit("soft_vote")))


