"""Text scoring: pluggable scorers run in batches, keyword scores in Spark expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tickerloom.functions import sentiment

# A scorer maps a batch of texts to one float list per score name.
Scorer = Callable[[list[str]], Mapping[str, list[float]]]
# A factory is called once per Python worker, where it loads lexicons or weights.
ScorerFactory = Callable[[], Scorer]

LEXICON_SCORES = ("vader_compound", "vader_positive", "vader_negative", "vader_neutral")
POLARITY_SCORES = ("textblob_polarity", "textblob_subjectivity")
MODEL_SCORES = ("finbert_positive", "finbert_negative", "finbert_neutral")
EXTERNAL_SCORES = LEXICON_SCORES + POLARITY_SCORES + MODEL_SCORES

def _run(factories: list[ScorerFactory], column: str, outputs: tuple[str, ...], batch_size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorers = [factory() for factory in factories]
        for batch in batches:
            for start in range(0, len(batch), batch_size):
                part = batch.iloc[start : start + batch_size].copy()
                for name in outputs:
                    part[name] = 0.0
                texts = part[column].fillna("")
                filled = texts[texts != ""]
                for scorer in scorers:
                    if len(filled):
                        for name, values in scorer(filled.tolist()).items():
                            part.loc[filled.index, name] = values
                yield part

    return run


def external_scores(
    df: DataFrame,
    column: str,
    factories: Iterable[ScorerFactory] = (),
    outputs: tuple[str, ...] = EXTERNAL_SCORES,
    batch_size: int = 64,
) -> DataFrame:
    """Adds the scorers' columns; a score no scorer gives is 0, and an empty text scores 0.

    Without scorers the zeros are literals and no Python runs.
    """
    factories = list(factories)
    if not factories:
        return df.withColumns({name: F.lit(0.0) for name in outputs})
    schema = ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
    schema += "".join(f", {name} double" for name in outputs)
    return df.mapInPandas(_run(factories, column, outputs, batch_size), schema)


def analyze_dataframe(
    df: DataFrame, column: str = "combined_text", factories: Iterable[ScorerFactory] = ()
) -> DataFrame:
    """Adds all external scores, the keyword scores and the composite score of a text column."""
    scored = external_scores(df, column, factories)
    positive, negative = sentiment.keyword_counts(F.col(column))
    counted = scored.withColumns({"finance_positive_count": positive, "finance_negative_count": negative})
    ratio = counted.withColumn(
        "finance_sentiment_ratio",
        sentiment.sentiment_ratio(F.col("finance_positive_count"), F.col("finance_negative_count")),
    )
    composite = sentiment.composite_sentiment(
        *[F.col(name) for name in ("vader_compound", "textblob_polarity", "finbert_positive", "finbert_negative")],
        F.col("finance_sentiment_ratio"),
    )
    return ratio.withColumn("composite_sentiment", composite)


SHORT_NAMES = {"vader_positive": "vader_pos", "vader_negative": "vader_neg", "vader_neutral": "vader_neu"}
CONTENT_SCORES = ("vader_compound", "textblob_polarity", "finbert_positive", "composite_sentiment")


def headline_sentiment(news: DataFrame, factories: Iterable[ScorerFactory] = ()) -> DataFrame:
    """Every score of the headline as `headline_<score>`."""
    before = set(news.columns)
    scored = analyze_dataframe(news, "headline", factories)
    names = {n: f"headline_{SHORT_NAMES.get(n, n)}" for n in scored.columns if n not in before}
    return scored.withColumnsRenamed(names)


def content_sentiment(scored: DataFrame, factories: Iterable[ScorerFactory] = ()) -> DataFrame:
    """Adds the scores of every article's content as `content_<score>`."""
    content = analyze_dataframe(scored.withColumn("_content", F.col("content")), "_content", factories)
    extra = [c for c in content.columns if c not in scored.columns and c not in CONTENT_SCORES]
    return content.withColumnsRenamed({name: f"content_{name}" for name in CONTENT_SCORES}).drop(*extra)
