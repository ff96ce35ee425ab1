"""Keyword sentiment and the composite score as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickerloom.functions import fixed_values as fixed
from tickerloom.functions.text import pieces

KEYWORD_COLUMNS = ("finance_positive_count", "finance_negative_count", "finance_sentiment_ratio")


def _hits(tokens: Column, vocabulary: list[str]) -> Column:
    return F.size(F.filter(tokens, lambda token: token.isin(vocabulary)))


def keyword_counts(text: Column) -> tuple[Column, Column]:
    tokens = pieces(F.lower(F.coalesce(text, F.lit(""))))
    return _hits(tokens, fixed.POSITIVE_FINANCE_WORDS), _hits(tokens, fixed.NEGATIVE_FINANCE_WORDS)


def sentiment_ratio(positive: Column, negative: Column) -> Column:
    return F.coalesce(F.try_divide(positive - negative, positive + negative), F.lit(0.0))


def composite_sentiment(
    compound: Column, polarity: Column, positive: Column, negative: Column, ratio: Column
) -> Column:
    """Weighted mean over the scores present; 0 when none is."""
    parts = [
        (compound, fixed.COMPOSITE_WEIGHTS["vader_compound"]),
        (polarity, fixed.COMPOSITE_WEIGHTS["textblob_polarity"]),
        (positive - negative, fixed.COMPOSITE_WEIGHTS["finbert"]),
        (ratio, fixed.COMPOSITE_WEIGHTS["finance_sentiment_ratio"]),
    ]
    total = sum((F.coalesce(score * weight, F.lit(0.0)) for score, weight in parts), F.lit(0.0))
    weights = sum((F.when(score.isNotNull(), weight).otherwise(0.0) for score, weight in parts), F.lit(0.0))
    return F.coalesce(F.try_divide(total, weights), F.lit(0.0))
