"""Profiling: describe, correlations, censuses, summaries, tests and word counts."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.functions import fixed_values as fixed, text
from tickerloom.functions.numeric import count_true, sample_skewness
from tickerloom.operators.moments import column_moments, correlations
from tickerloom.operators.quantiles import quantile_profile

YEAR = fixed.TRADING_DAYS_PER_YEAR


def describe(df: DataFrame, columns: Iterable[str], measures: Callable[[str], list[Column]] = lambda name: []) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum per column, then what `measures` gives.

    Two passes: one for moments and a quantile sketch, one that counts around the quartiles.
    """

    def moments(name: str) -> list[Column]:
        value = F.col(name).cast("double")
        return [
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            *measures(name),
        ]

    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = quantile_profile(df, columns, quartiles, measures=moments).withColumnRenamed("_present", "count")
    shown = ["column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    return found.select(*shown, *[name for name in found.columns if name not in shown])


def safe_corr(left: str, right: str) -> Column:
    """Pearson correlation over pairwise present rows; null without spread."""
    both = F.col(left).isNotNull() & F.col(right).isNotNull()
    x, y = F.when(both, F.col(left).cast("double")), F.when(both, F.col(right).cast("double"))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.try_divide(F.covar_pop(x, y), F.when(spread > 0, spread))


def correlation_matrix(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Pairwise correlations over rows complete in all columns: (left, right, correlation)."""
    columns = list(columns)
    complete = df.select(*[F.col(name).cast("double").alias(name) for name in columns]).na.drop()
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(complete)
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    rows = [
        (left, right, float(matrix[i, j])) for i, left in enumerate(columns) for j, right in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, "left string, right string, correlation double")


def correlated_pairs(df: DataFrame, columns: Iterable[str], threshold: float = 0.95) -> DataFrame:
    """Column pairs with |r| above the threshold, over pairwise present rows: one pass for all pairs."""
    columns = list(columns)
    place = {name: i for i, name in enumerate(columns)}
    places = F.create_map(*[F.lit(item) for pair in place.items() for item in pair])
    return (
        correlations(df, columns, columns)
        .where(places[F.col("left")] < places[F.col("right")])
        .select(F.col("left").alias("feature1"), F.col("right").alias("feature2"), F.abs("correlation").alias("correlation"))
        .where(F.col("correlation") > threshold)
    )


def target_correlations(df: DataFrame, features: Iterable[str], target: str) -> DataFrame:
    found = correlations(df, features, [target])
    return found.select(F.col("left").alias("column"), F.abs("correlation").alias("correlation"))


def top_correlated(df: DataFrame, features: Iterable[str], target: str, top: int = 10) -> DataFrame:
    """The target takes the first of the `top` places, so `top - 1` features remain."""
    ranked = target_correlations(df, features, target).where(F.col("correlation").isNotNull())
    return ranked.orderBy(F.desc("correlation"), "column").limit(top - 1)


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("count"))


def null_census(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    missing = F.col("rows") - F.col("count")
    return column_moments(df, columns or df.columns).select(
        "column", missing.alias("missing_count"), F.try_divide(missing * 100.0, F.col("rows")).alias("missing_percentage")
    )


def null_overview(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Overall share of missing cells, complete rows, columns above 10/20/50 % missing."""
    columns = list(columns or df.columns)
    missing = count_true([F.col(name).isNull() for name in columns])
    counts = df.agg(F.struct(F.count("*").alias("rows"), F.count_if(missing == 0).alias("complete")).alias("c")).scalar()
    share = F.col("missing_percentage")
    return null_census(df, columns).agg(
        counts["rows"].alias("rows"),
        counts["complete"].alias("complete_rows"),
        F.try_divide(F.sum("missing_count") * 100.0, counts["rows"] * len(columns)).alias("missing_percentage"),
        *[F.sum((share > limit).cast("int")).cast("int").alias(f"columns_above_{limit}") for limit in (10, 20, 50)],
    )


def infinity_census(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return column_moments(df, columns).select("column", "infinite_count")


def bar_quality(bars: DataFrame) -> DataFrame:
    """Negative price cells, zero-volume rows, high below low, open or close out of range."""
    negative = [F.count_if(F.col(name) < 0) for name in ("open", "high", "low", "close")]
    out = (
        (F.col("open") > F.col("high"))
        | (F.col("open") < F.col("low"))
        | (F.col("close") > F.col("high"))
        | (F.col("close") < F.col("low"))
    )
    return bars.agg(
        sum(negative[1:], negative[0]).alias("negative_prices"),
        F.count_if(F.col("volume") == 0).alias("zero_volume"),
        F.count_if(F.col("high") < F.col("low")).alias("high_below_low"),
        F.count_if(out).alias("outside_range"),
    )


def price_summary(bars: DataFrame) -> DataFrame:
    """Date range and close, volume and return statistics per ticker, to 4 digits."""
    return bars.groupBy("ticker").agg(
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        F.count("date").alias("date_count"),
        F.bround(F.min("close"), 4).alias("close_min"),
        F.bround(F.max("close"), 4).alias("close_max"),
        F.bround(F.avg("close"), 4).alias("close_mean"),
        F.bround(F.avg("volume"), 4).alias("volume_mean"),
        F.bround(F.avg("daily_return"), 4).alias("return_mean"),
        F.bround(F.stddev_samp("daily_return"), 4).alias("return_std"),
    )


def returns_summary(bars: DataFrame) -> DataFrame:
    """Return statistics per ticker to 4 digits; Sharpe from the rounded mean and deviation."""
    value = "daily_return"
    rounded = bars.groupBy("ticker").agg(
        F.count(value).alias("count"),
        F.bround(F.avg(value), 4).alias("mean"),
        F.bround(F.stddev_samp(value), 4).alias("std"),
        F.bround(F.min(value), 4).alias("min"),
        F.bround(F.max(value), 4).alias("max"),
        F.bround(sample_skewness(value), 4).alias("skew"),
    )
    sharpe = F.try_divide(F.col("mean"), F.col("std")) * math.sqrt(YEAR)
    return rounded.withColumn("sharpe_ratio", F.bround(sharpe, 4))


def dataset_summary(panel: DataFrame) -> DataFrame:
    """Size, date range, news coverage and return statistics of a merged panel."""
    covered = F.col("article_count") > 0
    mean, deviation = F.avg("daily_return"), F.stddev_samp("daily_return")
    return panel.agg(
        F.count("*").alias("rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_distinct("ticker").alias("tickers"),
        (F.avg(covered.cast("double")) * 100).alias("news_coverage_percentage"),
        F.avg(F.when(covered, F.col("article_count"))).alias("articles_per_news_day"),
        mean.alias("return_mean"),
        deviation.alias("return_std"),
        (mean * YEAR).alias("return_annualised"),
        (deviation * math.sqrt(YEAR)).alias("volatility_annualised"),
        F.min("daily_return").alias("return_min"),
        F.max("daily_return").alias("return_max"),
    )


def feature_class(name: str) -> tuple[str, str]:
    """Class and description of a column by its name; the first matching rule wins."""
    if name.startswith("target_"):
        return "target", "Target variable for prediction"
    for kind, description, keywords in fixed.FEATURE_CLASSES:
        if any(word in name.lower() for word in keywords):
            return kind, description
    return "unknown", ""


def feature_metadata(df: DataFrame) -> DataFrame:
    """Class, type, missing share and moments of every column but the row ids."""
    types = dict(df.dtypes)
    columns = [name for name in df.columns if name not in ("ticker", "date", "timestamp")]
    names = df.sparkSession.createDataFrame(
        [(name, *feature_class(name), types[name]) for name in columns],
        "feature_name string, feature_type string, description string, data_type string",
    )
    missing = F.col("rows") - F.col("count")
    found = column_moments(df, columns).select(
        F.col("column").alias("feature_name"),
        missing.alias("missing_count"),
        F.try_divide(missing * 100.0, F.col("rows")).alias("missing_percentage"),
        "mean",
        "std",
        "min",
        "max",
    )
    return names.join(found, "feature_name")


def feature_families(columns: Iterable[str]) -> dict[str, int]:
    """How many columns fall in each of the overlapping families."""
    columns = list(columns)
    counts = {
        family: sum(any(word in name.lower() for word in keywords) for name in columns)
        for family, keywords in fixed.FEATURE_FAMILIES.items()
    }
    counts["Target Variables"] = sum(name.startswith("target_") for name in columns)
    return counts


def sentiment_summary(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """`describe` of the sentiment columns with their correlation with the return."""
    if "daily_return" not in df.columns:
        return describe(df, columns)
    return describe(df, columns, lambda name: [safe_corr(name, "daily_return").alias("correlation_with_returns")])


# Up to here the continued fraction converges within some ten thousand steps.
NORMAL_FREEDOM = 1e8


def student_two_sided(statistic: float, freedom: float) -> float:
    """Two-sided tail of Student's t: the regularised incomplete beta function at
    x = v/(v+t^2) with parameters v/2 and 1/2, by its continued fraction."""
    if freedom > NORMAL_FREEDOM:
        # Beyond this freedom the tail is a normal one of the shrunk statistic, to an error of order 1/freedom^2.
        shrunk = statistic * (1 - 1 / (4 * freedom)) / math.sqrt(1 + statistic * statistic / (2 * freedom))
        return math.erfc(abs(shrunk) / math.sqrt(2))
    x = freedom / (freedom + statistic * statistic)
    a, b = freedom / 2, 0.5
    if x <= 0 or x >= 1:
        return float(x >= 1)
    flipped = x > (a + 1) / (a + b + 2)
    if flipped:
        a, b, x = b, a, 1 - x
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    fraction = d
    for m in itertools.count(1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / (1 + even * d)
        c = 1 + even / c
        fraction *= c * d
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + odd * d)
        c = 1 + odd / c
        fraction *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    tail = math.exp(log_front) * fraction / a
    return 1 - tail if flipped else tail


def _add_p_values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch["p_value"] = [student_two_sided(t, v) for t, v in zip(batch["t_statistic"], batch["freedom"])]
        batch["significant"] = (batch["p_value"] < 0.05).astype("int32")
        yield batch


def news_day_test(panel: DataFrame) -> DataFrame:
    """Pooled two-sample t-test of returns on days with and without news (one row)."""
    news = F.col("article_count") > 0
    other = F.col("article_count") == 0
    value = F.col("daily_return")
    moments = panel.agg(
        F.count(F.when(news, value)).alias("n_news"),
        F.count(F.when(other, value)).alias("n_other"),
        F.avg(F.when(news, value)).alias("mean_news"),
        F.avg(F.when(other, value)).alias("mean_other"),
        F.stddev_samp(F.when(news, value)).alias("std_news"),
        F.stddev_samp(F.when(other, value)).alias("std_other"),
    )
    freedom = F.col("n_news") + F.col("n_other") - 2
    pooled = F.try_divide(
        (F.col("n_news") - 1) * F.col("std_news") ** 2 + (F.col("n_other") - 1) * F.col("std_other") ** 2, freedom
    )
    error = F.sqrt(pooled * (F.lit(1.0) / F.col("n_news") + F.lit(1.0) / F.col("n_other")))
    result = (
        moments.where((F.col("n_news") > 1) & (F.col("n_other") > 1))
        .withColumn("freedom", freedom.cast("double"))
        .withColumn("t_statistic", F.try_divide(F.col("mean_news") - F.col("mean_other"), error))
        .where(F.col("t_statistic").isNotNull())
    )
    return result.mapInPandas(_add_p_values, f"{_ddl(result)}, p_value double, significant int")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def top_words(news: DataFrame, top: int = 20) -> DataFrame:
    """Most frequent headline words; equal counts in word order."""
    found = news.select(F.explode(text.headline_words(F.col("headline"))).alias("word"))
    return value_counts(found, "word").orderBy(F.desc("count"), "word").limit(top)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
