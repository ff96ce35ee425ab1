"""Profiling, sentiment, splits and scaling."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, functions as F

from catalog import sql_text as q
from catalog.cleaning_queries import MERGED, RETURNS
from catalog.registry import query
from catalog.window_queries import DAILY, daily_panel, roll
from tickerloom.functions import fixed_values as fixed, sentiment
from tickerloom.functions.numeric import rolling
from tickerloom.operators import cleaning, daily_news, merge, profile, scoring, splits, technical

RET = ["daily_return", "volume", "close"]


def describe_sql(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min,
            quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75,
            CAST(max({c}) AS DOUBLE) AS max FROM r"""
        for c in columns
    ).join([f"WITH r AS MATERIALIZED ({source}) ", ""])


query("describe", "mean:4 std:4 min:4 q25:4 q50:4 q75:4 max:4", describe_sql(RETURNS, RET))(
    lambda t: profile.describe(t.returns, RET)
)

query(
    "describe_lengths",
    "mean:4 std:4 min:4 q25:4 q50:4 q75:4 max:4",
    describe_sql(
        "SELECT length(headline)::DOUBLE AS headline_length, length(content)::DOUBLE AS content_length FROM news",
        ["headline_length", "content_length"],
    ),
)(
    lambda t: profile.describe(
        t.news.select(F.length("headline").alias("headline_length"), F.length("content").alias("content_length")),
        ["headline_length", "content_length"],
    )
)

KEYWORDS = f"""SELECT doc_id, ticker, headline, content, timestamp, {q.hits('headline', fixed.POSITIVE_FINANCE_WORDS)} AS p,
    {q.hits('headline', fixed.NEGATIVE_FINANCE_WORDS)} AS n FROM news"""
SCORES = [c for c in scoring.EXTERNAL_SCORES]

query(
    "keyword_score",
    "finance_sentiment_ratio",
    f"""SELECT doc_id, p::BIGINT AS finance_positive_count, n::BIGINT AS finance_negative_count, {q.ratio('p', 'n')} AS finance_sentiment_ratio
        FROM ({KEYWORDS})""",
)(
    lambda t: t.news.select("doc_id", *[c.cast("bigint").alias(name) for c, name in zip(sentiment.keyword_counts(F.col("headline")), ("p", "n"))])
    .select(
        "doc_id",
        F.col("p").alias("finance_positive_count"),
        F.col("n").alias("finance_negative_count"),
        sentiment.sentiment_ratio(F.col("p"), F.col("n")).alias("finance_sentiment_ratio"),
    )
)

query(
    "composite_sentiment",
    "composite",
    """SELECT doc_id, CASE WHEN a IS NULL AND r IS NULL AND p IS NULL THEN 0 ELSE
          (coalesce(0.3 * a, 0) + coalesce(0.2 * r, 0) + coalesce(0.4 * (p - 0.25), 0) + 0) /
          (CASE WHEN a IS NULL THEN 0 ELSE 0.3 END + CASE WHEN r IS NULL THEN 0 ELSE 0.2 END + CASE WHEN p IS NULL THEN 0 ELSE 0.4 END) END::DOUBLE AS composite
        FROM (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN (doc_id % 7) / 7 END AS a, CASE WHEN doc_id % 5 > 0 THEN (doc_id % 11) / 11 END AS r,
          CASE WHEN doc_id % 4 > 0 THEN (doc_id % 13) / 13 END AS p FROM documents)""",
)(
    lambda t: t.read("documents")
    .select(
        "doc_id",
        F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 7 / F.lit(7.0)).alias("a"),
        F.when(F.col("doc_id") % 5 > 0, F.col("doc_id") % 11 / F.lit(11.0)).alias("r"),
        F.when(F.col("doc_id") % 4 > 0, F.col("doc_id") % 13 / F.lit(13.0)).alias("p"),
    )
    .select(
        "doc_id",
        sentiment.composite_sentiment(
            F.col("a"), F.col("r"), F.col("p"), F.lit(0.25), F.lit(None).cast("double")
        ).alias("composite"),
    )
)

query(
    "analyze_dataframe",
    " ".join(SCORES) + " finance_sentiment_ratio composite_sentiment",
    f"""SELECT doc_id, {', '.join(f'0.0::DOUBLE AS {c}' for c in SCORES)}, p::INT AS finance_positive_count, n::INT AS finance_negative_count,
          {q.ratio('p', 'n')} AS finance_sentiment_ratio, 0.1 * {q.ratio('p', 'n')} AS composite_sentiment FROM ({KEYWORDS})""",
)(
    lambda t: scoring.analyze_dataframe(t.news, "headline").select(
        "doc_id", *SCORES, *sentiment.KEYWORD_COLUMNS, "composite_sentiment"
    )
)


def length_scorer():
    """A stand-in for a packaged scorer: texts in, one list per score out."""

    def score(texts):
        return {
            "vader_compound": [len(text) % 7 / 7 for text in texts],
            "textblob_polarity": [len(text) % 5 / 5 for text in texts],
            "finbert_positive": [len(text) % 3 / 3 for text in texts],
        }

    return score


PLUGGED = """(0.3 * (length({c}) % 7 / 7) + 0.2 * (length({c}) % 5 / 5) + 0.4 * (length({c}) % 3 / 3) + 0.1 * {ratio})"""
query(
    "plugged_scorer",
    "headline_vader_compound headline_textblob_polarity headline_finbert_positive headline_composite_sentiment",
    f"""SELECT doc_id, length(headline) % 7 / 7 AS headline_vader_compound, length(headline) % 5 / 5 AS headline_textblob_polarity,
          length(headline) % 3 / 3 AS headline_finbert_positive,
          {PLUGGED.format(c='headline', ratio=q.ratio('p', 'n'))} AS headline_composite_sentiment FROM ({KEYWORDS})""",
)(
    lambda t: scoring.headline_sentiment(t.news, [length_scorer]).select(
        "doc_id",
        "headline_vader_compound",
        "headline_textblob_polarity",
        "headline_finbert_positive",
        "headline_composite_sentiment",
    )
)

CONTENT_KEYWORDS = f"""SELECT doc_id, content, {q.hits('content', fixed.POSITIVE_FINANCE_WORDS)} AS p,
  {q.hits('content', fixed.NEGATIVE_FINANCE_WORDS)} AS n FROM news"""
query(
    "content_sentiment",
    "content_vader_compound content_textblob_polarity content_finbert_positive content_composite_sentiment",
    f"""SELECT doc_id, length(content) % 7 / 7 AS content_vader_compound, length(content) % 5 / 5 AS content_textblob_polarity,
          length(content) % 3 / 3 AS content_finbert_positive,
          {PLUGGED.format(c='content', ratio=q.ratio('p', 'n'))} AS content_composite_sentiment FROM ({CONTENT_KEYWORDS})""",
)(
    lambda t: scoring.content_sentiment(scoring.headline_sentiment(t.news, [length_scorer]), [length_scorer]).select(
        "doc_id", *[f"content_{name}" for name in scoring.CONTENT_SCORES]
    )
)

HS = daily_news.HEADLINE_SCORES
CS = ["content_vader_compound", "content_textblob_polarity", "content_finbert_positive"]
query(
    "daily_sentiment",
    " ".join(f"{c}_{k}" for c in HS for k in ("mean", "std", "min", "max")) + " " + " ".join(f"{c}_mean" for c in CS),
    f"""SELECT ticker, CAST(timestamp AS DATE) AS date, count(headline) AS article_count,
          {', '.join(f'avg({e}) AS {c}_mean, coalesce(stddev_samp({e}), 0) AS {c}_std, min({e}) AS {c}_min, max({e}) AS {c}_max' for c, e in zip(HS, ('length(headline) % 7 / 7', 'length(headline) % 5 / 5', 'length(headline) % 3 / 3')))},
          {', '.join(f'avg(length(content) % {d} / {d}) AS {c}_mean' for c, d in zip(CS, (7, 5, 3)))} FROM news GROUP BY 1, 2""",
)(
    lambda t: daily_news.daily_sentiment(
        t.news.select(
            "ticker",
            F.to_date("timestamp").alias("date"),
            "headline",
            *[(F.length("headline") % d / F.lit(float(d))).alias(c) for c, d in zip(HS, (7, 5, 3))],
            *[(F.length("content") % d / F.lit(float(d))).alias(c) for c, d in zip(CS, (7, 5, 3))],
        ),
        content_scores=CS,
    )
)

query(
    "daily_keywords",
    "finance_sentiment_ratio",
    f"""SELECT ticker, trading_date, p AS finance_positive_count, n AS finance_negative_count, {q.ratio('p', 'n')} AS finance_sentiment_ratio
        FROM (SELECT ticker, trading_date, CAST({q.hits('t', fixed.POSITIVE_FINANCE_WORDS)} AS BIGINT) AS p,
                CAST({q.hits('t', fixed.NEGATIVE_FINANCE_WORDS)} AS BIGINT) AS n
              FROM (SELECT ticker, trading_date, string_agg(combined_text, ' ' ORDER BY timestamp, doc_id) AS t
                    FROM ({q.articles()}) GROUP BY ticker, trading_date))""",
)(lambda t: daily_news.daily_keywords(daily_news.with_trading_date(daily_news.prepare_articles(t.news))))


@query(
    "sentiment_summary",
    "mean std min q25 q50 q75 max correlation_with_returns",
    f"""WITH r AS MATERIALIZED (SELECT length(content) % 7 / 7 AS vader_compound, length(headline) % 5 / 5 AS textblob_polarity,
          (doc_id % 17) / 17 AS daily_return FROM news)
        SELECT d.*, CASE "column" WHEN 'vader_compound' THEN (SELECT corr(vader_compound, daily_return) FROM r)
                     ELSE (SELECT corr(textblob_polarity, daily_return) FROM r) END AS correlation_with_returns
        FROM ({' UNION ALL '.join(f'''SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
            quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM r''' for c in ('vader_compound', 'textblob_polarity'))}) d""",
)
def sentiment_summary(t):
    scored = t.news.select(
        (F.length("content") % 7 / F.lit(7.0)).alias("vader_compound"),
        (F.length("headline") % 5 / F.lit(5.0)).alias("textblob_polarity"),
        (F.col("doc_id") % 17 / F.lit(17.0)).alias("daily_return"),
    )
    return profile.sentiment_summary(scored, cleaning.columns_with(scored.columns, fixed.SUMMARY_KEYWORDS))


# Correlations ----------------------------------------------------------------------------

CORR = ["article_count", "headline_length", "content_length", "daily_return", "volume"]
query(
    "correlation_matrix",
    "correlation",
    f"""WITH r AS MATERIALIZED (SELECT * FROM ({DAILY.format(bars=RETURNS)}) WHERE daily_return IS NOT NULL)
        {' UNION ALL '.join(f"SELECT '{a}' AS left, '{b}' AS right, corr({a}, {b}) AS correlation FROM r" for a in CORR for b in CORR)}""",
)(lambda t: profile.correlation_matrix(daily_panel(t), CORR))

PAIRS = ["open", "high", "low", "close", "sma_5", "volume"]
query(
    "correlated_pairs",
    "correlation",
    f"""WITH r AS MATERIALIZED (SELECT *, {roll('avg', 'close', 5)} AS sma_5 FROM bars) SELECT * FROM (
        {' UNION ALL '.join(f"SELECT '{a}' AS feature1, '{b}' AS feature2, abs(corr({a}, {b})) AS correlation FROM r" for i, a in enumerate(PAIRS) for b in PAIRS[i + 1:])}
        ) WHERE correlation > 0.5""",
)(
    lambda t: profile.correlated_pairs(
        t.bars.withColumn("sma_5", rolling(F.avg, "close", 5)), PAIRS, threshold=0.5
    )
)

FEATURES = ["volume", "close", "high", "low", "open", "log_return", "volatility_5d"]
query(
    "top_correlated",
    "correlation",
    f"""WITH r AS MATERIALIZED (SELECT *, ln(1 + daily_return) AS log_return, {roll('stddev_samp', 'daily_return', 5)} AS volatility_5d FROM ({RETURNS}))
        SELECT * FROM ({' UNION ALL '.join(f'''SELECT '{c}' AS "column", abs(corr({c}, daily_return)) AS correlation FROM r''' for c in FEATURES)})
        ORDER BY correlation DESC, "column" LIMIT 4""",
)(
    lambda t: profile.top_correlated(
        technical.with_returns(t.bars).withColumn("volatility_5d", rolling(F.stddev_samp, "daily_return", 5)),
        FEATURES,
        "daily_return",
        top=5,
    )
)

# Counts and censuses -------------------------------------------------------------------------

query("value_counts", "", 'SELECT ticker, count(*) AS "count" FROM news GROUP BY ticker')(
    lambda t: profile.value_counts(t.news, "ticker")
)
query("label_counts", "", 'SELECT quality, toxic, count(*) AS "count" FROM labels GROUP BY quality, toxic')(
    lambda t: profile.value_counts(t.read("labels"), "quality", "toxic")
)
query("distinct_sources", "", "SELECT DISTINCT source FROM news")(lambda t: profile.distinct_values(t.news, "source"))

GAPS = f"""SELECT ticker, date, close, daily_return, {roll('avg', 'close', 20)} AS sma_20,
    {roll('stddev_samp', 'daily_return', 60)} AS volatility_60d FROM ({RETURNS})"""
GAP_COLUMNS = ["ticker", "date", "close", "daily_return", "sma_20", "volatility_60d"]


def gaps(t):
    return t.returns.select(
        "ticker",
        "date",
        "close",
        "daily_return",
        rolling(F.avg, "close", 20).alias("sma_20"),
        rolling(F.stddev_samp, "daily_return", 60).alias("volatility_60d"),
    )


query(
    "null_census",
    "missing_percentage",
    f"""WITH g AS MATERIALIZED ({GAPS}) {' UNION ALL '.join(f'''SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count, 100.0 * (count(*) - count({c})) / count(*) AS missing_percentage FROM g''' for c in GAP_COLUMNS)}""",
)(lambda t: profile.null_census(gaps(t)))

query(
    "null_overview",
    "missing_percentage",
    f"""WITH g AS MATERIALIZED ({GAPS}), c AS (SELECT count(*) AS rows, {', '.join(f'count(*) - count({c}) AS m{i}' for i, c in enumerate(GAP_COLUMNS))},
          count(*) FILTER ({' AND '.join(f'{c} IS NOT NULL' for c in GAP_COLUMNS)}) AS complete_rows FROM g)
        SELECT rows, complete_rows, 100.0 * ({' + '.join(f'm{i}' for i in range(6))}) / (rows * 6) AS missing_percentage,
          {', '.join(f"({' + '.join(f'(m{i} / rows > {limit / 100})::INT' for i in range(6))}) AS columns_above_{limit}" for limit in (10, 20, 50))} FROM c""",
)(lambda t: profile.null_overview(gaps(t)))

query(
    "infinity_census",
    "",
    """SELECT 'x' AS "column", count(*) FILTER (volume % 3 = 0 OR volume % 5 = 0) AS infinite_count FROM bars
       UNION ALL SELECT 'volume' AS "column", 0::BIGINT AS infinite_count""",
)(
    lambda t: profile.infinity_census(
        t.bars.select(
            "volume",
            F.when(F.col("volume") % 3 == 0, float("inf"))
            .when(F.col("volume") % 5 == 0, float("-inf"))
            .otherwise(F.col("volume"))
            .alias("x"),
        ),
        ["x", "volume"],
    )
)

query(
    "bar_quality",
    "",
    """WITH d AS (SELECT open - 2000 AS open, high, low + 1500 AS low, close, CASE WHEN volume < 5 THEN 0 ELSE volume END AS volume FROM bars)
       SELECT count(*) FILTER (open < 0) + count(*) FILTER (high < 0) + count(*) FILTER (low < 0) + count(*) FILTER (close < 0) AS negative_prices,
         count(*) FILTER (volume = 0) AS zero_volume, count(*) FILTER (high < low) AS high_below_low,
         count(*) FILTER (open > high OR open < low OR close > high OR close < low) AS outside_range FROM d""",
)(
    lambda t: profile.bar_quality(
        t.bars.select(
            (F.col("open") - 2000).alias("open"),
            "high",
            (F.col("low") + 1500).alias("low"),
            "close",
            F.when(F.col("volume") < 5, 0).otherwise(F.col("volume")).alias("volume"),
        )
    )
)

query(
    "price_summary",
    "close_min:4 close_max:4 close_mean:4 volume_mean:4 return_mean:4 return_std:4",
    f"""SELECT ticker, min(date) AS date_min, max(date) AS date_max, count(date) AS date_count, round_even(min(close), 4)::DOUBLE AS close_min,
          round_even(max(close), 4)::DOUBLE AS close_max, round_even(avg(close), 4)::DOUBLE AS close_mean, round_even(avg(volume), 4)::DOUBLE AS volume_mean,
          round_even(avg(daily_return), 4)::DOUBLE AS return_mean, round_even(stddev_samp(daily_return), 4)::DOUBLE AS return_std
        FROM ({RETURNS}) GROUP BY ticker""",
)(lambda t: profile.price_summary(t.returns))

query(
    "returns_summary",
    "mean:4 std:4 min:4 max:4 skew:4 sharpe_ratio:4",
    f"""SELECT *, round_even(mean / std * sqrt(252), 4)::DOUBLE AS sharpe_ratio FROM (
          SELECT ticker, count(daily_return) AS "count", round_even(avg(daily_return), 4)::DOUBLE AS mean, round_even(stddev_samp(daily_return), 4)::DOUBLE AS std,
            round_even(min(daily_return), 4)::DOUBLE AS min, round_even(max(daily_return), 4)::DOUBLE AS max, round_even(skewness(daily_return), 4)::DOUBLE AS skew
          FROM ({RETURNS}) GROUP BY ticker)""",
)(lambda t: profile.returns_summary(t.returns))

query(
    "dataset_summary",
    "news_coverage_percentage articles_per_news_day return_mean return_std return_annualised volatility_annualised return_min return_max",
    f"""SELECT count(*) AS rows, min(date) AS first_date, max(date) AS last_date, count(DISTINCT ticker) AS tickers,
          100 * avg((article_count > 0)::INT) AS news_coverage_percentage, avg(article_count) FILTER (article_count > 0) AS articles_per_news_day,
          avg(daily_return) AS return_mean, stddev_samp(daily_return) AS return_std, 252 * avg(daily_return) AS return_annualised,
          sqrt(252) * stddev_samp(daily_return) AS volatility_annualised, min(daily_return) AS return_min, max(daily_return) AS return_max
        FROM ({MERGED})""",
)(lambda t: profile.dataset_summary(merge.merge_news_and_bars(t.news, t.returns)))

META = {
    "close": ("unknown", "", "double"),
    "sma_20": ("technical", "Technical analysis indicator", "double"),
    "vader_mean": ("sentiment", "Sentiment analysis score", "double"),
    "article_count": ("unknown", "", "bigint"),
    "volume_ratio": ("market", "Market-based feature", "double"),
    "day_of_week": ("temporal", "Time-based feature", "int"),
    "target_return_1d": ("target", "Target variable for prediction", "double"),
}


@query(
    "feature_metadata",
    "missing_percentage mean:4 std:4 min:4 max:4",
    f"""WITH f AS MATERIALIZED (SELECT ticker, date, close, {roll('avg', 'close', 20)} AS sma_20, headline_length AS vader_mean, article_count,
          volume / {roll('avg', 'volume', 10)} AS volume_ratio, (isodow(date) - 1)::INT AS day_of_week,
          lead(close, 1) OVER (PARTITION BY ticker ORDER BY date) / close - 1 AS target_return_1d FROM ({DAILY.format(bars=RETURNS)}))
        {' UNION ALL '.join(f'''SELECT '{c}' AS feature_name, '{k}' AS feature_type, '{d}' AS description, '{ty}' AS data_type, count(*) - count({c}) AS missing_count,
          100.0 * (count(*) - count({c})) / count(*) AS missing_percentage, avg({c}) AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM f''' for c, (k, d, ty) in META.items())}""",
)
def feature_metadata(t):
    panel = daily_panel(t)
    return profile.feature_metadata(
        panel.select(
            "ticker",
            "date",
            "close",
            rolling(F.avg, "close", 20).alias("sma_20"),
            F.col("headline_length").alias("vader_mean"),
            "article_count",
            (F.col("volume") / rolling(F.avg, "volume", 10)).alias("volume_ratio"),
            F.weekday("date").alias("day_of_week"),
            technical.forward_return(1).alias("target_return_1d"),
        )
    )


TTEST = f"""SELECT n_news, n_other, mean_news, mean_other, std_news, std_other, (n_news + n_other - 2)::DOUBLE AS freedom,
      (mean_news - mean_other) / sqrt(((n_news - 1) * std_news ^ 2 + (n_other - 1) * std_other ^ 2) / (n_news + n_other - 2) * (1 / n_news + 1 / n_other)) AS t_statistic
    FROM (SELECT count(daily_return) FILTER (article_count > 0) AS n_news, count(daily_return) FILTER (article_count = 0) AS n_other,
            avg(daily_return) FILTER (article_count > 0) AS mean_news, avg(daily_return) FILTER (article_count = 0) AS mean_other,
            stddev_samp(daily_return) FILTER (article_count > 0) AS std_news, stddev_samp(daily_return) FILTER (article_count = 0) AS std_other
          FROM ({DAILY.format(bars=RETURNS)}))"""
# The tail probability by Simpson's rule on Student's density, 4,000 steps.
DENSITY = "exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) * pow(1 + {x} * {x} / v, -(v + 1) / 2)"
query(
    "news_day_test",
    "mean_news mean_other std_news std_other freedom t_statistic p_value:5",
    f"""WITH t AS MATERIALIZED ({TTEST}), s AS (SELECT 1 - 2 * sum(w * {DENSITY.format(x='x')}) * any_value(h) / 3 AS p
          FROM (SELECT freedom AS v, abs(t_statistic) / 4000 AS h, i * abs(t_statistic) / 4000 AS x,
                  CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM t, range(4001) g(i)))
        SELECT t.*, p AS p_value, (p < 0.05)::INT AS significant FROM t, s""",
)(lambda t: profile.news_day_test(daily_panel(t)))

query(
    "top_words",
    "",
    """SELECT word, count(*) AS "count" FROM (SELECT unnest(regexp_extract_all(lower(headline), '[\\p{L}\\p{N}_]+')) AS word FROM news)
       WHERE length(word) > 2 AND word NOT IN ('the','a','an','and','or','but','in','on','at','to','for','of','with','by','as','is','are','was','were')
       GROUP BY word ORDER BY 2 DESC, 1 LIMIT 20""",
)(lambda t: profile.top_words(t.news))

query(
    "missing_columns",
    "",
    """SELECT unnest(['headline', 'timestamp']) AS missing FROM (SELECT count(*) FROM documents)""",
)(
    lambda t: (
        lambda files, news: news.agg(
            F.array(*[F.lit(name) for name in files.missing_columns(news, ("ticker", "headline", "content", "timestamp"))]).alias("m"),
            F.count("*").alias("n"),
        ).select(F.explode("m").alias("missing"))
    )(__import__("tickerloom.sources.files", fromlist=["files"]), t.news.select("ticker", "content"))
)

# Splits and scaling --------------------------------------------------------------------------

query(
    "split_by_date",
    "",
    """WITH d AS (SELECT date, row_number() OVER (ORDER BY date) AS n, count(*) OVER () AS c FROM (SELECT DISTINCT date FROM bars)),
         s AS (SELECT date, CASE WHEN n <= floor(c * 0.7::DOUBLE) THEN 'train' WHEN n <= floor(c * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM d)
       SELECT ticker, b.date, split FROM bars b JOIN s ON s.date = b.date""",
)(
    lambda t: (
        lambda parts: parts["train"]
        .select("ticker", "date", F.lit("train").alias("split"))
        .unionByName(parts["val"].select("ticker", "date", F.lit("val").alias("split")))
        .unionByName(parts["test"].select("ticker", "date", F.lit("test").alias("split")))
    )(splits.split_by_date(t.bars))
)

RANK = "SELECT ticker, date, row_number() OVER (ORDER BY date, ticker) - 1 AS k, count(*) OVER () AS c FROM bars"
query(
    "row_split",
    "",
    f"""SELECT ticker, date, CASE WHEN k < floor(c * 0.7::DOUBLE) THEN 'train' WHEN k < floor(c * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM ({RANK})""",
)(lambda t: splits.with_row_split(t.bars.select("ticker", "date")))

query(
    "tail_split", "", f"SELECT ticker, date, (k >= floor(c * 0.8::DOUBLE))::INT AS is_validation FROM ({RANK})"
)(lambda t: splits.with_tail_split(t.bars.select("ticker", "date")).withColumn("is_validation", F.col("is_validation").cast("int")))

query(
    "time_folds",
    "",
    f"""WITH k AS (SELECT *, c // 6 AS s FROM ({RANK}))
        {' UNION ALL '.join(f"SELECT {i} AS fold, 'train' AS role, count(*) AS rows, min(date) AS first_date, max(date) AS last_date FROM k WHERE k < {i + 1} * s UNION ALL SELECT {i}, 'test', count(*), min(date), max(date) FROM k WHERE k >= {i + 1} * s AND k < {i + 2} * s" for i in range(5))}""",
)(lambda t: splits.time_folds(splits.with_time_blocks(t.bars.select("ticker", "date"))))

query(
    "scale_features",
    "close_scaled volume_scaled sma_20_scaled",
    f"""WITH f AS MATERIALIZED (SELECT ticker, date, close, volume, coalesce({roll('avg', 'close', 20)}, 0) AS sma_20 FROM bars),
          s AS (SELECT avg(close) AS a, stddev_pop(close) AS b, avg(volume) AS c, stddev_pop(volume) AS d, avg(sma_20) AS e, stddev_pop(sma_20) AS g FROM f)
        SELECT ticker, date, (close - a) / b AS close_scaled, (volume - c) / d AS volume_scaled, (sma_20 - e) / g AS sma_20_scaled FROM f, s""",
)(
    lambda t: splits.scale_features(
        t.bars.select("ticker", "date", "close", "volume", rolling(F.avg, "close", 20).alias("sma_20")),
        ["close", "volume", "sma_20"],
    ).select("ticker", "date", "close_scaled", "volume_scaled", "sma_20_scaled")
)

@query(
    "scale_splits",
    "scaled_close scaled_volume",
    """WITH d AS (SELECT date, row_number() OVER (ORDER BY date) AS n, count(*) OVER () AS c FROM (SELECT DISTINCT date FROM bars)),
         s AS (SELECT avg(close) AS a, stddev_pop(close) AS b, avg(volume) AS v, stddev_pop(volume) AS w FROM bars JOIN d ON d.date = bars.date WHERE n <= floor(c * 0.7::DOUBLE))
       SELECT ticker, bars.date, CASE WHEN n <= floor(c * 0.7::DOUBLE) THEN 'train' WHEN n <= floor(c * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split,
         (close - a) / b AS scaled_close, (volume - v) / w AS scaled_volume FROM bars JOIN d ON d.date = bars.date, s""",
)
def scaled_splits(t):
    """All three splits, scaled by the train split."""
    parts = [
        df.select("ticker", "date", F.lit(name).alias("split"), F.col("close").alias("scaled_close"), F.col("volume").alias("scaled_volume"))
        for name, df in splits.scale_splits(splits.split_by_date(t.bars), ["close", "volume"]).items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)

query(
    "class_weights",
    "weight",
    """SELECT quality, count(*) AS "count", (SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*)) AS weight
       FROM labels GROUP BY quality""",
)(lambda t: splits.class_weights(t.read("labels"), "quality"))

query(
    "stratified_folds",
    "",
    """WITH h AS (SELECT doc_id, quality, md5(doc_id::VARCHAR || '|42') AS h FROM labels)
       SELECT doc_id, quality, ((row_number() OVER (PARTITION BY quality, substr(h, 1, 3) ORDER BY h, doc_id) + ('0x' || substr(h, 1, 3))::INT) % 5)::INT AS fold FROM h""",
)(lambda t: splits.with_stratified_fold(t.read("labels").select("doc_id", "quality"), "quality", ["doc_id"]))
