"""Scans, cleaning, text and calendar functions, daily news and the merged panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql_text as q
from catalog.registry import query
from tickerloom.functions import calendar, fixed_values as fixed, text
from tickerloom.functions.numeric import rolling
from tickerloom.operators import cleaning, daily_news, merge
from tickerloom.sources import feeds, files

RETURNS = "SELECT *, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS daily_return FROM bars"

query("bars", "", "SELECT * FROM bars")(lambda t: t.bars)
query("news", "", "SELECT * FROM news")(lambda t: t.news)


@query(
    "daily_panel",
    "daily_return sma_20:4 volatility_5d avg_article_length:2",
    f"""SELECT b.ticker, b.date, b.daily_return,
      CASE WHEN count(*) OVER w20 >= 20 THEN avg(close) OVER w20 END AS sma_20,
      CASE WHEN count(daily_return) OVER w5 >= 5 THEN stddev_samp(daily_return) OVER w5 END AS volatility_5d,
      coalesce(total_headline_chars, 0) AS total_headline_chars,
      coalesce(total_content_chars, 0) AS total_content_chars,
      coalesce(avg_article_length, 0) AS avg_article_length, coalesce(article_count, 0) AS article_count
    FROM ({RETURNS}) b LEFT JOIN ({q.DAILY_NEWS}) n ON b.ticker = n.ticker AND b.date = n.trading_date
    WINDOW w20 AS (PARTITION BY b.ticker ORDER BY b.date ROWS 19 PRECEDING),
           w5 AS (PARTITION BY b.ticker ORDER BY b.date ROWS 4 PRECEDING)""",
)
def daily_panel(t):
    merged = merge.merge_news_and_bars(t.news, t.returns)
    return merged.select(
        "ticker",
        "date",
        "daily_return",
        rolling(F.avg, "close", 20).alias("sma_20"),
        rolling(F.stddev_samp, "daily_return", 5).alias("volatility_5d"),
        "total_headline_chars",
        "total_content_chars",
        "avg_article_length",
        "article_count",
    )


# Scans and predicates -----------------------------------------------------------------

query(
    "scan_time_range",
    "",
    "SELECT ticker, date, close FROM bars WHERE date >= DATE '1996-01-01' AND date < DATE '1997-01-01'",
)(lambda t: t.bars.where(files.in_range(F.col("date"), "1996-01-01", "1997-01-01")).select("ticker", "date", "close"))


@query(
    "normalise_bars",
    "",
    "SELECT date, ticker, open, high, low, close, volume FROM bars",
)
def normalise_bars(t):
    provider = t.bars.select(
        F.col("ticker").alias("Symbol"),
        F.col("date").cast("timestamp").alias("Date"),
        *[F.col(name).alias(name.title()) for name in ("open", "high", "low", "close", "volume")],
    )
    return files.normalise_bars(provider, F.col("Symbol"))


@query(
    "nested_feed_rows",
    "overall_sentiment_score ticker_sentiment_score",
    """SELECT ticker, headline, content, strftime(timestamp, '%Y%m%dT%H%M%S') AS timestamp, source, url,
         CAST(doc_id % 7 AS DOUBLE) / 7 AS overall_sentiment_score, lang AS overall_sentiment_label,
         CAST(round((doc_id % 11) / 11.0, 4) AS DOUBLE) AS ticker_sentiment_score, lang AS ticker_sentiment_label
       FROM news""",
)
def nested_feed_rows(t):
    """Articles packed into nested feed records, then unpacked by the feed scan."""
    entry = F.struct(
        F.col("ticker").alias("ticker"),
        F.round((F.col("doc_id") % 11) / 11, 4).cast("string").alias("relevance_score"),
        F.lit("0").alias("ticker_sentiment_score"),
        F.col("lang").alias("ticker_sentiment_label"),
    )
    other = F.struct(
        F.lit("OTHER").alias("ticker"),
        F.lit("0.5").alias("relevance_score"),
        F.lit("0").alias("ticker_sentiment_score"),
        F.lit("x").alias("ticker_sentiment_label"),
    )
    article = F.struct(
        F.col("headline").alias("title"),
        F.col("content").alias("summary"),
        F.date_format("timestamp", "yyyyMMdd'T'HHmmss").alias("time_published"),
        F.col("source").alias("source"),
        F.col("url").alias("url"),
        (F.col("doc_id") % 7 / F.lit(7.0)).alias("overall_sentiment_score"),
        F.col("lang").alias("overall_sentiment_label"),
        F.array(other, entry, entry).alias("ticker_sentiment"),
    )
    feed = t.news.select(F.array(article).alias("feed"), "ticker")
    return feeds.nested_feed_rows(feed, F.col("ticker"))


@query(
    "flat_feed_rows",
    "",
    """SELECT ticker, headline, content, CAST(timestamp AS VARCHAR) AS timestamp, source, url,
         '' AS image, ticker AS symbol FROM news""",
)
def flat_feed_rows(t):
    feed = t.news.select(
        "ticker",
        F.col("headline").alias("title"),
        F.col("content").alias("text"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("publishedDate"),
        F.col("source").alias("site"),
        "url",
        F.lit(None).cast("string").alias("image"),
        F.col("ticker").alias("symbol"),
    )
    return feeds.flat_feed_rows(feed, F.col("ticker"))


@query(
    "union_sources",
    "score",
    """SELECT ticker, headline, CAST(NULL AS DOUBLE) AS score, source FROM news WHERE lang = 'en'
       UNION ALL SELECT ticker, headline, CAST(length(content) AS DOUBLE) AS score, NULL AS source
       FROM news WHERE lang <> 'en'""",
)
def union_sources(t):
    english = t.news.where("lang = 'en'").select("ticker", "headline", "source")
    others = t.news.where("lang <> 'en'").select(
        "ticker", "headline", F.length("content").cast("double").alias("score")
    )
    return feeds.union_sources(english, others)


query(
    "valid_bars",
    "",
    """SELECT ticker, date, close, volume FROM (SELECT ticker, date, close, CASE WHEN volume % 5 = 0 THEN NULL
         WHEN volume % 7 = 0 THEN -1 ELSE volume END AS volume FROM bars)
       WHERE volume IS NOT NULL AND close > 0 AND volume >= 0""",
)(
    lambda t: cleaning.valid_bars(
        t.bars.select(
            "ticker",
            "date",
            "close",
            F.when(F.col("volume") % 5 != 0, F.when(F.col("volume") % 7 == 0, -1.0).otherwise(F.col("volume"))).alias("volume"),
        )
    )
)

query(
    "positive_prices",
    "",
    """SELECT ticker, date, open - 2000 AS open, high, low, close FROM bars WHERE open - 2000 > 0
         AND high > 0 AND low > 0 AND close > 0""",
)(
    lambda t: cleaning.positive_prices(
        t.bars.select("ticker", "date", (F.col("open") - 2000).alias("open"), "high", "low", "close")
    )
)

query(
    "within_sigma",
    "daily_return",
    f"""WITH r AS ({RETURNS}), s AS (SELECT avg(daily_return) AS m, stddev_samp(daily_return) AS d FROM r)
        SELECT ticker, date, daily_return FROM r, s WHERE daily_return BETWEEN m - 3 * d AND m + 3 * d""",
)(lambda t: cleaning.within_sigma(t.returns.select("ticker", "date", "daily_return")))

query(
    "clean_and_validate",
    "removed_share",
    f"""WITH r AS ({RETURNS}), v AS (SELECT * FROM r WHERE close > 0 AND volume >= 0),
          s AS (SELECT avg(daily_return) AS m, stddev_samp(daily_return) AS d FROM v),
          k AS (SELECT count(*) AS rows_after FROM v, s WHERE daily_return BETWEEN m - 3 * d AND m + 3 * d),
          b AS (SELECT count(*) AS rows_before FROM r)
        SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed,
               (rows_before - rows_after) / rows_before AS removed_share FROM b, k""",
)(lambda t: cleaning.removed_rows(t.returns, cleaning.clean_and_validate(t.returns)))

query("trading_days", "", "SELECT ticker, date, close FROM bars WHERE isodow(date) <= 5")(
    lambda t: cleaning.trading_days(t.bars.select("ticker", "date", "close"))
)

query(
    "long_enough", "", "SELECT doc_id, headline FROM news WHERE length(headline) > 10 AND length(content) > 20"
)(lambda t: cleaning.long_enough(t.news).select("doc_id", "headline"))

query(
    "keep_first_article",
    "",
    "SELECT doc_id, headline FROM news QUALIFY row_number() OVER (PARTITION BY headline, content ORDER BY doc_id) = 1",
)(lambda t: cleaning.keep_first(t.news, ["headline", "content"], ["doc_id"]).select("doc_id", "headline"))

query(
    "keep_first_url",
    "",
    "SELECT doc_id, url FROM news QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1",
)(lambda t: cleaning.keep_first(t.news, ["url"], ["doc_id"]).select("doc_id", "url"))

query(
    "keep_first_bar",
    "l_extendedprice:2",
    """SELECT l_partkey, l_shipdate, l_orderkey, l_extendedprice FROM (SELECT * FROM lineitem
         QUALIFY row_number() OVER (PARTITION BY l_partkey, l_shipdate
           ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity) = 1)""",
)(
    lambda t: cleaning.keep_first(
        t.read("lineitem"),
        ["l_partkey", "l_shipdate"],
        ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity"],
    ).select("l_partkey", "l_shipdate", "l_orderkey", "l_extendedprice")
)

query(
    "keep_first_ticker_article",
    "",
    """SELECT ticker, headline, timestamp, doc_id FROM news
       QUALIFY row_number() OVER (PARTITION BY ticker, headline, timestamp ORDER BY doc_id) = 1""",
)(
    lambda t: cleaning.keep_first(t.news, ["ticker", "headline", "timestamp"], ["doc_id"]).select(
        "ticker", "headline", "timestamp", "doc_id"
    )
)

query(
    "drop_missing",
    "daily_return",
    f"SELECT ticker, date, daily_return FROM ({RETURNS}) WHERE daily_return IS NOT NULL",
)(lambda t: cleaning.drop_missing(t.returns.select("ticker", "date", "daily_return"), ["daily_return"]))

query("clean_news", "", f"SELECT doc_id, ticker, headline, content, timestamp, source FROM ({q.cleaned_news()})")(
    lambda t: cleaning.clean_news(t.news, ["doc_id"]).select(
        "doc_id", "ticker", "headline", "content", "timestamp", "source"
    )
)

query(
    "few_missing",
    "a b c d",
    """SELECT * FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 1.5::DOUBLE END AS a,
         CASE WHEN doc_id % 3 = 0 THEN 2.5::DOUBLE END AS b, CASE WHEN doc_id % 5 = 0 THEN 3.5::DOUBLE END AS c,
         CASE WHEN doc_id % 7 = 0 THEN 4.5::DOUBLE END AS d FROM documents)
       WHERE (a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT + (d IS NULL)::INT < 2""",
)(
    lambda t: cleaning.few_missing(
        t.read("documents").select(
            "doc_id",
            *[
                F.when(F.col("doc_id") % divisor == 0, divisor_value).alias(name)
                for name, divisor, divisor_value in (("a", 2, 1.5), ("b", 3, 2.5), ("c", 5, 3.5), ("d", 7, 4.5))
            ],
        ),
        ["a", "b", "c", "d"],
    )
)

query(
    "fill_defaults",
    "quality_score headline_sentiment",
    """SELECT d.doc_id, coalesce(quality, 0) AS quality, coalesce(CAST(toxic AS DOUBLE), 0) AS quality_score,
         0 AS article_count, 0.0::DOUBLE AS headline_sentiment
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)(
    lambda t: cleaning.fill_defaults(
        t.read("documents")
        .join(t.read("labels"), "doc_id", "left")
        .select("doc_id", "quality", F.col("toxic").cast("double").alias("quality_score")),
        {"quality": 0, "quality_score": 0.0, "article_count": 0, "headline_sentiment": 0.0},
    )
)

query(
    "finite_or_zero",
    "x",
    """SELECT ticker, date, CASE WHEN isfinite(x) THEN x ELSE 0 END AS x FROM (SELECT ticker, date,
         CASE WHEN volume % 3 = 0 THEN 'inf'::DOUBLE WHEN volume % 5 = 0 THEN '-inf'::DOUBLE
              WHEN volume % 7 = 0 THEN NULL ELSE volume END AS x FROM bars)""",
)(
    lambda t: cleaning.finite_or_zero(
        t.bars.select(
            "ticker",
            "date",
            F.when(F.col("volume") % 3 == 0, float("inf"))
            .when(F.col("volume") % 5 == 0, float("-inf"))
            .when(F.col("volume") % 7 != 0, F.col("volume"))
            .alias("x"),
        ),
        ["x"],
    )
)

query(
    "fill_unknown",
    "",
    """SELECT d.doc_id, coalesce(CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'poor' END, 'unknown') AS grade
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)(
    lambda t: cleaning.fill_unknown(
        t.read("documents")
        .join(t.read("labels"), "doc_id", "left")
        .select("doc_id", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("grade")),
        ["grade"],
    )
)

query(
    "in_tickers", "", "SELECT ticker, date, close FROM bars WHERE ticker IN ('Brand#11', 'Brand#34')"
)(lambda t: cleaning.in_tickers(t.bars, ["Brand#11", "Brand#34"]).select("ticker", "date", "close"))

query(
    "column_roles",
    "",
    f"""SELECT ticker, date, CASE WHEN close > 1500 THEN 1 ELSE 0 END AS market_regime FROM bars""",
)(
    lambda t: (
        lambda df: df.select(*cleaning.ROW_IDS[:2], *cleaning.feature_columns(df))
    )(
        t.bars.select(
            "ticker",
            "date",
            (F.col("close") > 1500).cast("int").alias("market_regime"),
            F.lit(1.0).alias("target_return_1d"),
            F.lit(1.0).alias("future_return_1d"),
            F.lit(1.0).alias("next_day_return"),
        )
    )
)

# Text -----------------------------------------------------------------------------------

query("clean_text", "", f"SELECT doc_id, {q.clean('text')} AS cleaned FROM documents")(
    lambda t: t.read("documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))
)

query(
    "remove_boilerplate",
    "",
    f"SELECT doc_id, {q.no_boilerplate(q.clean('headline'))} AS a, {q.no_boilerplate('headline')} AS b FROM news",
)(
    lambda t: t.news.select(
        "doc_id",
        text.remove_boilerplate(text.clean_text(F.col("headline"))).alias("a"),
        text.remove_boilerplate(F.col("headline")).alias("b"),
    )
)

query(
    "tokens",
    "",
    f"""SELECT doc_id, array_to_string({q.tokens(q.clean('text'))}, '|') AS tokens,
          len({q.tokens(q.clean('text'))}) AS n FROM documents""",
)(
    lambda t: t.read("documents")
    .select("doc_id", text.tokens(text.clean_text(F.col("text"))).alias("words"))
    .select("doc_id", F.array_join("words", "|").alias("tokens"), F.size("words").cast("bigint").alias("n"))
)

query("preprocess_text", "", f"SELECT doc_id, {q.preprocess('text')} AS processed FROM documents")(
    lambda t: t.read("documents").select("doc_id", text.preprocess_text(F.col("text")).alias("processed"))
)

query(
    "headline_prefixes",
    "",
    "SELECT doc_id, replace(replace(replace(replace(replace(replace(headline, 'Reuters - ', ''), 'Bloomberg - ', ''), "
    "'CNBC - ', ''), 'MarketWatch - ', ''), 'Yahoo Finance - ', ''), 'AP News - ', '') AS headline FROM news",
)(lambda t: t.news.select("doc_id", text.remove_headline_prefixes(F.col("headline")).alias("headline")))

query(
    "article_lengths",
    "",
    f"""SELECT doc_id, headline_chars, content_chars, total_chars, combined_text FROM ({q.articles()})""",
)(
    lambda t: daily_news.prepare_articles(t.news).select(
        *["doc_id"], *[F.col(c).cast("bigint").alias(c) for c in ("headline_chars", "content_chars", "total_chars")], "combined_text"
    )
)

query(
    "text_lengths",
    "",
    "SELECT doc_id, length(coalesce(headline, '')) AS title_length, length(coalesce(content, '')) AS summary_length FROM news",
)(
    lambda t: t.news.select(
        "doc_id",
        text.length_or_zero(F.col("headline")).cast("bigint").alias("title_length"),
        text.length_or_zero(F.col("content")).cast("bigint").alias("summary_length"),
    )
)


@query(
    "text_statistics",
    "avg_word_length uppercase_ratio",
    f"""SELECT doc_id, length(text) AS text_length, len(w) AS word_count,
          coalesce(list_sum(list_transform(w, lambda x: length(x))) / nullif(len(w), 0), 0.0)::DOUBLE AS avg_word_length,
          length(text) - length(replace(text, '!', '')) AS exclamation_count,
          length(text) - length(replace(text, '?', '')) AS question_count,
          coalesce(length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) / nullif(length(text), 0), 0.0)::DOUBLE AS uppercase_ratio
        FROM (SELECT doc_id, text, {q.words('text')} AS w FROM documents)""",
)
def text_statistics(t):
    stats = text.text_statistics(F.col("text"))
    longs = {n: c.cast("bigint") if n.endswith(("length", "count")) and n != "avg_word_length" else c for n, c in stats.items()}
    return t.read("documents").select("doc_id", *[c.alias(n) for n, c in longs.items()])


query(
    "credible_source",
    "",
    "SELECT doc_id, CASE WHEN regexp_matches(lower(source), '"
    + "|".join(name.lower() for name in fixed.CREDIBLE_SOURCES)
    + "') THEN 1 ELSE 0 END AS credible_source FROM news",
)(lambda t: t.news.select("doc_id", text.credible_source(F.col("source")).alias("credible_source")))

query(
    "ticker_list",
    "",
    """SELECT region, array_to_string(list_sort(list_transform(string_split(names, ','), lambda x: upper(trim(x)))), '|') AS tickers
       FROM (SELECT r_name AS region, string_agg(lower(n_name), ' , ' ORDER BY n_name) AS names
             FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)""",
)(
    lambda t: t.read("nation")
    .join(t.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    .groupBy(F.col("r_name").alias("region"))
    .agg(F.array_join(F.array_sort(F.collect_list(F.lower("n_name"))), " , ").alias("names"))
    .select("region", F.array_join(F.array_sort(text.ticker_list(F.col("names"))), "|").alias("tickers"))
)

# Calendar ---------------------------------------------------------------------------------

query(
    "trading_date",
    "",
    f"""SELECT event_id, ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'US/Eastern') AS timestamp_local,
          {q.trading_date('ts')} AS trading_date FROM events""",
)(
    lambda t: daily_news.with_trading_date(t.read("events").withColumn("timestamp", F.col("ts").cast("timestamp"))).select(
        "event_id", "timestamp_local", "trading_date"
    )
)

query(
    "calendar_parts",
    "month_sin month_cos day_of_week_sin day_of_week_cos",
    """SELECT o_orderkey, year(d)::INT AS year, month(d)::INT AS month, quarter(d)::INT AS quarter,
         (isodow(d) - 1)::INT AS day_of_week, day(d)::INT AS day_of_month, weekofyear(d)::INT AS week_of_year,
         (isodow(d) = 1)::INT AS is_monday, (isodow(d) = 5)::INT AS is_friday, (d = last_day(d))::INT AS is_month_end,
         (day(d) = 1)::INT AS is_month_start, (d = last_day(d) AND month(d) IN (3, 6, 9, 12))::INT AS is_quarter_end,
         sin(2 * pi() * month(d) / 12) AS month_sin, cos(2 * pi() * month(d) / 12) AS month_cos,
         sin(2 * pi() * (isodow(d) - 1) / 7) AS day_of_week_sin, cos(2 * pi() * (isodow(d) - 1) / 7) AS day_of_week_cos
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)(
    lambda t: t.read("orders")
    .select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    .select(
        "o_orderkey",
        *[
            column.alias(name)
            for name, column in {
                **calendar.calendar_parts(F.col("d")),
                **calendar.calendar_flags(F.col("d")),
                **calendar.cyclical_parts(F.col("d")),
            }.items()
        ],
    )
)

query(
    "news_age_and_market_hours",
    "news_age_hours:4",
    """SELECT event_id, epoch_us(TIMESTAMP '2024-03-01 00:00:00' - ts) / 3.6e9 AS news_age_hours,
         (hour(ts) BETWEEN 9 AND 16 AND isodow(ts) <= 5)::INT AS market_hours_news FROM events""",
)(
    lambda t: t.read("events")
    .select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    .select(
        "event_id",
        calendar.age_hours(F.col("ts"), F.lit("2024-03-01 00:00:00").cast("timestamp")).alias("news_age_hours"),
        calendar.in_market_hours(F.col("ts")).alias("market_hours_news"),
    )
)

query(
    "period_truncation",
    "",
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter,
         date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS days FROM orders""",
)(
    lambda t: t.read("orders")
    .select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    .select(
        "o_orderkey",
        calendar.month_of(F.col("d")).alias("month"),
        calendar.quarter_of(F.col("d")).alias("quarter"),
        calendar.days_between(F.lit("1992-01-01").cast("date"), F.col("d")).cast("bigint").alias("days"),
    )
)

query(
    "parse_feed_time",
    "",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN NULL ELSE timestamp END AS parsed,
         CASE WHEN doc_id % 5 = 4 THEN NULL ELSE strftime(timestamp, '%Y%m%dT0000') END AS day_start,
         CASE WHEN doc_id % 5 = 4 THEN NULL ELSE strftime(timestamp, '%Y%m%dT2359') END AS day_end FROM news""",
)(
    lambda t: t.news.select(
        "doc_id",
        calendar.parse_feed_time(
            F.when(F.col("doc_id") % 5 == 0, F.date_format("timestamp", "yyyyMMdd'T'HHmmss"))
            .when(F.col("doc_id") % 5 == 1, F.date_format("timestamp", "yyyyMMdd'T'HHmm"))
            .when(F.col("doc_id") % 5 == 2, F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
            .when(F.col("doc_id") % 5 == 3, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise("not a time")
        ).alias("parsed"),
    ).select(
        "doc_id",
        "parsed",
        calendar.feed_time_argument(F.col("parsed")).alias("day_start"),
        calendar.feed_time_argument(F.col("parsed"), end_of_day=True).alias("day_end"),
    )
)

# Daily news ------------------------------------------------------------------------------

query("daily_news", "avg_article_length:2", q.DAILY_NEWS)(
    lambda t: daily_news.daily_news(daily_news.with_trading_date(daily_news.prepare_articles(t.news)))
)

query(
    "daily_text",
    "",
    f"""SELECT ticker, trading_date, string_agg(combined_text, ' ' ORDER BY timestamp, doc_id) AS combined_text
        FROM ({q.articles()}) GROUP BY ticker, trading_date""",
)(
    lambda t: daily_news.join_parts(
        daily_news.daily_text(t.news, ["timestamp", "doc_id"])
    )
)

query(
    "daily_lengths",
    "headline_length content_length",
    """SELECT ticker, CAST(timestamp AS DATE) AS date, count(headline) AS article_count,
         avg(length(headline)) AS headline_length, avg(length(content)) AS content_length FROM news GROUP BY 1, 2""",
)(lambda t: daily_news.daily_lengths(t.news))

query("articles_per_day", "", "SELECT CAST(timestamp AS DATE) AS date, count(*) AS articles FROM news GROUP BY 1")(
    lambda t: daily_news.articles_per_day(t.news)
)

MERGED = f"""SELECT b.*, coalesce(total_headline_chars, 0) AS total_headline_chars,
      coalesce(total_content_chars, 0) AS total_content_chars, total_chars_sum,
      coalesce(avg_article_length, 0) AS avg_article_length, coalesce(article_count, 0) AS article_count
    FROM ({RETURNS}) b LEFT JOIN ({q.DAILY_NEWS}) n ON b.ticker = n.ticker AND b.date = n.trading_date"""

query(
    "merge_news_and_bars",
    "daily_return avg_article_length:2",
    MERGED,
)(lambda t: merge.merge_news_and_bars(t.news, t.returns))

query(
    "attach_zero_filled",
    "headline_length content_length",
    """SELECT b.ticker, b.date, b.close, coalesce(article_count, 0) AS article_count,
         coalesce(headline_length, 0) AS headline_length, coalesce(content_length, 0) AS content_length
       FROM bars b LEFT JOIN (SELECT ticker, CAST(timestamp AS DATE) AS date, count(headline) AS article_count,
         avg(length(headline)) AS headline_length, avg(length(content)) AS content_length FROM news GROUP BY 1, 2) n
         ON b.ticker = n.ticker AND b.date = n.date""",
)(lambda t: merge.attach_zero_filled(t.bars.select("ticker", "date", "close"), daily_news.daily_lengths(t.news)))
