"""Window and time-series operators, targets, interactions, fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.cleaning_queries import RETURNS
from catalog.registry import query
from tickerloom.functions.numeric import five_bins, flag, rolling, row_max_abs, row_std, sigmoid, three_classes
from tickerloom.operators import daily_news, groupstats, merge, panel_features, technical

W = "PARTITION BY ticker ORDER BY date"


def roll(function: str, value: str, rows: int, need: int | None = None) -> str:
    """SQL of a rolling aggregate with a minimum number of present values."""
    frame = f"OVER ({W} ROWS {rows - 1} PRECEDING)"
    need = rows if need is None else need
    return f"CASE WHEN count({value}) {frame} >= {need} THEN {function}({value}) {frame} END"


def lag(value: str, rows: int) -> str:
    return f"lag({value}, {rows}) OVER ({W})"


def lead(value: str, rows: int) -> str:
    return f"lead({value}, {rows}) OVER ({W})"


query(
    "price_changes",
    "price_change_1d price_change_3d price_change_5d log_return",
    f"""SELECT ticker, date, close / {lag('close', 1)} - 1 AS price_change_1d, close / {lag('close', 3)} - 1 AS price_change_3d,
          close / {lag('close', 5)} - 1 AS price_change_5d, ln(close / {lag('close', 1)}) AS log_return FROM bars""",
)(
    lambda t: t.bars.select(
        "ticker",
        "date",
        *[technical.simple_return(days).alias(f"price_change_{days}d") for days in (1, 3, 5)],
        technical.log_return().alias("log_return"),
    )
)

query(
    "forward_returns",
    "forward_1d forward_3d shifted_1d shifted_2d shifted_5d",
    f"""SELECT ticker, date, {lead('close', 1)} / close - 1 AS forward_1d, {lead('close', 3)} / close - 1 AS forward_3d,
          {lead('daily_return', 1)} AS shifted_1d, {lead('daily_return', 2)} AS shifted_2d, {lead('daily_return', 5)} AS shifted_5d
        FROM ({RETURNS})""",
)(
    lambda t: t.returns.select(
        "ticker",
        "date",
        *[technical.forward_return(days).alias(f"forward_{days}d") for days in (1, 3)],
        *[technical.shifted_return(days).alias(f"shifted_{days}d") for days in (1, 2, 5)],
    )
)

SMA = (5, 10, 20, 50)
query(
    "sma_and_price_position",
    " ".join(f"sma_{n}:4 price_vs_sma_{n}" for n in SMA),
    "SELECT ticker, date, "
    + ", ".join(f"sma_{n}, close / sma_{n} - 1 AS price_vs_sma_{n}" for n in SMA)
    + " FROM (SELECT *, "
    + ", ".join(f"{roll('avg', 'close', n)} AS sma_{n}" for n in SMA)
    + " FROM bars)",
)(
    lambda t: t.bars.select("ticker", "date", "close", *[rolling(F.avg, "close", n).alias(f"sma_{n}") for n in SMA])
    .select(
        "ticker",
        "date",
        *[f"sma_{n}" for n in SMA],
        *[(F.col("close") / F.col(f"sma_{n}") - 1).alias(f"price_vs_sma_{n}") for n in SMA],
    )
)

EMA_STEP = """SELECT b.ticker, b.rn, {values} FROM e JOIN r b ON b.ticker = e.ticker AND b.rn = e.rn + 1"""


def ema_sql(spans, source: str, value: str) -> str:
    """Recursive weighted sums, one row per ticker and step."""
    start = ", ".join(f"{value} AS n{s}, 1.0::DOUBLE AS d{s}" for s in spans)
    step = ", ".join(
        f"b.{value} + e.n{s} * (1 - 2.0::DOUBLE / ({s} + 1)), 1 + e.d{s} * (1 - 2.0::DOUBLE / ({s} + 1))" for s in spans
    )
    return f"""WITH RECURSIVE r AS MATERIALIZED (SELECT *, row_number() OVER ({W}) AS rn FROM {source}),
      e AS (SELECT ticker, rn, {start} FROM r WHERE rn = 1 UNION ALL {EMA_STEP.format(values=step)})
      SELECT r.*, {', '.join(f'n{s} / d{s} AS ema_{s}' for s in spans)} FROM e JOIN r ON r.ticker = e.ticker AND r.rn = e.rn"""


query(
    "ema",
    " ".join(f"ema_{n}:4" for n in SMA),
    f"SELECT ticker, date, {', '.join(f'ema_{n}' for n in SMA)} FROM ({ema_sql(SMA, 'bars', 'close')})",
)(lambda t: technical.with_ema(t.bars.select("ticker", "date", "close")).select("ticker", "date", *[f"ema_{n}" for n in SMA]))

MACD_LINE = f"SELECT ticker, date, ema_12 - ema_26 AS macd FROM ({ema_sql((12, 26), 'bars', 'close')})"
query(
    "macd",
    "macd:4 macd_signal:4 macd_histogram:4",
    f"""SELECT ticker, date, macd, ema_9 AS macd_signal, macd - ema_9 AS macd_histogram
        FROM ({ema_sql((9,), f'({MACD_LINE})', 'macd')})""",
)(
    lambda t: technical.with_macd(t.bars.select("ticker", "date", "close")).select(
        "ticker", "date", "macd", "macd_signal", "macd_histogram"
    )
)

query(
    "volatility_and_spread",
    " ".join(f"volatility_{n}d high_low_ratio_{n}d" for n in (5, 10, 20)),
    "SELECT ticker, date, "
    + ", ".join(
        f"{roll('stddev_samp', 'daily_return', n)} AS volatility_{n}d, {roll('avg', 's', n)} AS high_low_ratio_{n}d"
        for n in (5, 10, 20)
    )
    + f" FROM (SELECT *, (high - low) / close AS s FROM ({RETURNS}))",
)(
    lambda t: t.returns.select(
        "ticker",
        "date",
        *[rolling(F.stddev_samp, "daily_return", n).alias(f"volatility_{n}d") for n in (5, 10, 20)],
        *[
            rolling(F.avg, (F.col("high") - F.col("low")) / F.col("close"), n).alias(f"high_low_ratio_{n}d")
            for n in (5, 10, 20)
        ],
    )
)

RSI = f"""SELECT ticker, date, CASE WHEN l > 0 THEN 100 - 100 / (1 + g / l) WHEN g > 0 THEN 100 END AS rsi_14
  FROM (SELECT ticker, date, {roll('avg', 'gain', 14)} AS g, {roll('avg', 'loss', 14)} AS l FROM
    (SELECT ticker, date, CASE WHEN d > 0 THEN d ELSE 0 END AS gain, CASE WHEN d < 0 THEN -d ELSE 0 END AS loss FROM
      (SELECT ticker, date, close - {lag('close', 1)} AS d FROM bars)))"""
query("rsi", "rsi_14:5", RSI)(
    lambda t: technical.with_rsi(t.bars.select("ticker", "date", "close")).select("ticker", "date", "rsi_14")
)

query(
    "bollinger",
    "bb_upper:4 bb_lower:4 bb_width bb_position",
    f"""SELECT ticker, date, m + 2 * s AS bb_upper, m - 2 * s AS bb_lower, 4 * s / m AS bb_width,
          (close - (m - 2 * s)) / (4 * s) AS bb_position
        FROM (SELECT ticker, date, close, {roll('avg', 'close', 20)} AS m, {roll('stddev_samp', 'close', 20)} AS s FROM bars)""",
)(
    lambda t: t.bars.select(
        "ticker",
        "date",
        *[
            column.alias(name)
            for name, column in technical.bollinger(
                rolling(F.avg, "close", 20), rolling(F.stddev_samp, "close", 20), F.col("close")
            ).items()
        ],
    )
)

query(
    "volume_features",
    "volume_sma_10 volume_ratio price_volume:4",
    f"""SELECT ticker, date, v AS volume_sma_10, volume / v AS volume_ratio, close * volume AS price_volume
        FROM (SELECT *, {roll('avg', 'volume', 10)} AS v FROM bars)""",
)(
    lambda t: technical.technical_features(t.returns).select(
        "ticker", "date", "volume_sma_10", "volume_ratio", "price_volume"
    )
)

query(
    "new_high_low",
    "",
    f"""SELECT ticker, date, coalesce(high = {roll('max', 'high', 20)}, false)::INT AS is_new_high_20d,
          coalesce(low = {roll('min', 'low', 20)}, false)::INT AS is_new_low_20d FROM bars""",
)(
    lambda t: t.bars.select(
        "ticker",
        "date",
        flag(F.col("high") == rolling(F.max, "high", 20)).alias("is_new_high_20d"),
        flag(F.col("low") == rolling(F.min, "low", 20)).alias("is_new_low_20d"),
    )
)

SPANS = (*SMA, 12, 26)
TECHNICAL_SQL = f"""WITH e AS MATERIALIZED ({ema_sql(SPANS, 'bars', 'close')}),
    g AS MATERIALIZED ({ema_sql((9,), '(SELECT ticker, date, ema_12 - ema_26 AS macd FROM e)', 'macd')}),
    w AS (SELECT *, {', '.join(f"{roll('avg', 'close', n)} AS sma_{n}" for n in SMA)},
        {', '.join(f"{roll('stddev_samp', 'daily_return', n)} AS volatility_{n}d, {roll('avg', 'sp', n)} AS high_low_ratio_{n}d" for n in (5, 10, 20))},
        {', '.join(f"close / {lag('close', n)} - 1 AS price_change_{n}d" for n in (1, 3, 5))},
        {roll('avg', 'gain', 14)} AS g, {roll('avg', 'loss', 14)} AS l, {roll('stddev_samp', 'close', 20)} AS s20,
        {roll('avg', 'volume', 10)} AS volume_sma_10,
        coalesce(high = {roll('max', 'high', 20)}, false)::INT AS is_new_high_20d, coalesce(low = {roll('min', 'low', 20)}, false)::INT AS is_new_low_20d
      FROM (SELECT *, (high - low) / close AS sp, CASE WHEN d > 0 THEN d ELSE 0 END AS gain, CASE WHEN d < 0 THEN -d ELSE 0 END AS loss
        FROM (SELECT *, close - {lag('close', 1)} AS d FROM ({RETURNS}))))
  SELECT w.* EXCLUDE (sp, d, gain, loss, g, l, s20), {', '.join(f'ema_{n}' for n in SMA)},
    {', '.join(f'w.close / sma_{n} - 1 AS price_vs_sma_{n}' for n in SMA)},
    CASE WHEN w.l > 0 THEN 100 - 100 / (1 + w.g / w.l) WHEN w.g > 0 THEN 100 END AS rsi_14,
    sma_20 + 2 * s20 AS bb_upper, sma_20 - 2 * s20 AS bb_lower, 4 * s20 / sma_20 AS bb_width, (w.close - (sma_20 - 2 * s20)) / (4 * s20) AS bb_position,
    w.volume / volume_sma_10 AS volume_ratio, w.close * w.volume AS price_volume,
    macd, ema_9 AS macd_signal, macd - ema_9 AS macd_histogram
  FROM w JOIN e ON e.ticker = w.ticker AND e.date = w.date JOIN g ON g.ticker = w.ticker AND g.date = w.date"""
PRICE_SIZED = [*[f"{kind}_{n}:4" for kind in ("sma", "ema") for n in SMA], *"macd:4 macd_signal:4 macd_histogram:4 bb_upper:4 bb_lower:4 price_volume:2 rsi_14:5".split()]
TECHNICAL_DOUBLES = " ".join(
    [
        *PRICE_SIZED,
        "daily_return volume_sma_10 volume_ratio bb_width bb_position",
        *[f"price_vs_sma_{n}" for n in SMA],
        *[f"{kind}_{n}d" for kind in ("volatility", "high_low_ratio") for n in (5, 10, 20)],
        *[f"price_change_{n}d" for n in (1, 3, 5)],
    ]
)
query("technical_features", TECHNICAL_DOUBLES, TECHNICAL_SQL)(lambda t: technical.technical_features(t.returns))

query(
    "returns_and_features",
    "next_day_return next_3day_return log_return volatility_5d price_vs_sma10 rsi_14:5 bb_position volume_ratio",
    f"""SELECT ticker, date, r1 AS next_day_return, {lead('close', 3)} / close - 1 AS next_3day_return, log_return, volatility_5d,
          close / s10 - 1 AS price_vs_sma10,
          CASE WHEN l > 0 THEN 100 - 100 / (1 + g / l) WHEN g > 0 THEN 100 END AS rsi_14,
          (close - (s20 - 2 * d20)) / (4 * d20) AS bb_position, volume / v10 AS volume_ratio,
          coalesce(r1 > 0, false)::INT AS target_binary, CASE WHEN r1 > 0.005 THEN 2 WHEN r1 < -0.005 THEN 0 ELSE 1 END AS target_multiclass
        FROM (SELECT *, {lead('daily_return', 1)} AS r1, {roll('avg', 'close', 10)} AS s10, {roll('avg', 'close', 20)} AS s20,
            {roll('stddev_samp', 'close', 20)} AS d20, {roll('avg', 'volume', 10)} AS v10,
            {roll('stddev_samp', 'daily_return', 5)} AS volatility_5d, {roll('avg', 'gain', 14)} AS g, {roll('avg', 'loss', 14)} AS l
          FROM (SELECT *, CASE WHEN d > 0 THEN d ELSE 0 END AS gain, CASE WHEN d < 0 THEN -d ELSE 0 END AS loss
            FROM (SELECT *, close - {lag('close', 1)} AS d, ln(close / {lag('close', 1)}) AS log_return FROM ({RETURNS}))))""",
)(
    lambda t: technical.returns_and_features(t.bars).select(
        "ticker", "date", "next_day_return", "next_3day_return", "log_return", "volatility_5d", "price_vs_sma10",
        "rsi_14", "bb_position", "volume_ratio", "target_binary", "target_multiclass",
    )
)

query(
    "lag_features",
    "composite_sentiment_lag_1 composite_sentiment_lag_5 return_lag_1 return_lag_2 return_lag_5 volume_ratio_lag_3 "
    "daily_return_rolling_mean_3 daily_return_rolling_std_10 composite_sentiment_rolling_mean_5",
    f"""SELECT ticker, date, {lag('c', 1)} AS composite_sentiment_lag_1, {lag('c', 5)} AS composite_sentiment_lag_5,
          {lag('daily_return', 1)} AS return_lag_1, {lag('daily_return', 2)} AS return_lag_2, {lag('daily_return', 5)} AS return_lag_5,
          {lag('v', 3)} AS volume_ratio_lag_3, {roll('avg', 'daily_return', 3)} AS daily_return_rolling_mean_3,
          {roll('stddev_samp', 'daily_return', 10)} AS daily_return_rolling_std_10,
          {roll('avg', 'c', 5)} AS composite_sentiment_rolling_mean_5
        FROM (SELECT *, volume / {roll('avg', 'volume', 10)} AS v, (close - open) / close AS c FROM ({RETURNS}))""",
)(
    lambda t: technical.lag_features(
        t.returns.withColumns(
            {
                "volume_ratio": F.col("volume") / rolling(F.avg, "volume", 10),
                "composite_sentiment": (F.col("close") - F.col("open")) / F.col("close"),
            }
        )
    ).select(
        "ticker", "date", "composite_sentiment_lag_1", "composite_sentiment_lag_5", "return_lag_1", "return_lag_2",
        "return_lag_5", "volume_ratio_lag_3", "daily_return_rolling_mean_3", "daily_return_rolling_std_10",
        "composite_sentiment_rolling_mean_5",
    )
)

DAILY = """SELECT b.*, coalesce(article_count, 0) AS article_count, coalesce(headline_length, 0) AS headline_length,
      coalesce(content_length, 0) AS content_length
    FROM ({bars}) b LEFT JOIN (SELECT ticker, CAST(timestamp AS DATE) AS date, count(headline) AS article_count,
         avg(length(headline)) AS headline_length, avg(length(content)) AS content_length FROM news GROUP BY 1, 2) n
      ON b.ticker = n.ticker AND b.date = n.date"""


def daily_panel(t):
    return merge.attach_zero_filled(t.returns, daily_news.daily_lengths(t.news))


query(
    "news_lags_and_means",
    "article_count_ma_3 article_count_ma_10 content_length_lag_2 content_length_ma_5",
    f"""SELECT ticker, date, {lag('article_count', 1)} AS article_count_lag_1, {lag('content_length', 2)} AS content_length_lag_2,
          {roll('avg', 'article_count', 3, 1)} AS article_count_ma_3, {roll('avg', 'article_count', 10, 1)} AS article_count_ma_10,
          {roll('avg', 'content_length', 5, 1)} AS content_length_ma_5 FROM ({DAILY.format(bars=RETURNS)})""",
)(
    lambda t: technical.news_lags_and_means(daily_panel(t), ["article_count", "content_length"]).select(
        "ticker", "date", "article_count_lag_1", "content_length_lag_2", "article_count_ma_3", "article_count_ma_10",
        "content_length_ma_5",
    )
)

query(
    "rolling_volatility_from_start",
    "volatility_5",
    f"SELECT ticker, date, {roll('stddev_samp', 'daily_return', 5, 1)} AS volatility_5 FROM ({RETURNS})",
)(lambda t: t.returns.select("ticker", "date", rolling(F.stddev_samp, "daily_return", 5, min_periods=1).alias("volatility_5")))


def ahead_std(days: int) -> str:
    frame = f"OVER ({W} ROWS BETWEEN 1 FOLLOWING AND {days} FOLLOWING)"
    return f"CASE WHEN count(daily_return) {frame} = {days} THEN stddev_samp(daily_return) {frame} END"


query(
    "target_variables",
    "target_return_1d target_return_3d target_volatility_3d target_volatility_5d",
    f"""SELECT *, coalesce(target_return_1d > 0, false)::INT AS target_direction_1d,
          coalesce(target_return_3d > 0, false)::INT AS target_direction_3d,
          CASE WHEN target_return_1d > 0.005 THEN 2 WHEN target_return_1d < -0.005 THEN 0 ELSE 1 END AS target_multiclass_1d,
          CASE WHEN target_return_3d > 0.005 THEN 2 WHEN target_return_3d < -0.005 THEN 0 ELSE 1 END AS target_multiclass_3d
        FROM (SELECT ticker, date, {lead('close', 1)} / close - 1 AS target_return_1d, {lead('close', 3)} / close - 1 AS target_return_3d,
          {ahead_std(3)} AS target_volatility_3d, {ahead_std(5)} AS target_volatility_5d FROM ({RETURNS}))""",
)(
    lambda t: panel_features.target_variables(t.returns).select(
        "ticker", "date", "target_return_1d", "target_return_3d", "target_volatility_3d", "target_volatility_5d",
        "target_direction_1d", "target_direction_3d", "target_multiclass_1d", "target_multiclass_3d",
    )
)


def five(value: str) -> str:
    return (
        f"CASE WHEN {value} <= -0.02 THEN 'strong_negative' WHEN {value} <= -0.005 THEN 'negative' "
        f"WHEN {value} <= 0.005 THEN 'neutral' WHEN {value} <= 0.02 THEN 'positive' WHEN {value} > 0.02 THEN 'strong_positive' END"
    )


query(
    "future_targets",
    "future_return_1d future_return_2d future_return_5d future_volatility_1d future_volatility_5d",
    f"""SELECT *, {', '.join(f'coalesce(future_return_{h}d > 0, false)::INT AS future_return_{h}d_positive, {five(f"future_return_{h}d")} AS future_return_{h}d_categorical' for h in (1, 2, 5))}
        FROM (SELECT ticker, date, {', '.join(f'{lead("daily_return", h)} AS future_return_{h}d' for h in (1, 2, 5))},
          CAST(NULL AS DOUBLE) AS future_volatility_1d,
          CASE WHEN row_number() OVER ({W}) >= 5 THEN {ahead_std(5)} END AS future_volatility_5d FROM ({RETURNS}))""",
)(
    lambda t: panel_features.future_targets(t.returns).select(
        "ticker", "date",
        *[f"future_return_{h}d{kind}" for h in (1, 2, 5) for kind in ("", "_positive", "_categorical")],
        "future_volatility_1d", "future_volatility_5d",
    )
)


def median60(value: str) -> str:
    frame = f"OVER ({W} ROWS 59 PRECEDING)"
    return f"CASE WHEN count({value}) {frame} >= 30 THEN median({value}) {frame} END"


query(
    "market_regime_features",
    "trend_strength_10d trend_strength_20d trend_strength_50d",
    f"""WITH v AS (SELECT *, {', '.join(f"{roll('stddev_samp', 'daily_return', n)} AS v{n}" for n in (5, 10, 20))},
            {', '.join(f"{roll('avg', 'close', n)} AS s{n}" for n in (10, 20, 50))}, row_number() OVER ({W}) AS rn FROM ({RETURNS})),
          m AS (SELECT *, {', '.join(f"{median60(f'v{n}')} AS m{n}" for n in (5, 10, 20))}, {roll('stddev_samp', 'daily_return', 60, 30)} AS d60,
            {', '.join(f"(close - s{n}) / s{n} AS g{n}" for n in (10, 20, 50))},
            rn - row_number() OVER (PARTITION BY ticker, daily_return < 0 ORDER BY date) AS island FROM v)
        SELECT ticker, date,
          {', '.join(f"coalesce(v{n} > 1.5 * m{n}, false)::INT AS high_vol_regime_{n}d, coalesce(v{n} < 0.5 * m{n}, false)::INT AS low_vol_regime_{n}d" for n in (5, 10, 20))},
          {', '.join(f"{roll('stddev_samp', f'g{n}', n)} AS trend_strength_{n}d" for n in (10, 20, 50))},
          CASE WHEN daily_return < 0 THEN row_number() OVER (PARTITION BY ticker, daily_return < 0, island ORDER BY date) ELSE 0 END::INT
            AS consecutive_down_days,
          coalesce(abs(daily_return) > 2 * d60, false)::INT AS large_move_indicator FROM m""",
)(
    lambda t: technical.market_regime_features(
        t.returns.withColumns(
            {
                **{f"volatility_{n}d": rolling(F.stddev_samp, "daily_return", n) for n in (5, 10, 20)},
                **{f"sma_{n}": rolling(F.avg, "close", n) for n in (10, 20, 50)},
            }
        )
    ).select(
        "ticker", "date", *[f"{side}_vol_regime_{n}d" for n in (5, 10, 20) for side in ("high", "low")],
        *[f"trend_strength_{n}d" for n in (10, 20, 50)], "consecutive_down_days", "large_move_indicator",
    )
)

query(
    "fill_forward_backward",
    "x y",
    f"""SELECT ticker, date, coalesce(last_value(x IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING),
            first_value(x IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS x,
          coalesce(last_value(y IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING),
            first_value(y IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS y
        FROM (SELECT ticker, date, CASE WHEN volume % 9 = 0 THEN volume END AS x,
          CASE WHEN ticker < 'Brand#3' AND volume % 11 = 0 THEN volume END AS y FROM bars)""",
)(
    lambda t: technical.fill_forward_backward(
        t.bars.select(
            "ticker",
            "date",
            F.when(F.col("volume") % 9 == 0, F.col("volume")).alias("x"),
            F.when((F.col("ticker") < "Brand#3") & (F.col("volume") % 11 == 0), F.col("volume")).alias("y"),
        ),
        ["x", "y"],
    )
)

ORACLE_TEMPORAL = """SELECT ticker, date, year(date)::INT AS year, month(date)::INT AS month, quarter(date)::INT AS quarter,
         (isodow(date) - 1)::INT AS day_of_week, day(date)::INT AS day_of_month, weekofyear(date)::INT AS week_of_year,
         (isodow(date) = 1)::INT AS is_monday, (isodow(date) = 5)::INT AS is_friday, (date = last_day(date))::INT AS is_month_end,
         (day(date) = 1)::INT AS is_month_start, (date = last_day(date) AND month(date) IN (3, 6, 9, 12))::INT AS is_quarter_end,
         sin(2 * pi() * month(date) / 12) AS month_sin, cos(2 * pi() * month(date) / 12) AS month_cos,
         sin(2 * pi() * (isodow(date) - 1) / 7) AS day_of_week_sin, cos(2 * pi() * (isodow(date) - 1) / 7) AS day_of_week_cos,
         date_diff('day', (SELECT min(date) FROM bars), date)::INT AS days_since_start FROM bars"""
query("temporal_features", "month_sin month_cos day_of_week_sin day_of_week_cos", ORACLE_TEMPORAL)(lambda t: panel_features.temporal_features(t.bars.select("ticker", "date")))

query(
    "market_calendar_features",
    "",
    """SELECT ticker, date, date_local, (isodow(date_local) - 1)::INT AS day_of_week, (isodow(date_local) = 1)::INT AS is_monday,
         (isodow(date_local) = 5)::INT AS is_friday, month(date_local)::INT AS month, quarter(date_local)::INT AS quarter,
         (CAST(date_local AS DATE) = last_day(date_local))::INT AS is_month_end, (day(date_local) = 1)::INT AS is_month_start
       FROM (SELECT ticker, date, ((date::TIMESTAMP AT TIME ZONE 'UTC') AT TIME ZONE 'US/Eastern') AS date_local FROM bars)""",
)(lambda t: panel_features.market_calendar_features(t.bars.select("ticker", "date")))

query(
    "interaction_features",
    "sentiment_volume_interaction sentiment_volatility_interaction composite_sentiment_strength sentiment_bull_market "
    "sentiment_bear_market",
    f"""SELECT ticker, date, c * volume / v10 AS sentiment_volume_interaction, c * v5 AS sentiment_volatility_interaction,
          abs(c) AS composite_sentiment_strength, coalesce(close > s20, false)::INT AS market_regime,
          c * coalesce(close > s20, false)::INT AS sentiment_bull_market, c * (1 - coalesce(close > s20, false)::INT) AS sentiment_bear_market
        FROM (SELECT *, (close - open) / close AS c, {roll('avg', 'volume', 10)} AS v10,
          {roll('stddev_samp', 'daily_return', 5)} AS v5, {roll('avg', 'close', 20)} AS s20 FROM ({RETURNS}))""",
)(
    lambda t: panel_features.interaction_features(
        t.returns.withColumns(
            {
                "composite_sentiment": (F.col("close") - F.col("open")) / F.col("close"),
                "volume_ratio": F.col("volume") / rolling(F.avg, "volume", 10),
                "volatility_5d": rolling(F.stddev_samp, "daily_return", 5),
                "sma_20": rolling(F.avg, "close", 20),
            }
        )
    ).select(
        "ticker", "date", "sentiment_volume_interaction", "sentiment_volatility_interaction",
        "composite_sentiment_strength", "market_regime", "sentiment_bull_market", "sentiment_bear_market",
    )
)

query(
    "news_interactions",
    "sentiment_volume_interaction news_volatility_interaction sentiment_consistency price_momentum_3d price_momentum_5d",
    f"""SELECT ticker, date, headline_length * ln(1 + volume) AS sentiment_volume_interaction,
          article_count * volatility_5 AS news_volatility_interaction, abs(headline_length - content_length) AS sentiment_consistency,
          close / {lag('close', 3)} - 1 AS price_momentum_3d, close / {lag('close', 5)} - 1 AS price_momentum_5d
        FROM (SELECT *, {roll('stddev_samp', 'daily_return', 5, 1)} AS volatility_5 FROM ({DAILY.format(bars=RETURNS)}))""",
)(
    lambda t: panel_features.news_interactions(
        daily_panel(t).withColumnsRenamed(
            {"headline_length": "headline_vader_compound_mean", "content_length": "content_vader_compound_mean"}
        )
    ).select(
        "ticker", "date", "sentiment_volume_interaction", "news_volatility_interaction", "sentiment_consistency",
        "price_momentum_3d", "price_momentum_5d",
    )
)

query(
    "three_classes_and_bins",
    "",
    f"""SELECT ticker, date, CASE WHEN daily_return > 0.005 THEN 2 WHEN daily_return < -0.005 THEN 0 ELSE 1 END AS class3,
          {five('daily_return')} AS class5, coalesce(daily_return > 0, false)::INT AS up FROM ({RETURNS})""",
)(
    lambda t: t.returns.select(
        "ticker",
        "date",
        three_classes(F.col("daily_return")).alias("class3"),
        five_bins(F.col("daily_return")).alias("class5"),
        flag(F.col("daily_return") > 0).alias("up"),
    )
)

query(
    "math_functions",
    "a b c d e f g",
    """SELECT ticker, date, ln(close) AS a, ln(1 + volume) AS b, sqrt(close) AS c, pow(close, 0.25) AS d,
         round_even(volume / 8, 2) AS e, 1 / (1 + exp(-(close - open) / close)) AS f, abs(close - open) / close AS g FROM bars""",
)(
    lambda t: t.bars.select(
        "ticker",
        "date",
        F.ln("close").alias("a"),
        F.log1p("volume").alias("b"),
        F.sqrt("close").alias("c"),
        F.pow("close", F.lit(0.25)).alias("d"),
        F.bround(F.col("volume") / 8, 2).alias("e"),
        sigmoid((F.col("close") - F.col("open")) / F.col("close")).alias("f"),
        (F.abs(F.col("close") - F.col("open")) / F.col("close")).alias("g"),
    )
)

query(
    "row_agreement",
    "consensus extremity",
    """SELECT vec_id, sqrt((pow(a - m, 2) + pow(b - m, 2) + pow(c - m, 2)) / 2) AS consensus,
         greatest(abs(a), abs(b), abs(c)) AS extremity FROM (SELECT *, (a + b + c) / 3 AS m FROM
         (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b,
           CASE WHEN label = 1 THEN 0 ELSE embedding[3]::DOUBLE END AS c FROM embeddings))""",
)(
    lambda t: (
        lambda parts: t.read("embeddings").select(
            "vec_id", row_std(parts).alias("consensus"), row_max_abs(parts).alias("extremity")
        )
    )(
        [
            F.get("embedding", F.lit(0)),
            F.get("embedding", F.lit(1)),
            F.when(F.col("label") != 1, F.get("embedding", F.lit(2))),
        ]
    )
)

query(
    "news_quality",
    "news_age_hours:4 sentiment_consensus sentiment_extremity",
    """SELECT doc_id, epoch_us(TIMESTAMP '1999-01-01 00:00:00' - timestamp) / 3.6e9 AS news_age_hours,
         (hour(timestamp) BETWEEN 9 AND 16 AND isodow(timestamp) <= 5)::INT AS market_hours_news,
         regexp_matches(lower(source), 'reuters|bloomberg|wall street journal|financial times|cnbc|marketwatch|barrons|forbes|investors business daily')::INT
           AS credible_source, abs(a - b) / sqrt(2) AS sentiment_consensus, greatest(abs(a), abs(b)) AS sentiment_extremity
       FROM (SELECT *, (doc_id % 13) / 13 - 0.5 AS a, coalesce(CASE WHEN doc_id % 3 > 0 THEN (doc_id % 17) / 17 END, 0) AS b FROM news)""",
)(
    lambda t: daily_news.news_quality(
        t.news.withColumns(
            {
                "title_sentiment": F.col("doc_id") % 13 / F.lit(13.0) - 0.5,
                "body_sentiment": F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 17 / F.lit(17.0)),
            }
        ),
        F.lit("1999-01-01 00:00:00").cast("timestamp"),
    ).select(
        "doc_id", "news_age_hours", "market_hours_news", "credible_source", "sentiment_consensus", "sentiment_extremity"
    )
)

LOO = f"""SELECT a.ticker, a.date, a.daily_return, avg(b.daily_return) AS market_return,
    stddev_samp(b.daily_return) AS market_volatility, any_value(a.daily_return) - avg(b.daily_return) AS relative_to_market
  FROM r a LEFT JOIN r b ON a.date = b.date AND a.ticker <> b.ticker GROUP BY a.ticker, a.date, a.daily_return"""
query(
    "leave_one_out",
    "daily_return market_return market_volatility relative_to_market",
    f"WITH r AS MATERIALIZED ({RETURNS}) {LOO}",
)(
    lambda t: merge.leave_one_out(t.returns).select(
        "ticker", "date", "daily_return", "market_return", "market_volatility", "relative_to_market"
    )
)

SECTORS = {"first": ("Brand#11", "Brand#12"), "second": ("Brand#51",)}
query(
    "sector_means",
    "first_sector_return second_sector_return",
    f"""WITH r AS MATERIALIZED ({RETURNS}) SELECT r.ticker, r.date, f AS first_sector_return, s AS second_sector_return FROM r
        LEFT JOIN (SELECT date, avg(daily_return) AS f FROM r WHERE ticker IN ('Brand#11', 'Brand#12') GROUP BY date) a ON a.date = r.date
        LEFT JOIN (SELECT date, avg(daily_return) AS s FROM r WHERE ticker = 'Brand#51' GROUP BY date) b ON b.date = r.date""",
)(
    lambda t: merge.attach_sector_means(t.returns, SECTORS).select(
        "ticker", "date", "first_sector_return", "second_sector_return"
    )
)

query(
    "sector_daily_mean",
    "first_sector_return",
    f"""SELECT date, avg(daily_return) AS first_sector_return FROM ({RETURNS}) WHERE ticker IN ('Brand#11', 'Brand#12') GROUP BY date""",
)(lambda t: merge.sector_means(t.returns, SECTORS["first"], "first"))

query(
    "cross_asset_features",
    "market_return market_volatility relative_to_market first_sector_return",
    f"""WITH r AS MATERIALIZED ({RETURNS}) SELECT l.ticker, l.date, market_return, market_volatility, relative_to_market, f AS first_sector_return
        FROM ({LOO}) l LEFT JOIN (SELECT date, avg(daily_return) AS f FROM r WHERE ticker IN ('Brand#11', 'Brand#12') GROUP BY date) a
          ON a.date = l.date""",
)(
    lambda t: merge.cross_asset_features(t.returns, SECTORS).select(
        "ticker", "date", "market_return", "market_volatility", "relative_to_market", "first_sector_return"
    )
)

GROUP_STATS = """avg({c}) AS {c}_mean, median({c}) AS {c}_median, stddev_samp({c}) AS {c}_std, min({c}) AS {c}_min,
  max({c}) AS {c}_max, CASE WHEN count({c}) > 2 AND stddev_pop({c}) > 0 THEN skewness({c}) END AS {c}_skew"""
query(
    "sentiment_group_features",
    " ".join(f"vader_value_{s}" for s in ("mean", "median", "std", "min", "max", "skew:5")),
    f"""SELECT event_id, s.* EXCLUDE (ticker, date) FROM (SELECT event_id, event_type AS ticker, CAST(ts AS DATE) AS date FROM events) e
        JOIN (SELECT event_type AS ticker, CAST(ts AS DATE) AS date, {GROUP_STATS.format(c='vader_value')}
              FROM (SELECT *, value AS vader_value FROM events) GROUP BY 1, 2) s ON s.ticker = e.ticker AND s.date = e.date""",
)(
    lambda t: groupstats.sentiment_group_features(
        t.read("events").select(
            "event_id",
            F.col("event_type").alias("ticker"),
            F.to_date("ts").alias("date"),
            F.col("value").alias("vader_value"),
        ),
        ["vader_value"],
    ).select("event_id", *[f"vader_value_{s}" for s in groupstats.STATISTICS])
)

# The composite sentiment is one value a row, so a group's mean, median, least and largest are that value.
GROUP_VALUES = {"mean": "c", "median": "c", "std": "NULL::DOUBLE", "min": "c", "max": "c", "skew": "NULL::DOUBLE"}
SENTIMENT_VALUES = {"composite_sentiment": "c", **{f"composite_sentiment_{k}": v for k, v in GROUP_VALUES.items()}}
SENTIMENT_LAGS = {
    f"{name}_lag_{n}": "NULL::DOUBLE" if value.startswith("NULL") else lag(value, n) for name, value in SENTIMENT_VALUES.items() for n in (1, 3, 5)
}
MOMENTS = {
    f"{name}_rolling_{kind}_{n}": roll(function, value, n)
    for name, value in (("daily_return", "daily_return"), ("composite_sentiment", "c"))
    for n in (3, 5, 10)
    for kind, function in (("mean", "avg"), ("std", "stddev_samp"))
}
ADDED = {
    **SENTIMENT_VALUES,
    **SENTIMENT_LAGS,
    **{f"return_lag_{n}": lag("daily_return", n) for n in (1, 2, 3, 5)},
    **{f"volume_ratio_lag_{n}": lag("volume_ratio", n) for n in (1, 3)},
    **MOMENTS,
    **{f"target_return_{n}d": f"{lead('close', n)} / close - 1" for n in (1, 3)},
    **{f"target_volatility_{n}d": ahead_std(n) for n in (3, 5)},
    "sentiment_volume_interaction": "c * volume_ratio",
    "sentiment_volatility_interaction": "c * volatility_5d",
    "sentiment_bull_market": "c * coalesce(close > sma_20, false)::INT",
    "sentiment_bear_market": "c * (1 - coalesce(close > sma_20, false)::INT)",
}
STRENGTHS = [name for name in ADDED if "composite_sentiment" in name]
ALL_SQL = f"""WITH t AS MATERIALIZED ({TECHNICAL_SQL}),
    a AS (SELECT *, {', '.join(f'{value} AS {name}' for name, value in ADDED.items())}, coalesce(close > sma_20, false)::INT AS market_regime,
      {', '.join(f"coalesce({lead('close', n)} / close - 1 > 0, false)::INT AS target_direction_{n}d" for n in (1, 3))},
      {', '.join(f"CASE WHEN {lead('close', n)} / close - 1 > 0.005 THEN 2 WHEN {lead('close', n)} / close - 1 < -0.005 THEN 0 ELSE 1 END AS target_multiclass_{n}d" for n in (1, 3))}
      FROM (SELECT *, (close - open) / close AS c FROM t))
  SELECT a.* EXCLUDE (c), {', '.join(f'abs({name}) AS {name}_strength' for name in STRENGTHS)}, m.* EXCLUDE (ticker, date)
  FROM a JOIN ({ORACLE_TEMPORAL}) m ON m.ticker = a.ticker AND m.date = a.date"""
query(
    "all_features",
    " ".join([TECHNICAL_DOUBLES, *ADDED, *[f"{name}_strength" for name in STRENGTHS], "month_sin month_cos day_of_week_sin day_of_week_cos"]),
    ALL_SQL,
)(
    lambda t: panel_features.all_features(
        t.returns.withColumn("composite_sentiment", (F.col("close") - F.col("open")) / F.col("close"))
    )
)

query(
    "first_close",
    "first_close",
    """SELECT ticker, close AS first_close, date AS first_date FROM bars
       QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date) = 1""",
)(lambda t: technical.first_close(t.bars))

query(
    "holdings_value",
    "value:3",
    f"""WITH f AS (SELECT ticker, close AS c FROM bars QUALIFY row_number() OVER ({W}) = 1)
        SELECT date, sum(100000.0 / (SELECT count(*) FROM f) / c * close) AS value FROM bars JOIN f ON f.ticker = bars.ticker GROUP BY date""",
)(
    lambda t: (
        lambda first: merge.holdings_value(
            first.select(
                "ticker", (F.lit(100000.0) / first.agg(F.count("*")).scalar() / F.col("first_close")).alias("shares")
            ),
            t.bars,
        )
    )(technical.first_close(t.bars))
)
