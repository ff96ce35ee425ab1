"""Signals, returns, risk, metrics, trades and equity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog.cleaning_queries import RETURNS
from catalog.registry import query
from tickerloom.operators import metrics, ordered, risk, signals, trades
from tickerloom.session import written

# A series mild enough to compound: a day's return as yesterday's, clipped to 5 %.
SERIES = f"""SELECT ticker, date, r AS actual_return, p, CASE WHEN p <= 0.4 THEN -1 WHEN p >= 0.6 THEN 1 ELSE 0 END AS signal
  FROM (SELECT ticker, date, greatest(least(daily_return, 0.05), -0.05) AS r,
          0.5 + greatest(least(previous, 0.4), -0.4) AS p
        FROM (SELECT *, lag(daily_return) OVER (PARTITION BY ticker ORDER BY date) AS previous FROM ({RETURNS}))
        WHERE previous IS NOT NULL)"""
LABELED = f"SELECT *, (actual_return > 0)::INT AS y_true, (p > 0.5)::INT AS y_pred FROM ({SERIES})"


def series(t) -> DataFrame:
    from tickerloom.functions.numeric import by_ticker

    previous = t.returns.withColumn("previous", F.lag("daily_return").over(by_ticker())).where("previous IS NOT NULL")
    clipped = previous.select(
        "ticker",
        "date",
        F.greatest(F.least("daily_return", F.lit(0.05)), F.lit(-0.05)).alias("actual_return"),
        (0.5 + F.greatest(F.least("previous", F.lit(0.4)), F.lit(-0.4))).alias("p"),
    )
    return clipped.withColumn("signal", signals.trading_signal(F.col("p")))


def labeled(t) -> DataFrame:
    return series(t).withColumns(
        {"y_true": (F.col("actual_return") > 0).cast("int"), "y_pred": (F.col("p") > 0.5).cast("int")}
    )


query("trading_signals", "p", f"SELECT ticker, date, p, signal FROM ({SERIES})")(
    lambda t: series(t).select("ticker", "date", "p", "signal")
)

STEPS = {
    "ticker": "PARTITION BY ticker ORDER BY date",
    "pooled": "ORDER BY date, ticker",
}


def stepped_sql(order: str) -> str:
    return f"""SELECT *, signal * actual_return - signal_change * 0.001 AS strategy_return
      FROM (SELECT *, abs(signal - lag(signal, 1, 0) OVER ({order})) AS signal_change FROM ({LABELED}))"""


def grown_sql(order: str) -> str:
    """Running products as sums of logarithms, which no engine overflows."""
    return f"""SELECT *, exp(sum(ln(1 + strategy_return)) OVER ({order} ROWS UNBOUNDED PRECEDING)) AS growth,
      exp(sum(ln(1 + actual_return)) OVER ({order} ROWS UNBOUNDED PRECEDING)) AS held FROM ({stepped_sql(order)})"""


for mode, by in (("ticker", ["ticker"]), ("pooled", [])):
    order = STEPS[mode]
    keys = ", ".join(by)
    group = f"GROUP BY {keys}" if keys else ""
    key_column = f"{keys}, " if keys else ""

    query(
        f"strategy_returns_{mode}",
        "strategy_return",
        f"SELECT ticker, date, signal_change, strategy_return FROM ({stepped_sql(order)})",
    )(
        lambda t, by=by: signals.with_strategy_returns(labeled(t), by=by).select(
            "ticker", "date", "signal_change", "strategy_return"
        )
    )

    if by:
        query(
            "cumulative_returns_ticker",
            "cumulative_return buy_hold_return:4",
            f"SELECT ticker, date, growth - 1 AS cumulative_return, held - 1 AS buy_hold_return FROM ({grown_sql(order)})",
        )(
            lambda t, by=by: signals.with_cumulative_returns(
                signals.with_strategy_returns(labeled(t), by=by), by=by
            ).select("ticker", "date", "cumulative_return", "buy_hold_return")
        )
    else:
        # Pooled growth leaves the float range, so its logarithm over the first date is compared.
        query(
            "cumulative_returns_pooled",
            "log_growth",
            f"""SELECT ticker, date, sum(ln(1 + actual_return)) OVER ({order} ROWS UNBOUNDED PRECEDING) AS log_growth
                FROM ({LABELED})""",
        )(
            lambda t: ordered.with_log_growth(labeled(t), "actual_return", "log_growth").select("ticker", "date", "log_growth")
        )
        query(
            "drawdown_pooled",
            "drawdown",
            f"""SELECT ticker, date, exp(g - max(g) OVER ({order} ROWS UNBOUNDED PRECEDING)) - 1 AS drawdown
                FROM (SELECT *, sum(ln(1 + actual_return)) OVER ({order} ROWS UNBOUNDED PRECEDING) AS g FROM ({LABELED}))""",
        )(
            lambda t: ordered.with_return_drawdown(labeled(t), "actual_return", "drawdown").select("ticker", "date", "drawdown")
        )

    query(
        f"position_metrics_{mode}",
        "long_percentage short_percentage hold_percentage trades_per_period",
        f"""SELECT {key_column}count(*) AS total_positions, count(*) FILTER (signal = 1) AS long_positions, count(*) FILTER (signal = -1) AS short_positions,
              count(*) FILTER (signal = 0) AS hold_positions, 100 * avg((signal = 1)::INT) AS long_percentage,
              100 * avg((signal = -1)::INT) AS short_percentage, 100 * avg((signal = 0)::INT) AS hold_percentage,
              count(*) FILTER (signal_change > 0) AS total_trades, avg((signal_change > 0)::INT) AS trades_per_period
            FROM ({stepped_sql(order)}) {group}""",
    )(lambda t, by=by: signals.position_metrics(signals.with_strategy_returns(labeled(t), by=by), by=by))

query(
    "return_summary",
    "total_return buy_hold_total_return:4 excess_return:4",
    f"""SELECT ticker, max_by(growth, date) - 1 AS total_return, max_by(held, date) - 1 AS buy_hold_total_return,
          max_by(growth, date) - max_by(held, date) AS excess_return FROM ({grown_sql(STEPS['ticker'])}) GROUP BY ticker""",
)(
    lambda t: signals.return_summary(
        signals.with_cumulative_returns(signals.with_strategy_returns(labeled(t), by=["ticker"]), by=["ticker"]),
        ["ticker"],
    )
)

query(
    "drawdown_ticker",
    "drawdown",
    f"""SELECT ticker, date, growth / max(growth) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS drawdown
        FROM ({grown_sql(STEPS['ticker'])})""",
)(
    lambda t: ordered.with_drawdown(
        ordered.with_growth(signals.with_strategy_returns(labeled(t), by=["ticker"]), "strategy_return", "g", ["ticker"]),
        "g",
        "drawdown",
        ["ticker"],
    ).select("ticker", "date", "drawdown")
)

RISK_COLUMNS = (
    "mean_daily_return volatility max_drawdown win_rate avg_win avg_loss annualized_return annualized_volatility sharpe_ratio "
    "calmar_ratio win_loss_ratio sortino_ratio information_ratio"
)
query(
    "risk_metrics_ticker",
    RISK_COLUMNS,
    f"""SELECT ticker, m AS mean_daily_return, v AS volatility, d AS max_drawdown, w AS win_rate, a AS avg_win, l AS avg_loss, m * 252 AS annualized_return,
          v * sqrt(252) AS annualized_volatility, (m - 0.02 / 252) / v * sqrt(252) AS sharpe_ratio, m * 252 / abs(d) AS calmar_ratio,
          abs(a / l) AS win_loss_ratio, (m * 252 - 0.02) / (s * sqrt(252)) AS sortino_ratio, ea * 252 / (es * sqrt(252)) AS information_ratio
        FROM (SELECT ticker, avg(x) AS m, stddev_pop(x) AS v, min(g / k - 1) AS d, avg((x > 0)::INT) AS w, avg(x) FILTER (x > 0) AS a,
                avg(x) FILTER (x < 0) AS l, stddev_pop(x) FILTER (x < 0.02 / 252) AS s, avg(x - actual_return) AS ea, stddev_pop(x - actual_return) AS es
              FROM (SELECT ticker, date, strategy_return AS x, actual_return, growth AS g,
                      max(growth) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS k FROM ({grown_sql(STEPS['ticker'])}))
              GROUP BY ticker)""",
)(
    lambda t: risk.risk_metrics(
        signals.with_strategy_returns(labeled(t), by=["ticker"]), by=["ticker"], benchmark="actual_return"
    )
)

query(
    "risk_metrics_pooled",
    RISK_COLUMNS.replace(" information_ratio", ""),
    f"""SELECT m AS mean_daily_return, v AS volatility, d AS max_drawdown, w AS win_rate, a AS avg_win, l AS avg_loss, m * 252 AS annualized_return,
          v * sqrt(252) AS annualized_volatility, (m - 0.02 / 252) / v * sqrt(252) AS sharpe_ratio, m * 252 / abs(d) AS calmar_ratio,
          abs(a / l) AS win_loss_ratio, (m * 252 - 0.02) / (s * sqrt(252)) AS sortino_ratio
        FROM (SELECT avg(x) AS m, stddev_pop(x) AS v, min(exp(g - k) - 1) AS d, avg((x > 0)::INT) AS w, avg(x) FILTER (x > 0) AS a,
                avg(x) FILTER (x < 0) AS l, stddev_pop(x) FILTER (x < 0.02 / 252) AS s
              FROM (SELECT x, g, max(g) OVER (ORDER BY date, ticker ROWS UNBOUNDED PRECEDING) AS k
                    FROM (SELECT ticker, date, actual_return AS x, sum(ln(1 + actual_return)) OVER (ORDER BY date, ticker ROWS UNBOUNDED PRECEDING) AS g
                          FROM ({LABELED}))))""",
)(lambda t: risk.risk_metrics(labeled(t), "actual_return"))

# Classification ------------------------------------------------------------------------------

query("confusion_matrix", "", f'SELECT y_true, y_pred, count(*) AS "count" FROM ({LABELED}) GROUP BY y_true, y_pred')(
    lambda t: metrics.confusion_matrix(labeled(t))
)

THREE = f"""SELECT ticker, date, CASE WHEN actual_return > 0.005 THEN 2 WHEN actual_return < -0.005 THEN 0 ELSE 1 END AS y_true, signal + 1 AS y_pred FROM ({SERIES})"""
REPORT = f"""SELECT c AS class, coalesce(h / nullif(p, 0), 0) AS precision, coalesce(h / nullif(s, 0), 0) AS recall,
    coalesce(2 * h / nullif(p + s, 0), 0) AS f1_score, s::BIGINT AS support, h::BIGINT AS hits
  FROM (SELECT c, count(*) FILTER (y_true = c) AS s, count(*) FILTER (y_pred = c) AS p, count(*) FILTER (y_true = c AND y_pred = c) AS h
        FROM ({THREE}), (VALUES (0), (1), (2)) v(c) GROUP BY c)"""


def three(t) -> DataFrame:
    from tickerloom.functions.numeric import three_classes

    return series(t).select(
        "ticker", "date", three_classes(F.col("actual_return")).alias("y_true"), (F.col("signal") + 1).alias("y_pred")
    )


query("class_report", "precision recall f1_score", REPORT)(lambda t: metrics.class_report(three(t)))
query(
    "weighted_metrics",
    "accuracy precision recall f1_score",
    f"""SELECT sum(hits) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision,
          sum(recall * support) / sum(support) AS recall, sum(f1_score * support) / sum(support) AS f1_score, sum(support)::BIGINT AS n_samples
        FROM ({REPORT})""",
)(lambda t: metrics.weighted_metrics(three(t)))

AUC = """SELECT (sum(r) FILTER (y = 1) - any_value(np) * (any_value(np) + 1) / 2) / (any_value(np)::DOUBLE * any_value(nn)) AS auc
  FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS r,
          sum(y) OVER () AS np, sum(1 - y) OVER () AS nn FROM ({source}))"""
query(
    "roc_auc",
    "roc_auc",
    f"SELECT auc AS roc_auc FROM ({AUC.format(source=f'SELECT y_true AS y, p AS s FROM ({LABELED})')})",
)(lambda t: metrics.roc_auc(labeled(t), score="p"))

query(
    "roc_auc_documents",
    "roc_auc",
    f"SELECT auc AS roc_auc FROM ({AUC.format(source='SELECT quality AS y, (doc_id * 7919 % 1000) / 1000 AS s FROM labels')})",
)(
    lambda t: metrics.roc_auc(
        t.read("labels").withColumn("score", F.col("doc_id") * 7919 % 1000 / F.lit(1000.0)), "quality", "score"
    )
)

query(
    "roc_auc_one_vs_rest",
    "roc_auc",
    "SELECT sum(auc * w) / sum(w) AS roc_auc FROM ("
    + " UNION ALL ".join(
        f"SELECT auc, (SELECT count(*) FROM ({THREE}) WHERE y_true = {c}) AS w FROM ("
        + AUC.format(source=f"SELECT (y_true = {c})::INT AS y, abs(y_pred - {c}) * -1.0 AS s FROM ({THREE})")
        + ")"
        for c in (0, 1, 2)
    )
    + ")",
)(
    lambda t: metrics.roc_auc_one_vs_rest(
        three(t).withColumns({f"s{c}": -F.abs(F.col("y_pred") - c).cast("double") for c in (0, 1, 2)}),
        "y_true",
        {c: f"s{c}" for c in (0, 1, 2)},
    )
)

query(
    "roc_curve",
    "threshold fpr tpr",
    f"""SELECT DISTINCT s AS threshold, sum(1 - y) OVER w / sum(1 - y) OVER () AS fpr, sum(y) OVER w / sum(y) OVER () AS tpr
        FROM (SELECT quality AS y, (doc_id * 7919 % 100) / 100 AS s FROM labels)
        WINDOW w AS (ORDER BY s DESC RANGE UNBOUNDED PRECEDING)""",
)(
    lambda t: metrics.roc_curve(
        t.read("labels").withColumn("score", F.col("doc_id") * 7919 % 100 / F.lit(100.0)), "quality", "score"
    ).where(F.col("threshold") < float("inf"))
)

BINARY = f"""SELECT count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn,
    count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp, count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn FROM ({LABELED})"""
query(
    "classification_metrics",
    "accuracy precision recall f1_score specificity sensitivity positive_predictive_value negative_predictive_value roc_auc",
    f"""SELECT (tp + tn) / n AS accuracy, (tp / (tp + fp) * (tp + fn) + tn / (tn + fn) * (tn + fp)) / n AS precision, (tp + tn) / n AS recall,
          (2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fp + fn) * (tn + fp)) / n AS f1_score, n::BIGINT AS n_samples,
          tp AS true_positives, tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tn / (tn + fp) AS specificity,
          tp / (tp + fn) AS sensitivity, tp / (tp + fp) AS positive_predictive_value, tn / (tn + fn) AS negative_predictive_value, auc AS roc_auc
        FROM (SELECT *, tp + tn + fp + fn AS n FROM ({BINARY})), ({AUC.format(source=f'SELECT y_true AS y, p AS s FROM ({LABELED})')})""",
)(lambda t: metrics.classification_metrics(labeled(t), score="p"))

for period in ("month", "quarter"):
    query(
        f"{period}_performance",
        "positive_rate:4 accuracy:4 mean_signal:4 return_sum:4 return_std:4",
        f"""SELECT CAST(date_trunc('{period}', date) AS DATE) AS period, round_even(avg(y_true), 4)::DOUBLE AS positive_rate, round_even(avg((y_true = y_pred)::INT), 4)::DOUBLE AS accuracy,
              round_even(avg(signal), 4)::DOUBLE AS mean_signal, round_even(sum(actual_return), 4)::DOUBLE AS return_sum, round_even(stddev_samp(actual_return), 4)::DOUBLE AS return_std,
              count(actual_return) AS return_count FROM ({LABELED}) GROUP BY 1""",
    )(lambda t, period=period: metrics.period_performance(labeled(t), period))

query(
    "evaluation_span",
    "",
    f"SELECT min(date) AS first_date, max(date) AS last_date, count(*) AS total_periods FROM ({LABELED})",
)(lambda t: metrics.evaluation_span(labeled(t)))

BY_TICKER = f"""SELECT ticker, count(*) AS total_samples, sum((y_true = y_pred)::INT)::BIGINT AS correct_predictions,
    round_even(avg((y_true = y_pred)::INT), 3)::DOUBLE AS accuracy, round_even(avg(y_true), 3)::DOUBLE AS positive_rate FROM ({LABELED}) GROUP BY ticker"""
query("accuracy_by_ticker", "accuracy:3 positive_rate:3", BY_TICKER)(lambda t: metrics.accuracy_by(labeled(t)))
query("accuracy_spread", "accuracy_std", f"SELECT stddev_samp(accuracy) AS accuracy_std FROM ({BY_TICKER})")(
    lambda t: metrics.accuracy_spread(metrics.accuracy_by(labeled(t)))
)

query(
    "prediction_profile",
    "accuracy confident_share confident_accuracy mean_confidence bullish_share bearish_share",
    f"""SELECT avg((y_true = y_pred)::INT) AS accuracy, count(*) FILTER (c > 0.7) AS confident, avg((c > 0.7)::INT) AS confident_share,
          coalesce(avg((y_true = y_pred)::INT) FILTER (c > 0.7), 0) AS confident_accuracy, avg(c) AS mean_confidence, avg(y_pred) AS bullish_share,
          avg(1 - y_pred) AS bearish_share FROM (SELECT *, abs(p - 0.5) * 2 AS c FROM ({LABELED}))""",
)(
    lambda t: metrics.prediction_profile(
        labeled(t).withColumn("pred_confidence", signals.prediction_confidence(F.col("p"))), prediction="y_pred"
    )
)


def _ensemble(t):
    scored = labeled(t).select(
        "ticker",
        "date",
        "p",
        F.col("signal").alias("v1"),
        F.col("y_pred").alias("v2"),
        (F.col("actual_return") * 10).alias("q"),
        F.lit(1).alias("v3"),
        F.lit(0).alias("v4"),
    )
    mean, label = metrics.ensemble_average(["p", "q"])
    return scored.select(
        "ticker", "date", mean.alias("mean"), label.alias("label"), metrics.ensemble_vote(["v2", "v3", "v4"]).alias("vote3"),
        metrics.ensemble_vote(["v2", "v3"]).alias("vote2"),
    )


query(
    "ensemble",
    "mean",
    f"""SELECT ticker, date, (p + actual_return * 10) / 2 AS mean, ((p + actual_return * 10) / 2 > 0.5)::INT AS label,
          y_pred AS vote3, CASE WHEN y_pred = 1 THEN 1 ELSE 0 END AS vote2 FROM ({LABELED})""",
)(_ensemble)

# Trades ------------------------------------------------------------------------------------------

# Predictions for the strategies: yesterday's move, clipped, as direction and confidence.
# Prices are lifted by a constant, so that years of compounding stay in a sensible range.
LIFT = 100000
LIFTED = f"SELECT ticker, date, {LIFT} + close AS close FROM bars"
PREDICTED = f"""SELECT ticker, date, {LIFT} + close AS close, CASE WHEN r > 0 THEN 1 ELSE 0 END AS pred_direction, abs(r) AS pred_confidence,
    CASE WHEN volume > 60 THEN 1 ELSE 0 END AS article_count, r / 2 AS headline_vader_compound_mean,
    row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn
  FROM (SELECT *, greatest(least(daily_return, 1), -1) AS r FROM ({RETURNS}))"""
MOMENTUM = trades.sentiment_momentum()
VOLUME = trades.news_volume(articles=1, sentiment=0.05)


def predicted(t) -> DataFrame:
    clipped = t.returns.withColumn("r", F.greatest(F.least("daily_return", F.lit(1.0)), F.lit(-1.0)))
    return clipped.select(
        "ticker",
        "date",
        (LIFT + F.col("close")).alias("close"),
        F.when(F.col("r") > 0, 1).otherwise(0).alias("pred_direction"),
        F.abs("r").alias("pred_confidence"),
        F.when(F.col("volume") > 60, 1).otherwise(0).alias("article_count"),
        (F.col("r") / 2).alias("headline_vader_compound_mean"),
    )


def lifted(t) -> DataFrame:
    return t.bars.select("ticker", "date", (LIFT + F.col("close")).alias("close"))


def positions_sql(name: str, enter: str, direction: str, confidence: str, days: int) -> str:
    """Row by row per ticker: exit when due, else enter when flat and the rule holds."""
    return f"""SELECT '{name}' AS strategy, ticker, edate AS entry_date, eclose AS entry_price, direction, confidence, max(xdate) AS exit_date, max(xclose) AS exit_price
      FROM (WITH RECURSIVE p AS MATERIALIZED ({PREDICTED}),
        s AS (SELECT ticker, 0::BIGINT AS rn, false AS held, NULL::DATE AS edate, NULL::DOUBLE AS eclose, NULL::INT AS direction, NULL::DOUBLE AS confidence,
                NULL::DATE AS xdate, NULL::DOUBLE AS xclose FROM (SELECT DISTINCT ticker FROM p)
          UNION ALL
          SELECT p.ticker, p.rn,
            CASE WHEN s.held THEN p.date < s.edate + {days} ELSE coalesce({enter}, false) END,
            CASE WHEN s.held THEN s.edate WHEN {enter} THEN p.date END,
            CASE WHEN s.held THEN s.eclose WHEN {enter} THEN p.close END,
            CASE WHEN s.held THEN s.direction WHEN {enter} THEN {direction} END,
            CASE WHEN s.held THEN s.confidence WHEN {enter} THEN {confidence} END,
            CASE WHEN s.held AND p.date >= s.edate + {days} THEN p.date END,
            CASE WHEN s.held AND p.date >= s.edate + {days} THEN p.close END
          FROM s JOIN p ON p.ticker = s.ticker AND p.rn = s.rn + 1)
        SELECT * FROM s WHERE edate IS NOT NULL)
      GROUP BY ticker, edate, eclose, direction, confidence"""


MOMENTUM_SQL = positions_sql(
    "sentiment_momentum", "(p.pred_confidence >= 0.6 AND p.pred_direction = 1)", "p.pred_direction", "p.pred_confidence", 5
)
VOLUME_SQL = positions_sql(
    "news_volume",
    "(p.article_count >= 1 AND abs(p.headline_vader_compound_mean) >= 0.05)",
    "CASE WHEN p.headline_vader_compound_mean > 0 THEN 1 ELSE -1 END",
    "least(abs(p.headline_vader_compound_mean) * 2, 1)",
    3,
)
POSITION_DOUBLES = "entry_price exit_price confidence"

query("momentum_positions", POSITION_DOUBLES, MOMENTUM_SQL)(lambda t: trades.positions(predicted(t), MOMENTUM))
query("news_volume_positions", POSITION_DOUBLES, VOLUME_SQL)(lambda t: trades.positions(predicted(t), VOLUME))

query(
    "trade_returns",
    "trade_return",
    f"""SELECT strategy, ticker, entry_date, direction * (exit_price - entry_price) / entry_price AS trade_return,
          date_diff('day', entry_date, exit_date) AS holding_days
        FROM (({MOMENTUM_SQL}) UNION ALL ({VOLUME_SQL})) WHERE exit_date IS NOT NULL""",
)(
    lambda t: taken(t)
    .where("exit_date IS NOT NULL")
    .select(
        "strategy",
        "ticker",
        "entry_date",
        trades.trade_return().alias("trade_return"),
        F.date_diff("exit_date", "entry_date").cast("bigint").alias("holding_days"),
    )
)


def taken(t) -> DataFrame:
    panel = predicted(t)
    return trades.positions(panel, MOMENTUM).unionByName(trades.positions(panel, VOLUME))


# Cash after every event, folded in date and ticker order; the costs of open positions are a map.
def cash_sql(positions: str) -> str:
    return f"""WITH RECURSIVE pos AS MATERIALIZED ({positions}),
      ev AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY date, ticker) AS k FROM (
        SELECT strategy, ticker, entry_date, entry_date AS date, confidence, false AS is_exit, 0::DOUBLE AS gain FROM pos
        UNION ALL SELECT strategy, ticker, entry_date, exit_date, confidence, true, direction * (exit_price - entry_price) / entry_price
        FROM pos WHERE exit_date IS NOT NULL)),
      f AS (SELECT 0::BIGINT AS k, 100000::DOUBLE AS cash, 0::DOUBLE AS cost, MAP {{'none': 0::DOUBLE}} AS open
        UNION ALL
        SELECT ev.k,
          CASE WHEN is_exit THEN cash + open[ticker] * (1 + gain) ELSE cash - cash * least(0.02 * confidence, 0.1) END,
          CASE WHEN is_exit THEN open[ticker] ELSE cash * least(0.02 * confidence, 0.1) END,
          map_concat(open, MAP {{ev.ticker: CASE WHEN is_exit THEN 0 ELSE cash * least(0.02 * confidence, 0.1) END}})
        FROM f JOIN ev ON ev.k = f.k + 1)
      SELECT ev.strategy, ev.ticker, ev.date, ev.entry_date, ev.is_exit, f.cash, f.cost FROM f JOIN ev ON ev.k = f.k"""


STRATEGIES = {"sentiment_momentum": MOMENTUM_SQL, "news_volume": VOLUME_SQL}
CASH_SQL = " UNION ALL ".join(f"({cash_sql(positions)})" for positions in STRATEGIES.values())


def booked(t):
    """Positions of both strategies, their cash events and sizes."""
    position = written(taken(t.store_bars()), "positions")
    events = trades.cash_events(position)
    return position, events, trades.sized_positions(position, events)


query("cash_events", "cash:2 cost:2", CASH_SQL)(lambda t: booked(t)[1])


def equity_sql(name: str, positions: str) -> str:
    return f"""WITH lifted AS MATERIALIZED ({LIFTED}), ce AS MATERIALIZED ({cash_sql(positions)}), ps AS MATERIALIZED ({positions}),
  q AS (SELECT ps.*, cost / entry_price AS quantity FROM ps JOIN ce ON ce.ticker = ps.ticker AND ce.entry_date = ps.entry_date AND NOT ce.is_exit),
  d AS (SELECT DISTINCT date FROM bars),
  m AS (SELECT d.date, q.ticker, q.quantity, q.entry_price, q.direction,
          (SELECT max_by(close, b.date) FROM lifted b WHERE b.ticker = q.ticker AND b.date <= d.date) AS mark
        FROM d JOIN q ON d.date >= q.entry_date AND (q.exit_date IS NULL OR d.date < q.exit_date)),
  v AS (SELECT date, sum(quantity * (entry_price + direction * (mark - entry_price))) AS worth FROM m GROUP BY date),
  c AS (SELECT date, max_by(cash, ticker) AS cash FROM ce GROUP BY date)
  SELECT '{name}' AS strategy, d.date, round(coalesce(last_value(c.cash IGNORE NULLS) OVER (ORDER BY d.date ROWS UNBOUNDED PRECEDING), 100000)
    + coalesce(worth, 0), 6) AS value FROM d LEFT JOIN v ON v.date = d.date LEFT JOIN c ON c.date = d.date"""


EQUITY_SQL = " UNION ALL ".join(f"({equity_sql(name, positions)})" for name, positions in STRATEGIES.items())


def strategy_equity(t):
    _, events, sized = booked(t)
    return trades.equity_curve(sized, events, lifted(t), list(STRATEGIES))


query("equity_curve", "value:2", EQUITY_SQL)(strategy_equity)

query(
    "trade_log",
    "quantity:3 entry_price exit_price pnl:2 return",
    f"""SELECT ps.strategy, ps.ticker, direction, cost / entry_price AS quantity, entry_price, exit_price, ps.entry_date, exit_date,
          direction * (exit_price - entry_price) * cost / entry_price AS pnl, direction * (exit_price - entry_price) / entry_price AS return
        FROM (({MOMENTUM_SQL}) UNION ALL ({VOLUME_SQL})) ps JOIN ({CASH_SQL}) ce
          ON ce.strategy = ps.strategy AND ce.ticker = ps.ticker AND ce.entry_date = ps.entry_date AND NOT ce.is_exit
        WHERE exit_date IS NOT NULL""",
)(lambda t: trades.trade_log(booked(t)[2]))

STRATEGY_TRADES = f"""SELECT strategy, ticker, entry_date, exit_date, direction * (exit_price - entry_price) / entry_price AS return
  FROM (({MOMENTUM_SQL}) UNION ALL ({VOLUME_SQL})) WHERE exit_date IS NOT NULL"""


def closed(t) -> DataFrame:
    return taken(t).where("exit_date IS NOT NULL").withColumn("return", trades.trade_return())


query(
    "trade_statistics",
    "avg_return best_return worst_return avg_holding_days median_holding_days",
    f"""SELECT strategy, count(*) AS num_trades, count(*) FILTER (return > 0) AS winning_trades, count(*) FILTER (return < 0) AS losing_trades,
          avg(return) AS avg_return, max(return) AS best_return, min(return) AS worst_return, avg(exit_date - entry_date) AS avg_holding_days,
          median(exit_date - entry_date) AS median_holding_days FROM ({STRATEGY_TRADES}) GROUP BY strategy""",
)(lambda t: trades.trade_statistics(closed(t)))

query(
    "trade_statistics_by_ticker",
    "avg_return:4 total_return:4",
    f"""SELECT strategy, ticker, count(*) AS num_trades, round_even(avg(return), 4)::DOUBLE AS avg_return, round_even(sum(return), 4)::DOUBLE AS total_return
        FROM ({STRATEGY_TRADES}) GROUP BY strategy, ticker""",
)(lambda t: trades.trade_statistics_by_ticker(closed(t)))

HOLD_SQL = """WITH f AS MATERIALIZED (SELECT ticker, min_by(close, date) AS c FROM bars GROUP BY ticker), d AS (SELECT DISTINCT date FROM bars),
  g AS (SELECT d.date, f.ticker, f.c, last_value(b.close IGNORE NULLS) OVER (PARTITION BY f.ticker ORDER BY d.date ROWS UNBOUNDED PRECEDING) AS mark
        FROM d CROSS JOIN f LEFT JOIN bars b ON b.ticker = f.ticker AND b.date = d.date)
  SELECT 'buy_hold_benchmark' AS strategy, date, sum(100000.0 / (SELECT count(*) FROM f) / c * mark) AS value FROM g WHERE mark IS NOT NULL GROUP BY date"""
query("buy_and_hold_curve", "value:3", HOLD_SQL)(lambda t: trades.buy_and_hold_curve(t.bars))

HOLD_RETURNS = f"SELECT *, value / lag(value) OVER (ORDER BY date) - 1 AS equity_return FROM ({HOLD_SQL})"
query("equity_returns", "value:3 equity_return", HOLD_RETURNS)(
    lambda t: risk.equity_returns(trades.buy_and_hold_curve(t.bars))
)

query(
    "value_at_risk",
    "var_95 cvar_95 var_99 cvar_99",
    f"""WITH r AS MATERIALIZED (SELECT * FROM ({HOLD_RETURNS}) WHERE equity_return IS NOT NULL),
          p AS (SELECT quantile_cont(equity_return, 0.05) AS var_95, quantile_cont(equity_return, 0.01) AS var_99 FROM r)
        SELECT strategy, any_value(var_95) AS var_95, avg(equity_return) FILTER (equity_return <= var_95) AS cvar_95,
          any_value(var_99) AS var_99, avg(equity_return) FILTER (equity_return <= var_99) AS cvar_99 FROM r, p GROUP BY strategy""",
)(lambda t: risk.value_at_risk(risk.equity_returns(trades.buy_and_hold_curve(t.bars))))


def curves(t):
    """The curves of both strategies and the benchmark, and the log of closed trades."""
    _, events, sized = booked(t)
    equity = trades.equity_curve(sized, events, lifted(t), list(STRATEGIES))
    return equity.unionByName(trades.buy_and_hold_curve(t.bars)), trades.trade_log(sized)


PERFORMANCE_SQL = f"""WITH e AS MATERIALIZED (({EQUITY_SQL}) UNION ALL ({HOLD_SQL})),
  r AS (SELECT *, value / lag(value) OVER (PARTITION BY strategy ORDER BY date) - 1 AS er,
          value / max(value) OVER (PARTITION BY strategy ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS dd FROM e),
  a AS (SELECT strategy, max_by(value, date) / 100000 - 1 AS total_return, pow(max_by(value, date) / 100000, 252 / count(*)) - 1 AS annualized_return,
          stddev_samp(er) * sqrt(252) AS volatility, min(dd) AS max_drawdown, max_by(value, date) AS final_value FROM r GROUP BY strategy),
  l AS (SELECT strategy, avg((return > 0)::INT) AS win_rate, count(*) AS num_trades, avg(return) FILTER (return > 0) AS avg_win,
          avg(return) FILTER (return < 0) AS avg_loss FROM ({STRATEGY_TRADES}) GROUP BY strategy)
  SELECT a.*, coalesce(win_rate, 0) AS win_rate, coalesce(num_trades, 0) AS num_trades, coalesce(avg_win, 0) AS avg_win, coalesce(avg_loss, 0) AS avg_loss,
    coalesce(abs(avg_win / avg_loss), 0) AS profit_factor, (annualized_return - 0.02) / volatility AS sharpe_ratio FROM a LEFT JOIN l ON l.strategy = a.strategy"""
PERFORMANCE_DOUBLES = (
    "total_return annualized_return volatility max_drawdown final_value:2 win_rate avg_win avg_loss profit_factor sharpe_ratio"
)
query("performance_metrics", PERFORMANCE_DOUBLES, PERFORMANCE_SQL)(lambda t: risk.performance_metrics(*curves(t)))

DOWNSIDE_SQL = f"""SELECT p.strategy, abs(total_return / max_drawdown) AS calmar_ratio, dd AS downside_deviation, (annualized_return - 0.02) / dd AS sortino_ratio
  FROM ({PERFORMANCE_SQL}) p JOIN (SELECT strategy, stddev_samp(er) FILTER (er < 0) * sqrt(252) AS dd
    FROM (SELECT strategy, value / lag(value) OVER (PARTITION BY strategy ORDER BY date) - 1 AS er FROM (({EQUITY_SQL}) UNION ALL ({HOLD_SQL})))
    GROUP BY strategy) d ON d.strategy = p.strategy"""


def downside(t):
    equity, log = curves(t)
    return risk.downside_metrics(equity, risk.performance_metrics(equity, log))


query("downside_metrics", "calmar_ratio downside_deviation sortino_ratio", DOWNSIDE_SQL)(downside)


def comparison(t):
    equity, log = curves(t)
    performance = risk.performance_metrics(equity, log)
    table = risk.strategy_comparison(performance, risk.risk_analysis(equity, performance))
    return table.select(
        "strategy", "sharpe_ratio", "sortino_ratio", "calmar_ratio", "sharpe_ratio_rank", "sortino_ratio_rank", "calmar_ratio_rank"
    )


query(
    "strategy_comparison",
    "sharpe_ratio sortino_ratio calmar_ratio",
    f"""SELECT *, row_number() OVER (ORDER BY sharpe_ratio DESC)::INT AS sharpe_ratio_rank, row_number() OVER (ORDER BY sortino_ratio DESC)::INT AS sortino_ratio_rank,
          row_number() OVER (ORDER BY calmar_ratio DESC)::INT AS calmar_ratio_rank
        FROM (SELECT p.strategy, sharpe_ratio, sortino_ratio, calmar_ratio FROM ({PERFORMANCE_SQL}) p JOIN ({DOWNSIDE_SQL}) d ON d.strategy = p.strategy)""",
)(comparison)
