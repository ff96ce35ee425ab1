"""Evaluation of predictions and of fitted models: metrics, positions, returns, risk, periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickerloom.models.training import FittedModel
from tickerloom.operators import metrics, risk, signals
from tickerloom.session import materialize


def comprehensive_evaluation(df: DataFrame) -> dict[str, DataFrame]:
    """All evaluation tables of rows (ticker, date, y_true, y_pred, y_proba, actual_return).

    The rows are one series in (date, ticker) order.
    """
    traded = signals.with_strategy_returns(df.withColumn("signal", signals.trading_signal(F.col("y_proba"))))
    return {
        "classification": metrics.classification_metrics(df, score="y_proba"),
        "positions": signals.position_metrics(traded),
        "returns": signals.return_summary(signals.with_cumulative_returns(traded)),
        "risk": risk.risk_metrics(traded, benchmark="actual_return"),
        "monthly": metrics.period_performance(traded, "month"),
        "quarterly": metrics.period_performance(traded, "quarter"),
        "span": metrics.evaluation_span(df),
    }


def backtest_model(model: FittedModel, df: DataFrame, return_column: str = "next_day_return") -> dict[str, DataFrame]:
    """Predict held-out rows and evaluate; without the return column returns count as 0."""
    scored = model.predict(df.where(F.col(model.target).isNotNull()))
    value = F.coalesce(F.col(return_column), F.lit(0.0)) if return_column in df.columns else F.lit(0.0)
    rows = scored.select(
        "ticker",
        "date",
        F.col(model.target).cast("int").alias("y_true"),
        F.col(f"{model.name}_prediction").alias("y_pred"),
        F.col(f"{model.name}_probability").alias("y_proba"),
        value.alias("actual_return"),
    )
    # Every table reads the predictions, so the model runs once.
    return comprehensive_evaluation(materialize(rows))


def report_lines(tables: dict[str, DataFrame], title: str) -> DataFrame:
    """The numbers of the one-row tables as text lines (section, measure, value)."""
    parts = []
    for section in ("classification", "positions", "returns", "risk"):
        table = tables[section]
        values = [F.struct(F.lit(name).alias("measure"), F.col(name).cast("double").alias("value")) for name in table.columns]
        parts.append(
            table.select(F.lit(title).alias("model"), F.lit(section).alias("section"), F.inline(F.array(*values)))
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
