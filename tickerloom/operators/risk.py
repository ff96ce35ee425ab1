"""Risk and performance measures of return series, equity curves and trade logs."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickerloom.functions import fixed_values as fixed
from tickerloom.operators import ordered
from tickerloom.operators.quantiles import exact_quantiles

YEAR = fixed.TRADING_DAYS_PER_YEAR
INFINITE = float("inf")


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def risk_metrics(
    df: DataFrame,
    value: str = "strategy_return",
    by: Iterable[str] = (),
    benchmark: str | None = None,
    risk_free: float = fixed.RISK_FREE_RATE,
) -> DataFrame:
    """Moments, Sharpe, drawdown, Calmar, win and loss, Sortino and information ratio.

    Deviations are population ones. `benchmark` names a column of real returns.
    """
    by = list(by)
    daily_free = risk_free / YEAR
    x = F.col(value)
    curve = ordered.with_return_drawdown(df, value, "_drawdown", by)
    measures = [
        F.avg(x).alias("mean_daily_return"),
        F.stddev_pop(x).alias("volatility"),
        F.min("_drawdown").alias("max_drawdown"),
        (F.count_if(x > 0) / F.count("*")).alias("win_rate"),
        _or_zero(F.avg(F.when(x > 0, x))).alias("avg_win"),
        _or_zero(F.avg(F.when(x < 0, x))).alias("avg_loss"),
        F.stddev_pop(F.when(x < daily_free, x)).alias("_downside"),
    ]
    if benchmark:
        active = x - F.col(benchmark)
        measures += [F.avg(active).alias("_active"), F.stddev_pop(active).alias("_tracking")]
    moments = curve.groupBy(*by).agg(*measures)

    root = math.sqrt(YEAR)
    annual = F.col("mean_daily_return") * YEAR
    downside = F.col("_downside") * root
    ratios = {
        "annualized_return": annual,
        "annualized_volatility": F.col("volatility") * root,
        "sharpe_ratio": _or_zero(
            F.try_divide(F.col("mean_daily_return") - daily_free, F.col("volatility")) * root
        ),
        "calmar_ratio": F.when(F.col("max_drawdown") < 0, annual / F.abs("max_drawdown"))
        .when(annual > 0, INFINITE)
        .otherwise(0.0),
        "win_loss_ratio": F.coalesce(F.abs(F.try_divide(F.col("avg_win"), F.col("avg_loss"))), F.lit(INFINITE)),
        "sortino_ratio": F.when(downside > 0, (annual - risk_free) / downside).otherwise(INFINITE),
    }
    if benchmark:
        ratios["information_ratio"] = _or_zero(F.try_divide(F.col("_active") * YEAR, F.col("_tracking") * root))
    return moments.withColumns(ratios).drop("_downside", "_active", "_tracking")


def equity_returns(equity: DataFrame) -> DataFrame:
    """Relative change of an equity curve (`strategy`, `date`, `value`) per strategy."""
    in_order = Window.partitionBy("strategy").orderBy("date")
    return equity.withColumn("equity_return", F.try_divide(F.col("value"), F.lag("value", 1).over(in_order)) - 1)


def performance_metrics(
    equity: DataFrame, trades: DataFrame, initial_capital: float = fixed.INITIAL_CAPITAL
) -> DataFrame:
    """Return, volatility, Sharpe, drawdown and trade statistics per strategy.

    A curve has one value per day, so a strategy's rows are bounded by the calendar.
    """
    curve = ordered.with_drawdown(equity_returns(equity), "value", "drawdown", ["strategy"])
    days = F.count("*")
    total = F.max_by("value", "date") / initial_capital - 1
    curve_part = curve.groupBy("strategy").agg(
        total.alias("total_return"),
        (F.pow(1 + total, F.lit(float(YEAR)) / days) - 1).alias("annualized_return"),
        (F.stddev_samp("equity_return") * math.sqrt(YEAR)).alias("volatility"),
        F.min("drawdown").alias("max_drawdown"),
        F.max_by("value", "date").alias("final_value"),
    )
    x = F.col("return")
    trade_part = trades.groupBy("strategy").agg(
        (F.count_if(x > 0) / F.count("*")).alias("win_rate"),
        F.count("*").alias("num_trades"),
        _or_zero(F.avg(F.when(x > 0, x))).alias("avg_win"),
        _or_zero(F.avg(F.when(x < 0, x))).alias("avg_loss"),
    )
    profit = F.when(F.col("num_trades") > 0, F.coalesce(F.abs(F.try_divide(F.col("avg_win"), F.col("avg_loss"))), F.lit(INFINITE)))
    sharpe = F.when(F.col("volatility") > 0, (F.col("annualized_return") - fixed.RISK_FREE_RATE) / F.col("volatility"))
    return (
        curve_part.join(trade_part, "strategy", "left")
        .withColumns({"profit_factor": _or_zero(profit), "sharpe_ratio": _or_zero(sharpe)})
        .na.fill(0, subset=["win_rate", "num_trades", "avg_win", "avg_loss"])
    )


def value_at_risk(returns: DataFrame, value: str = "equity_return", by: Iterable[str] = ("strategy",)) -> DataFrame:
    """5 % and 1 % quantiles (linear) of daily returns and the means at or below them.

    The quantiles are exact, from a sketch and a counting pass.
    """
    by = list(by)
    present = returns.where(F.col(value).isNotNull())
    limits = exact_quantiles(present, [value], {"var_95": 0.05, "var_99": 0.01}, by).drop("column")
    tails = present.join(limits, by)
    x = F.col(value)
    return tails.groupBy(*by).agg(
        F.first("var_95").alias("var_95"),
        F.avg(F.when(x <= F.col("var_95"), x)).alias("cvar_95"),
        F.first("var_99").alias("var_99"),
        F.avg(F.when(x <= F.col("var_99"), x)).alias("cvar_99"),
    )


def downside_metrics(equity: DataFrame, performance: DataFrame) -> DataFrame:
    """Calmar ratio, downside deviation and Sortino ratio per strategy."""
    x = F.col("equity_return")
    downside = equity_returns(equity).groupBy("strategy").agg(
        _or_zero(F.stddev_samp(F.when(x < 0, x)) * math.sqrt(YEAR)).alias("downside_deviation")
    )
    excess = F.col("annualized_return") - fixed.RISK_FREE_RATE
    return performance.join(downside, "strategy").select(
        "strategy",
        F.coalesce(F.abs(F.try_divide(F.col("total_return"), F.col("max_drawdown"))), F.lit(INFINITE)).alias("calmar_ratio"),
        "downside_deviation",
        F.when(F.col("downside_deviation") > 0, excess / F.col("downside_deviation")).otherwise(0.0).alias("sortino_ratio"),
    )


def risk_analysis(equity: DataFrame, performance: DataFrame) -> DataFrame:
    return value_at_risk(equity_returns(equity)).join(downside_metrics(equity, performance), "strategy")


RANKED = ("sharpe_ratio", "sortino_ratio", "calmar_ratio")


def strategy_comparison(performance: DataFrame, risk: DataFrame) -> DataFrame:
    """Performance and risk side by side with the rank by each ratio (best first).

    One row per strategy.
    """
    joined = performance.join(risk, "strategy", "left")
    ranks = {
        f"{name}_rank": F.row_number().over(Window.orderBy(F.desc_nulls_last(name), "strategy")) for name in RANKED
    }
    return joined.withColumns(ranks)
