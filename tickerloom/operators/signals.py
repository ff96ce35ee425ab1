"""Trading signals and their returns, positions and benchmark."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.functions import fixed_values as fixed
from tickerloom.operators import ordered


def trading_signal(
    probability: Column, long: float = fixed.LONG_THRESHOLD, short: float = fixed.SHORT_THRESHOLD
) -> Column:
    """-1 at or below the short threshold, else 1 at or above the long one, else 0."""
    return F.when(probability <= short, -1).when(probability >= long, 1).otherwise(0)


def prediction_confidence(probability: Column) -> Column:
    return F.abs(probability - 0.5) * 2


def with_strategy_returns(
    df: DataFrame,
    signal: str = "signal",
    value: str = "actual_return",
    by: Iterable[str] = (),
    cost: float = fixed.TRANSACTION_COST,
) -> DataFrame:
    """Adds `signal_change` and `strategy_return`: signal times return less the cost of
    changing the signal, starting from no position."""
    placed = ordered.with_previous(df, signal, "_previous", 0, by)
    change = F.abs(F.col(signal) - F.col("_previous"))
    return placed.withColumns(
        {"signal_change": change, "strategy_return": F.col(signal) * F.col(value) - change * cost}
    ).drop("_previous")


def with_cumulative_returns(df: DataFrame, value: str = "actual_return", by: Iterable[str] = ()) -> DataFrame:
    """Adds `cumulative_return` of the strategy and `buy_hold_return` of holding."""
    grown = ordered.with_growth(df, "strategy_return", "cumulative_return", by)
    held = ordered.with_growth(grown, value, "buy_hold_return", by)
    return held.withColumns(
        {name: F.col(name) - 1 for name in ("cumulative_return", "buy_hold_return")}
    )


def return_summary(df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Total return of strategy and holding, and their difference, per series."""
    by = list(by)
    totals = df.groupBy(*by).agg(
        ordered.last_value("cumulative_return", by).alias("total_return"),
        ordered.last_value("buy_hold_return", by).alias("buy_hold_total_return"),
    )
    return totals.withColumn("excess_return", F.col("total_return") - F.col("buy_hold_total_return"))


def position_metrics(df: DataFrame, signal: str = "signal", by: Iterable[str] = ()) -> DataFrame:
    """Counts and shares of long, short and flat rows, and signal changes.

    Needs `signal_change`.
    """
    by = list(by)
    rows = F.count("*")
    kinds = {"long": 1, "short": -1, "hold": 0}
    counts = {kind: F.count_if(F.col(signal) == value) for kind, value in kinds.items()}
    trades = F.count_if(F.col("signal_change") > 0)
    return df.groupBy(*by).agg(
        rows.alias("total_positions"),
        *[count.alias(f"{kind}_positions") for kind, count in counts.items()],
        *[(count * 100.0 / rows).alias(f"{kind}_percentage") for kind, count in counts.items()],
        trades.alias("total_trades"),
        (trades / rows).alias("trades_per_period"),
    )
