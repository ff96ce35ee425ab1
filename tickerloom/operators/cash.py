"""Cash of a strategy after every entry and exit, over blocks of tickers side by side.

Cash after an event depends on all earlier events, in date and ticker order: an entry costs a
share of the cash at that moment, an exit returns that cost with its profit. Both are linear in the
cash with which the day began, so what a block of tickers does to the cash is a matrix over days: a day's
cash behind the block is a combination of the cash before it on that day and on the days its
positions were opened. Blocks work out their matrices side by side; the calendar is then solved day by day on
the product of the matrices; with the cash in front of it known, each block books its own events.

The calendar is cut into segments, which bound the matrices; costs of positions that stay open
enter the next segment as known amounts. So the number of Spark jobs depends on the calendar, and
the tasks on the number of events.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.functions import fixed_values as fixed
from tickerloom.session import checkpoint_folder, materialize, ship_package

SEGMENT_DATES = 1024
EVENTS_A_BLOCK = 1 << 18
EVENTS = "strategy string, ticker string, date date, entry_date date, is_exit boolean, cash double, cost double"
MAPS = "strategy string, block int, day int, coefficients array<double>, amount double"


def cash_share(confidence: Column) -> Column:
    """The share of cash an entry costs: 2 % scaled by confidence, at most 10 %."""
    return F.least(0.02 * confidence, F.lit(0.1))


def position_events(taken: DataFrame, gain: Column) -> DataFrame:
    """One row per entry and exit of positions; `gain` is a closed position's return."""
    entry = F.struct(F.col("entry_date").alias("date"), F.lit(False).alias("is_exit"), F.lit(1.0).alias("growth"))
    leave = F.struct(F.col("exit_date").alias("date"), F.lit(True).alias("is_exit"), (1 + gain).alias("growth"))
    return taken.select(
        "strategy", "ticker", "entry_date", cash_share(F.col("confidence")).alias("share"), F.inline(F.array(entry, leave))
    ).where(F.col("date").isNotNull())


def _with_blocks(events: DataFrame, n_blocks: int) -> DataFrame:
    """Adds `block`: ranges of tickers, in order, with about as many tickers each."""
    if n_blocks == 1:
        return events.withColumn("block", F.lit(0))
    tickers = events.select("ticker").distinct().repartitionByRange(n_blocks, "ticker")
    # Range bounds are drawn anew in every run of this plan, so the blocks are written down.
    return events.join(materialize(tickers.withColumn("block", F.spark_partition_id())), "ticker")


def _in_order(events: pd.DataFrame) -> Iterator[tuple]:
    """Events by ticker, then day: a ticker has one event a day, and days do not meet within a block."""
    ordered = events.sort_values(["ticker", "day"], kind="stable")
    return zip(ordered["ticker"], ordered["day"], ordered["is_exit"], ordered["share"], ordered["growth"], ordered["paid"])


def _block_map(first_day: int, n_days: int) -> Callable:
    def block_map(key: tuple, events: pd.DataFrame) -> pd.DataFrame:
        matrix, amounts = np.eye(n_days), np.zeros(n_days)
        open_costs: dict[str, tuple[np.ndarray, float]] = {}
        for ticker, day, is_exit, share, growth, paid in _in_order(events):
            day -= first_day
            if not is_exit:
                open_costs[ticker] = share * matrix[day], share * amounts[day]
                matrix[day] *= 1 - share
                amounts[day] *= 1 - share
            elif ticker in open_costs:
                row, amount = open_costs.pop(ticker)
                matrix[day] += growth * row
                amounts[day] += growth * amount
            else:
                amounts[day] += growth * paid
        return pd.DataFrame(
            {"strategy": key[0], "block": key[1], "day": np.arange(n_days), "coefficients": list(matrix), "amount": amounts}
        )

    return block_map


def _blocks_of(batches: Iterator[pd.DataFrame], n_days: int) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
    """(strategy, block, matrix, amounts) from rows sorted by strategy, block and day; one block is held at a time."""
    rows: list[tuple] = []
    for batch in batches:
        for row in batch.itertuples(index=False):
            rows.append(row)
            if len(rows) == n_days:
                yield row.strategy, row.block, np.array([r.coefficients for r in rows]), np.array([r.amount for r in rows])
                rows = []


def _solve(matrix: np.ndarray, amounts: np.ndarray, start: float) -> np.ndarray:
    """Cash at the beginning of every day, and behind the last."""
    cash = np.empty(len(matrix) + 1)
    cash[0] = start
    for day in range(len(matrix)):
        cash[day + 1] = matrix[day, : day + 1] @ cash[: day + 1] + amounts[day]
    return cash


def _day_cash(n_days: int, start: dict[str, float]) -> Callable:
    """Cash by day from the product of a strategy's block maps."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, matrix, amounts = None, np.eye(n_days), np.zeros(n_days)
        for strategy, _, own, add in _blocks_of(batches, n_days):
            if current not in (None, strategy):
                yield pd.DataFrame({"strategy": [current], "cash": [_solve(matrix, amounts, start[current])]})
            if current != strategy:
                current, matrix, amounts = strategy, np.eye(n_days), np.zeros(n_days)
            matrix, amounts = own @ matrix, own @ amounts + add
        if current is not None:
            yield pd.DataFrame({"strategy": [current], "cash": [_solve(matrix, amounts, start[current])]})

    return run


def _block_cash(n_days: int, days: dict[str, np.ndarray]) -> Callable:
    """Cash by day in front of every block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, cash = None, np.zeros(n_days)
        for strategy, block, own, add in _blocks_of(batches, n_days):
            if current != strategy:
                current, cash = strategy, days[strategy][:-1]
            yield pd.DataFrame({"strategy": [strategy], "block": [block], "before": [cash]})
            cash = own @ cash + add

    return run


def _book(first_day: int) -> Callable:
    def book(events: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        cash = np.array(before["before"].iloc[0])
        open_costs: dict[str, float] = {}
        after, cost = [], []
        for ticker, day, is_exit, share, growth, paid in _in_order(events):
            day -= first_day
            if not is_exit:
                paid = open_costs[ticker] = share * cash[day]
                cash[day] -= paid
            else:
                paid = open_costs.pop(ticker, paid)
                cash[day] += growth * paid
            after.append(cash[day])
            cost.append(paid)
        ordered = events.sort_values(["ticker", "day"], kind="stable")
        return ordered[["strategy", "ticker", "date", "entry_date", "is_exit"]].assign(cash=after, cost=cost)

    return book


def book_events(
    events: DataFrame,
    initial_capital: float = fixed.INITIAL_CAPITAL,
    segment_dates: int = SEGMENT_DATES,
    events_a_block: int = EVENTS_A_BLOCK,
) -> DataFrame:
    """Cash after every event of `position_events`, and the position's entry cost.

    A ticker has at most one event of a strategy a day. The driver holds the calendar and one
    number per strategy and day. An empty table has no rows.
    """
    spark = events.sparkSession
    ship_package(spark)
    events = materialize(events)
    counts = sorted((row["date"], row["count"]) for row in events.groupBy("date").count().collect())
    if not counts:
        return spark.createDataFrame([], EVENTS)
    calendar = spark.createDataFrame([(date, day) for day, (date, _) in enumerate(counts)], "date date, day int")
    n_blocks = -(-sum(n for _, n in counts) // events_a_block)
    placed = materialize(_with_blocks(events, n_blocks).join(F.broadcast(calendar), "date"))
    cash = {row["strategy"]: initial_capital for row in placed.select("strategy").distinct().collect()}
    # Segments are written one after the other: plans stay as short as one segment's.
    folder = f"{checkpoint_folder(spark).rstrip('/')}/cash-{uuid.uuid4().hex}"
    for first_day in range(0, len(counts), segment_dates):
        n_days = min(segment_dates, len(counts) - first_day)
        own = placed.where(F.col("day").between(first_day, first_day + n_days - 1))
        if first_day == 0:
            own = own.withColumn("paid", F.lit(0.0))
        else:
            booked = spark.read.schema(EVENTS).parquet(f"{folder}/*")
            paid = booked.where(~F.col("is_exit")).select("strategy", "ticker", "entry_date", F.col("cost").alias("paid"))
            own = own.join(paid, ["strategy", "ticker", "entry_date"], "left").na.fill(0.0, ["paid"])
        maps = own.groupBy("strategy", "block").applyInPandas(_block_map(first_day, n_days), MAPS)
        ordered = materialize(maps).repartition(len(cash), "strategy").sortWithinPartitions("strategy", "block", "day")
        days = {
            row["strategy"]: np.array(row["cash"])
            for row in ordered.mapInPandas(_day_cash(n_days, cash), "strategy string, cash array<double>").collect()
        }
        before = ordered.mapInPandas(_block_cash(n_days, days), "strategy string, block int, before array<double>")
        inputs = own.groupBy("strategy", "block").cogroup(before.groupBy("strategy", "block"))
        inputs.applyInPandas(_book(first_day), EVENTS).write.parquet(f"{folder}/day-{first_day:06d}")
        cash = {strategy: float(days[strategy][-1]) if strategy in days else amount for strategy, amount in cash.items()}
    return spark.read.schema(EVENTS).parquet(f"{folder}/*")
