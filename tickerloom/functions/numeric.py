"""Numeric helpers: flags with missing-as-false, rolling frames, bins, EMA terms."""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable, Iterable

from pyspark.sql import Column, Window, WindowSpec, functions as F


def by_ticker() -> WindowSpec:
    """A ticker's rows in date order.

    Bars have one row per (ticker, day) after keyed de-duplication, so a ticker's window
    holds at most one row per calendar day (36,525 a century) whatever the raw data size.
    """
    return Window.partitionBy("ticker").orderBy("date")


def running(window: WindowSpec | None = None) -> WindowSpec:
    return (window or by_ticker()).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def flag(condition: Column) -> Column:
    """1 where the condition holds; a missing operand makes it 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def rolling(
    aggregate: Callable[[Column], Column],
    value: Column | str,
    rows: int,
    window: WindowSpec | None = None,
    min_periods: int | None = None,
) -> Column:
    """Aggregate over the last `rows` rows, null below `min_periods` present values."""
    value = F.col(value) if isinstance(value, str) else value
    frame = (window or by_ticker()).rowsBetween(1 - rows, 0)
    needed = rows if min_periods is None else min_periods
    result = aggregate(value).over(frame)
    if needed <= 1:
        return result
    return F.when(F.count(value).over(frame) >= needed, result)


def lag_change(value: Column | str, periods: int) -> Column:
    """Relative change against the value `periods` rows ago."""
    value = F.col(value) if isinstance(value, str) else value
    return F.try_divide(value, F.lag(value, periods).over(by_ticker())) - 1


def rolling_median(value: Column, rows: int, min_periods: int) -> Column:
    """Median of a bounded frame: `rows` values are sorted per row."""
    frame = by_ticker().rowsBetween(1 - rows, 0)
    ordered = F.sort_array(F.collect_list(value).over(frame))
    size = F.size(ordered)
    middle = (
        F.get(ordered, F.floor((size - 1) / 2).cast("int")) + F.get(ordered, F.floor(size / 2).cast("int"))
    ) / 2
    return F.when(size >= min_periods, middle)


def ema_rows(span: int) -> int:
    """Block length after which the span's weight falls below 1e-17."""
    decay = 1 - 2 / (span + 1)
    return math.ceil(17 * math.log(10) / -math.log(decay))


def ema(value: Column | str, span: int, position: Column) -> Column:
    """Exponential mean with weights (1 - alpha)^k over all earlier rows, alpha = 2/(span+1).

    Rows are cut into blocks, as long as the span needs: weights inside a block then stay
    between 1 and 1e17. Inside a block a running sum of value/decay^offset gives the
    block's part in one pass; the block before it enters with its total. Rows two
    blocks back weigh less than 1e-17 and cannot change a double. `position` is the
    row's 0-based place in its ticker.
    """
    if span <= 1:
        return F.col(value) if isinstance(value, str) else value
    block_rows = ema_rows(span)
    value = F.col(value) if isinstance(value, str) else value
    decay = 1 - 2 / (span + 1)
    offset = position % block_rows
    block = F.floor(position / block_rows)
    current = running(Window.partitionBy("ticker", block).orderBy("date"))
    previous = Window.partitionBy("ticker").orderBy(block).rangeBetween(-1, -1)
    fade = F.pow(F.lit(decay), offset)
    gain = F.pow(F.lit(decay), -offset)

    def decayed(term: Column) -> Column:
        older = F.coalesce(F.sum(term * gain).over(previous), F.lit(0.0)) * (decay**block_rows)
        return fade * (F.coalesce(F.sum(term * gain).over(current), F.lit(0.0)) + older)

    present = value.isNotNull().cast("double")
    return F.try_divide(decayed(value), decayed(present))


def five_bins(value: Column) -> Column:
    """Right-closed bins at -2 %, -0.5 %, 0.5 % and 2 %; missing stays missing."""
    return (
        F.when(value <= -0.02, "strong_negative")
        .when(value <= -0.005, "negative")
        .when(value <= 0.005, "neutral")
        .when(value <= 0.02, "positive")
        .when(value.isNotNull(), "strong_positive")
    )


def three_classes(value: Column, threshold: float = 0.005) -> Column:
    """2 above the threshold, 0 below its negative, else (and if missing) 1."""
    return F.when(value > threshold, 2).when(value < -threshold, 0).otherwise(1)


def direction(value: Column) -> Column:
    return flag(value > 0)


def row_std(columns: list[Column]) -> Column:
    """Sample standard deviation across columns, missing taken as 0."""
    values = [F.coalesce(column.cast("double"), F.lit(0.0)) for column in columns]
    mean = functools.reduce(operator.add, values) / len(values)
    squares = functools.reduce(operator.add, [(value - mean) * (value - mean) for value in values])
    return F.sqrt(squares / (len(values) - 1))


def row_max_abs(columns: list[Column]) -> Column:
    values = [F.abs(F.coalesce(column.cast("double"), F.lit(0.0))) for column in columns]
    return F.greatest(*values) if len(values) > 1 else values[0]


def count_true(conditions: list[Column]) -> Column:
    """How many conditions hold; an array keeps hundreds of them a flat expression."""
    return F.size(F.filter(F.array(*conditions), lambda condition: condition))


def infinite_to_null(value: Column) -> Column:
    unusable = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(~unusable, value)


def sigmoid(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def sample_skewness(value: Column | str) -> Column:
    """Bias-corrected skewness aggregate, null below three values or without spread."""
    value = F.col(value) if isinstance(value, str) else value
    count = F.count(value)
    factor = F.sqrt(count * (count - 1)) / F.when(count > 2, count - 2)
    return F.when(F.stddev_pop(value) > 0, F.skewness(value) * factor)
