"""Order-dependent columns of a return series: steps, growth, peaks and drawdowns.

A series is either kept per key (`by`, one row per key and date: at most one row per
calendar day in a window) or pooled over all tickers in (date, ticker) order. A pooled
series is never ordered as a whole: totals per date are accumulated over the dates (a
table as long as the calendar) and the rows of a date start from its date's total.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickerloom.functions.numeric import running


def _dates() -> Window:
    return Window.orderBy("date")


def _earlier_dates():
    return _dates().rowsBetween(Window.unboundedPreceding, -1)


def _in_order(by: list[str]):
    return Window.partitionBy(*by).orderBy("date") if by else Window.partitionBy("date").orderBy("ticker")


def with_previous(df: DataFrame, value: str, name: str, start, by: Iterable[str] = ()) -> DataFrame:
    """Adds the value of the row before; `start` on a series' first row."""
    by = list(by)
    inside = F.lag(value, 1).over(_in_order(by))
    if by:
        return df.withColumn(name, F.coalesce(inside, F.lit(start)))
    last = df.groupBy("date").agg(F.max_by(value, "ticker").alias("_last"))
    carried = last.select("date", F.lag("_last", 1).over(_dates()).alias("_carried"))
    return (
        df.withColumn("_inside", inside)
        .join(carried, "date")
        .withColumn(name, F.coalesce("_inside", "_carried", F.lit(start)))
        .drop("_inside", "_carried")
    )


def with_running_sums(df: DataFrame, terms: dict[str, Column], by: Iterable[str] = ()) -> DataFrame:
    """Adds the running sum of every term; null until the series (pooled: the date) has a value."""
    by = list(by)
    inside = {name: F.sum(term).over(running(_in_order(by))) for name, term in terms.items()}
    if by:
        return df.withColumns(inside)
    per_date = df.groupBy("date").agg(*[F.sum(term).alias(f"_total{name}") for name, term in terms.items()])
    before = per_date.select(
        "date",
        *[F.coalesce(F.sum(f"_total{name}").over(_earlier_dates()), F.lit(0)).alias(f"_before{name}") for name in terms],
    )
    summed = df.withColumns(inside).join(before, "date")
    return summed.withColumns({name: F.col(name) + F.col(f"_before{name}") for name in terms}).drop(
        *[f"_before{name}" for name in terms]
    )


def _with_log_parts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Adds running sums of (1 + value): logarithms of the sizes, counts of negative and of zero factors."""
    factor = 1 + F.col(value)
    terms = {
        "_log": F.when(factor != 0, F.ln(F.abs(factor))).when(factor == 0, 0.0),
        "_negative": (factor < 0).cast("long"),
        "_zero": (factor == 0).cast("long"),
    }
    return with_running_sums(df, terms, by)


def with_log_growth(df: DataFrame, value: str, name: str, by: Iterable[str] = ()) -> DataFrame:
    """Adds the logarithm of the running product of (1 + value); null where that is not positive."""
    grown = _with_log_parts(df, value, list(by))
    positive = (F.col("_zero") == 0) & (F.col("_negative") % 2 == 0)
    return grown.withColumn(name, F.when(positive, F.col("_log"))).drop("_log", "_negative", "_zero")


def with_growth(df: DataFrame, value: str, name: str, by: Iterable[str] = ()) -> DataFrame:
    """Adds the running product of (1 + value), from sums of logarithms.

    A product beyond the double range is infinite; `with_return_drawdown` does not go through it.
    """
    sign = F.when(F.col("_negative") % 2 == 1, -1.0).otherwise(1.0)
    product = F.when(F.col("_zero") > 0, 0.0).otherwise(sign * F.exp("_log"))
    return _with_log_parts(df, value, list(by)).withColumn(name, product).drop("_log", "_negative", "_zero")


def with_return_drawdown(df: DataFrame, value: str, name: str, by: Iterable[str] = ()) -> DataFrame:
    """Adds the distance of the running product of (1 + value) from its peak, kept in logarithms throughout."""
    by = list(by)
    grown = _with_log_parts(df, value, by)
    positive = (F.col("_zero") == 0) & (F.col("_negative") % 2 == 0)
    peaked = with_peak(grown.withColumn("_up", F.when(positive, F.col("_log"))), "_up", "_top", by)
    gap = F.col("_log") - F.col("_top")
    drawdown = F.when(F.col("_zero") > 0, -1.0).when(positive, F.expm1(gap)).otherwise(-F.exp(gap) - 1)
    return peaked.withColumn(name, drawdown).drop("_log", "_negative", "_zero", "_up", "_top")


def with_peak(df: DataFrame, value: str, name: str, by: Iterable[str] = ()) -> DataFrame:
    """Adds the running maximum."""
    by = list(by)
    inside = F.max(value).over(running(_in_order(by)))
    if by:
        return df.withColumn(name, inside)
    per_date = df.groupBy("date").agg(F.max(value).alias("_m"))
    before = per_date.select("date", F.max("_m").over(_earlier_dates()).alias("_before"))
    return (
        df.withColumn("_inside", inside)
        .join(before, "date")
        .withColumn(name, F.greatest("_inside", "_before"))
        .drop("_inside", "_before")
    )


def with_drawdown(df: DataFrame, value: str, name: str, by: Iterable[str] = ()) -> DataFrame:
    """Adds the relative distance of a curve from its running peak."""
    peaked = with_peak(df, value, "_peak", by)
    return peaked.withColumn(name, F.try_divide(F.col(value) - F.col("_peak"), F.col("_peak"))).drop("_peak")


def last_value(value: str, by: Iterable[str] = ()) -> Column:
    """Aggregate: the value on a series' last row."""
    return F.max_by(value, F.struct("date") if list(by) else F.struct("date", "ticker"))


def date_rank(df: DataFrame) -> DataFrame:
    """Adds `_before`: the number of rows on earlier dates, and `_rows`: the table's rows.

    From counts per date, accumulated over the calendar.
    """
    per_date = df.groupBy("date").agg(F.count("*").alias("_n"))
    everything = Window.partitionBy()
    ranks = per_date.select(
        "date",
        F.coalesce(F.sum("_n").over(_earlier_dates()), F.lit(0)).alias("_before"),
        F.sum("_n").over(everything).alias("_rows"),
    )
    return df.join(ranks, "date")


def row_rank(df: DataFrame) -> DataFrame:
    """Adds `_rank` (0-based, by date then ticker) and `_rows` without a global sort."""
    inside = F.row_number().over(Window.partitionBy("date").orderBy("ticker")) - 1
    return date_rank(df).withColumn("_rank", F.col("_before") + inside).drop("_before")
