"""Calendar functions: market time, trading dates, parts, flags and cycles."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tickerloom.functions import fixed_values as fixed


def market_time(timestamp: Column, zone: str = fixed.MARKET_TIMEZONE) -> Column:
    """UTC instant to wall-clock time of the market (session zone is UTC)."""
    return F.from_utc_timestamp(timestamp, zone)


def next_weekday(date: Column) -> Column:
    """The date itself, or the Monday after a weekend."""
    shift = F.when(F.weekday(date) == 5, 2).when(F.weekday(date) == 6, 1).otherwise(0)
    return F.date_add(date, shift)


def trading_date(timestamp: Column, zone: str = fixed.MARKET_TIMEZONE) -> Column:
    """Day an article counts for: after the close the next day, never a weekend."""
    local = market_time(timestamp, zone)
    after_close = (F.hour(local) >= fixed.MARKET_CLOSE_HOUR).cast("int")
    return next_weekday(F.date_add(F.to_date(local), after_close))


def is_weekday(date: Column) -> Column:
    return F.weekday(date) < 5


def calendar_parts(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "day_of_week": F.weekday(date),
        "day_of_month": F.dayofmonth(date),
        "week_of_year": F.weekofyear(date),
    }


def calendar_flags(date: Column) -> dict[str, Column]:
    month_end = date == F.last_day(date)
    return {
        "is_monday": (F.weekday(date) == 0).cast("int"),
        "is_friday": (F.weekday(date) == 4).cast("int"),
        "is_month_end": month_end.cast("int"),
        "is_month_start": (F.dayofmonth(date) == 1).cast("int"),
        "is_quarter_end": (month_end & (F.month(date) % 3 == 0)).cast("int"),
    }


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * (2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def cyclical_parts(date: Column) -> dict[str, Column]:
    month_sin, month_cos = cycle(F.month(date), 12)
    day_sin, day_cos = cycle(F.weekday(date), 7)
    return {
        "month_sin": month_sin,
        "month_cos": month_cos,
        "day_of_week_sin": day_sin,
        "day_of_week_cos": day_cos,
    }


def age_hours(timestamp: Column, as_of: Column) -> Column:
    return (F.unix_micros(as_of) - F.unix_micros(timestamp)) / F.lit(3.6e9)


def in_market_hours(timestamp: Column) -> Column:
    """9 to 16 o'clock (the hour 16 included) on weekdays, as written in the timestamp."""
    inside = F.hour(timestamp).between(9, 16) & is_weekday(F.to_date(timestamp))
    return F.coalesce(inside, F.lit(False)).cast("int")


def parse_feed_time(text: Column) -> Column:
    """Compact feed time, ISO or blank-separated time; anything else becomes null."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmmss")),
        F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmm")),
        F.try_to_timestamp(text),
    )


def feed_time_argument(timestamp: Column, end_of_day: bool = False) -> Column:
    """Time-range argument of the feed: the day's first or last minute."""
    return F.date_format(timestamp, "yyyyMMdd'T2359'" if end_of_day else "yyyyMMdd'T0000'")


def month_of(date: Column) -> Column:
    return F.trunc(date, "month")


def quarter_of(date: Column) -> Column:
    return F.trunc(date, "quarter")


def days_between(start: Column, end: Column) -> Column:
    return F.date_diff(end, start)
