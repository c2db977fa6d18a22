"""Time expressions.  Facts carry wall-clock hours as ``timestamp_ntz``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _col

TIME_PARTS = ("year", "month", "day", "hour")


def bucket(c: Column | str, grain: str = "hour") -> Column:
    """Start of the hour (or day, month) the time falls in."""
    return F.date_trunc(grain, _col(c)).cast("timestamp_ntz")


def with_time_parts(df: DataFrame, ts: str = "hour_ts") -> DataFrame:
    """Add year, month, day and hour of ``ts``."""
    return df.withColumns(
        {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)}
    )


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end, each side floored to the second first."""
    return F.unix_seconds(_col(end).cast("timestamp")) - F.unix_seconds(_col(start).cast("timestamp"))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def month_tag(c: Column | str) -> Column:
    """``yyyy-MM`` text, for labels and reports; filter with ``in_month`` instead."""
    return F.date_format(_col(c), "yyyy-MM")


def month_bounds(year: int, month: int) -> tuple[str, str]:
    """First instant of the month and of the next one."""
    nxt = (year + 1, 1) if month == 12 else (year, month + 1)
    return f"{year:04d}-{month:02d}-01 00:00:00", f"{nxt[0]:04d}-{nxt[1]:02d}-01 00:00:00"


def month_range(first: tuple[int, int], last: tuple[int, int]) -> list[tuple[int, int]]:
    """All (year, month) pairs from first to last, both included."""
    start, stop = first[0] * 12 + first[1] - 1, last[0] * 12 + last[1] - 1
    return [(i // 12, i % 12 + 1) for i in range(start, stop + 1)]


def parse_time(c: Column | str) -> Column:
    """Text to wall-clock time; unreadable text becomes NULL."""
    return _col(c).try_cast("timestamp_ntz")


def time_from_parts(year: str = "year", month: str = "month", day: str = "day", hour: str = "hour") -> Column:
    """Wall-clock time from its parts; impossible parts become NULL."""
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(F.col(year), F.col(month), F.col(day), F.col(hour), zero, zero)


def epoch_nanos_to_time(name: str, tz: str | None = None) -> Column:
    """Column of nanoseconds since the epoch to a time without zone.

    The time is UTC; with ``tz`` it becomes that zone's wall clock.
    """
    moment = F.expr(f"timestamp_micros(`{name}` div 1000)")
    if tz:
        moment = F.from_utc_timestamp(moment, tz)
    return moment.cast("timestamp_ntz")
