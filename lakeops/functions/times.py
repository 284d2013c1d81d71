"""Timestamp expressions.  Nothing raises on bad text: unparsable becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_date_and_time(date: Column, time: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp from a date column and a time-of-day column."""
    return F.try_to_timestamp(F.concat(date.cast("string"), F.lit(" "), time), F.lit(fmt))


def parse_iso(col: Column) -> Column:
    """Best-effort ISO-8601 parse (fraction and offset allowed)."""
    return col.try_cast("timestamp")


def iso_head(col: Column, length: int = 23) -> Column:
    """ISO text to ``yyyy-MM-dd HH:mm:ss.SSS`` by cutting and replacing the ``T``."""
    return F.replace(F.substring(col, 1, length), F.lit("T"), F.lit(" "))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, fraction dropped."""
    return F.timestamp_diff("SECOND", start, end)


def text_seconds_between(start: Column, end: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Difference of the second-truncated renderings of two timestamps."""
    return F.unix_timestamp(F.date_format(end, fmt), fmt) - F.unix_timestamp(F.date_format(start, fmt), fmt)


def day_parts(ts: Column) -> dict[str, Column]:
    """Landing partition columns."""
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}


def next_days(last: Column, days: int) -> Column:
    """Array of the ``days`` calendar days after ``last``."""
    return F.sequence(F.date_add(last, 1), F.date_add(last, days))


def without_zone(ts: Column) -> Column:
    """Wall-clock timestamp without a zone."""
    return ts.cast("timestamp_ntz")
