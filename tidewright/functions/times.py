"""Timestamps and intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_parts(ts) -> dict[str, Column]:
    """Day of month, hour and minute as short columns."""
    return {
        "day": F.dayofmonth(ts).cast("short"),
        "hour": F.hour(ts).cast("short"),
        "minute": F.minute(ts).cast("short"),
    }


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970, rounded down."""
    return F.unix_timestamp(ts)


def compact_date(text) -> Column:
    """``20240131`` to ``2024-01-31``; text that is no date gives null."""
    return F.date_format(F.try_to_timestamp(text, F.lit("yyyyMMdd")), "yyyy-MM-dd")


def due_by(action_ts, interval_days, now) -> Column:
    """Is ``action_ts`` plus an interval in days at or before ``now``?"""
    days = F.col(interval_days) if isinstance(interval_days, str) else interval_days
    start = F.col(action_ts) if isinstance(action_ts, str) else action_ts
    return start + F.make_dt_interval(days.cast("int")) <= now
