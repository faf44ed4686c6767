"""POSIX times, countdowns and service times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def posix(text: Column) -> Column:
    """64-bit POSIX seconds, which the JSON rendering carries as text."""
    return text.try_cast("bigint")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def minutes_of_hour(seconds: Column) -> Column:
    """Whole minutes left after whole hours are taken away."""
    return F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("bigint")


def total_minutes(seconds: Column) -> Column:
    return F.floor(seconds / 60).cast("bigint")


def service_time(start_date: Column, start_time: Column) -> Column:
    """POSIX seconds of ``HH:MM:SS`` on service day ``YYYYMMDD``; hours may pass 24."""
    day = F.unix_date(F.to_date(F.try_to_timestamp(start_date, F.lit("yyyyMMdd"))))
    part = F.split(start_time, ":")
    h, m, s = (F.get(part, F.lit(i)).try_cast("bigint") for i in range(3))
    return day.cast("bigint") * 86400 + h * 3600 + m * 60 + s


def path_parts(ts: Column) -> list[Column]:
    """Year, month, day and 24-hour clock of a record time, as path values."""
    return [F.date_format(ts, pattern).alias(name) for name, pattern in
            (("year", "y"), ("month", "M"), ("day", "d"), ("hour", "H"))]
