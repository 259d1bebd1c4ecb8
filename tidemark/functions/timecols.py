"""Time features computed on TIMESTAMP_NTZ without any time-zone round trip.

``date_trunc`` on NTZ returns a zoned timestamp in Spark, which makes the
result depend on the session zone (DST gaps shift wall-clock hours).  These
helpers go through DATE, which is zone-free, so a post's day / week / hour
is the same on every cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_ntz(x: Column | str) -> Column:
    """Timestamps or ISO-8601 text (with or without fraction) -> NTZ."""
    return _c(x).cast("timestamp_ntz")


def trunc_day(ts: Column | str) -> Column:
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def trunc_hour(ts: Column | str) -> Column:
    return F.timestamp_add("HOUR", F.hour(_c(ts)), trunc_day(ts))


def trunc_week(ts: Column | str) -> Column:
    """Monday-based week start."""
    return F.trunc(F.to_date(_c(ts)), "week").cast("timestamp_ntz")


def trunc_month(ts: Column | str) -> Column:
    return F.trunc(F.to_date(_c(ts)), "month").cast("timestamp_ntz")


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(_c(ts)).cast("long")


def day_of_week(ts: Column | str) -> Column:
    """Sunday = 0 ... Saturday = 6 (Spark's dayofweek is Sunday = 1)."""
    return (F.dayofweek(_c(ts)) - 1).cast("long")


def is_weekend(ts: Column | str) -> Column:
    return day_of_week(ts).isin(0, 6)
