"""Log time functions (F-05..F-08)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.logformat import LOG_TIME_FORMAT


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def parse_log_time(c: Column | str) -> Column:
    """F-05: any numeric offset is honoured; a bad value gives null instead
    of failing the job."""
    return F.try_to_timestamp(_c(c), F.lit(LOG_TIME_FORMAT))


def epoch_seconds(ts: Column | str) -> Column:
    """F-06: UTC epoch seconds as bigint."""
    return F.unix_timestamp(_c(ts))


def decimal_hour(ts: Column | str) -> Column:
    """F-07: hour + minute / 60."""
    t = _c(ts)
    return F.hour(t) + F.minute(t) / F.lit(60.0)


def day_of_week(ts: Column | str) -> Column:
    """F-08: 1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(_c(ts))
