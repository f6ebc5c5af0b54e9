"""Explicit clock handling: operators receive ``as_of`` instead of reading the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_text(as_of) -> str:
    if isinstance(as_of, dt.datetime):
        return as_of.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(as_of, dt.date):
        return as_of.strftime("%Y-%m-%d 00:00:00")
    return str(as_of)


def ts_lit(as_of) -> Column:
    """``as_of`` as a timestamp_ntz literal (the type of the driver tables)."""
    return F.lit(as_of_text(as_of)).cast("timestamp_ntz")


def date_lit(as_of) -> Column:
    return F.lit(as_of_text(as_of)[:10]).cast("date")


def epoch_seconds(col) -> Column:
    """Whole epoch seconds of a timestamp or timestamp_ntz column (UTC session)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp").cast("long")


def epoch_micros(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


UNIT_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}


def period_seconds(count: int, period: str) -> int:
    period = period.rstrip("s")
    if period not in UNIT_SECONDS:
        raise ValueError(f"unknown period {period!r}; use minute, hour or day")
    return int(count) * UNIT_SECONDS[period]
