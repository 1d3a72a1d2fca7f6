"""Timestamps, all in UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Further layouts that are taken besides ISO 8601.
LAYOUTS = ("yyyyMMdd", "yyyyMMdd'T'HHmmssX", "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss")


def parse_timestamp(col: Column) -> Column:
    """Timestamp of a text, null when it cannot be read."""
    # every layout begins with a number; a text that doesn't would cost an exception for each of them
    number = F.ascii(col).between(ord("+"), ord("9"))
    return F.coalesce(col.try_cast("timestamp"),
                      *[F.when(number, F.try_to_timestamp(col, F.lit(layout))) for layout in LAYOUTS])


def from_epoch(seconds: Column) -> Column:
    """Timestamp of epoch seconds given as text; null for zero, absent or unreadable."""
    whole = seconds.try_cast("double").try_cast("bigint")
    limit = 253_402_300_799  # last second of the year 9999
    return F.when((whole != 0) & F.abs(whole).between(0, limit), F.timestamp_seconds(whole))


def instant(value: Column | datetime | str) -> Column:
    """A fixed point in time as a column; text carries its offset."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def date_window(df: DataFrame, ts_col: str, start=None, end=None, last_days: int | None = None,
                as_of=None) -> DataFrame:
    """Rows with ``start <= ts < end``, or in the ``last_days`` whole days before ``as_of``.

    Without any bound every row is kept. The bounds are plain comparisons on the column, so they
    reach the Parquet scan.
    """
    ts = F.col(ts_col)
    if last_days is not None:
        today = F.date_trunc("day", instant(as_of) if as_of is not None else F.current_timestamp())
        df = df.filter((ts >= today - F.make_dt_interval(days=F.lit(last_days))) & (ts < today))
    if start is not None:
        df = df.filter(ts >= instant(start))
    if end is not None:
        df = df.filter(ts < instant(end))
    return df
