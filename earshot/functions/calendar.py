"""Calendar columns.

Wall-clock values are TIMESTAMP_NTZ, so that no result depends on the time zone
of the session.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def wall_clock(seconds: Column, tz: str = "UTC") -> Column:
    """Epoch seconds as the wall-clock time in ``tz``."""
    utc = F.timestamp_add("SECOND", seconds.cast("bigint"), F.expr(_EPOCH))
    if tz == "UTC":
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds from the epoch to a UTC wall-clock time, rounded down."""
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(F.to_date(ts)).cast("bigint") * 86_400 + clock


def instant(seconds: Column) -> Column:
    """Epoch seconds, with fraction, as TIMESTAMP to the nearest microsecond."""
    return F.timestamp_micros(F.rint(seconds * 1_000_000).cast("bigint"))


def day_name(ts: Column) -> Column:
    """English day name, such as ``Monday``."""
    return F.date_format(F.to_date(ts), "EEEE")


def iso_seconds(ts: Column) -> Column:
    """ISO-8601 text, without zone, of a wall-clock time in whole seconds.

    A cast, since ``date_format`` would pass through the zone of the session and
    shift the hour that its change to summer time skips.
    """
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def date_parts(ts: Column) -> dict[str, Column]:
    """The four partition keys of a wall-clock time, as INT."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end``."""
    return F.datediff(end, start)


def listen_moment(listen_time: Column, dtype: T.DataType) -> Column:
    """``listen_time`` as a timestamp, be it epoch seconds or one already."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return listen_time
    return wall_clock(listen_time)


def newest_first(listen_time: Column, dtype: T.DataType) -> Column:
    """A value whose ascending order runs from the newest time to the oldest."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(_EPOCH) - listen_time
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_seconds(F.lit(0)) - listen_time
    return -listen_time


def within_day(listen_time: Column, dtype: T.DataType, day: date) -> Column:
    """Half-open range predicate for one UTC day.

    A plain comparison with literals reaches the Parquet scan, where
    ``year(x) = ...`` does not.
    """
    start = datetime(day.year, day.month, day.day)
    bounds = (start, start + timedelta(days=1))
    if isinstance(dtype, T.TimestampNTZType):
        low, high = (F.lit(f"{b:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz") for b in bounds)
    elif isinstance(dtype, T.TimestampType):
        low, high = (F.lit(b.replace(tzinfo=timezone.utc)) for b in bounds)
    else:
        low, high = (F.lit(int(b.replace(tzinfo=timezone.utc).timestamp())) for b in bounds)
    return (listen_time >= low) & (listen_time < high)
