"""Time helpers that do not depend on the session time zone.

Windows are computed on a TIMESTAMP column (watermarks need one) and reported
as TIMESTAMP_NTZ wall-clock values in UTC. Both directions go through epoch
microseconds, so a session in any zone gives the same windows.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNITS_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def duration_us(d: str | int | float | dt.timedelta) -> int:
    """Microseconds of a window width: seconds as a number, a timedelta, or '3 seconds'."""
    if isinstance(d, dt.timedelta):
        return int(d / dt.timedelta(microseconds=1))
    if isinstance(d, (int, float)):
        return int(d * 1_000_000)
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", d.lower())
    if not m or m.group(2) not in _UNITS_US:
        raise ValueError(f"unsupported duration: {d!r}")
    return int(m.group(1)) * _UNITS_US[m.group(2)]


def interval_text(d: str | int | float | dt.timedelta) -> str:
    """The same duration as Spark interval text, e.g. '10800000000 microseconds'."""
    return f"{duration_us(d)} microseconds"


def ntz_micros(c: Column) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ value, read as UTC wall clock.

    Built from date and time-of-day fields, which carry no zone, so the
    session time zone (and its daylight saving) plays no part.
    """
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    secs = F.hour(c).cast("bigint") * 3600 + F.minute(c) * 60
    frac = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")  # seconds with microseconds
    return days * 86_400_000_000 + secs * 1_000_000 + frac


def micros_to_ntz(us: Column) -> Column:
    """TIMESTAMP_NTZ wall clock (UTC) of epoch microseconds."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH_NTZ))


def to_instant(c: Column, dtype: T.DataType) -> Column:
    """TIMESTAMP (instant) for a time column; NTZ values are read as UTC."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_micros(ntz_micros(c))
    if isinstance(dtype, T.TimestampType):
        return c
    raise TypeError(f"not a timestamp type: {dtype}")


def to_wall_clock(c: Column, dtype: T.DataType) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) for a time column of either type."""
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return micros_to_ntz(F.unix_micros(c))
    raise TypeError(f"not a timestamp type: {dtype}")


def col_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType
