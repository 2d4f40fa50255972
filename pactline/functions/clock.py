"""Timestamp arithmetic in whole microseconds."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A whole date, then maybe a time and an offset.
_ISO = r"^\d{4}-\d\d-\d\d(T\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d(:?\d\d)?)?)?$"
_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def micros(column: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970 without any use of the session time zone.

    TIMESTAMP_NTZ goes through an interval, because casting it to TIMESTAMP
    would move values around the clock changes of the session time zone.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(dtype, T.TimestampNTZType):
        elapsed = (column - F.expr(_EPOCH_NTZ)).cast("interval second")
        return (elapsed.cast("decimal(18,6)") * 1000000).cast("bigint")
    raise TypeError(f"a timestamp column is needed, not {dtype.simpleString()}")


def from_micros(column: Column, dtype: T.DataType) -> Column:
    """The inverse of :func:`micros`."""
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(column)
    seconds = (column.cast("decimal(20,0)") / 1000000).cast("decimal(18,6)")
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(secs=seconds)


def iso_timestamp(text: Column) -> Column:
    """An ISO date and time as a TIMESTAMP; without an offset it counts as UTC.

    NULL where the text is no such time: a time without a date, a year alone and
    names of time zones are none. The session's time zone must be UTC, as
    ``configure`` sets it.
    """
    joined = F.regexp_replace(F.trim(text), "^(\\d{4}-\\d\\d-\\d\\d) ", "$1T")
    return F.when(joined.rlike(_ISO), F.try_to_timestamp(joined))


def to_micros(length: timedelta) -> int:
    return length // timedelta(microseconds=1)
