"""Whole-second clock arithmetic for TIMESTAMP and TIMESTAMP_NTZ columns.

Periods are measured in whole seconds: each time is cut to its second first
and the seconds are subtracted. A TIMESTAMP_NTZ is read as wall-clock time, so
the session time zone and its daylight saving never change a distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorctx.functions.columns import quoted

_NTZ_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def is_ntz(df: DataFrame, name: str) -> bool:
    """True for TIMESTAMP_NTZ, False for TIMESTAMP, TypeError for anything else."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.TimestampNTZType):
        return True
    if isinstance(data_type, T.TimestampType):
        return False
    raise TypeError(f"{name} is {data_type.simpleString()}, not a timestamp")


def check_same_clock(left: DataFrame, left_time: str, right: DataFrame, right_time: str) -> bool:
    """``is_ntz`` of both columns, which have to be of one type to be compared."""
    ntz = is_ntz(left, left_time)
    if ntz != is_ntz(right, right_time):
        raise TypeError(f"{left_time} and {right_time} have to be of one timestamp type")
    return ntz


def seconds_sql(time: str, ntz: bool) -> str:
    """Seconds since 1970 of a column, fraction cut off (toward zero, as ``unix_timestamp``)."""
    if ntz:
        return f"cast({quoted(time)} - {_NTZ_EPOCH} as bigint)"
    return f"unix_timestamp({quoted(time)})"


def chunk_sql(time: str, ntz: bool, chunk_seconds: int) -> str:
    """Number of the stretch of ``chunk_seconds`` that a time column falls in.

    The number is never NULL to Spark, so it puts no null check on it in front of
    joins only, which would make otherwise equal inputs differ and run twice.
    Rows without a time have to be left out before.
    """
    return f"coalesce(floor({seconds_sql(time, ntz)} / {int(chunk_seconds)}), 0)"


def whole_seconds(time: str, ntz: bool) -> Column:
    return F.expr(seconds_sql(time, ntz))


def chunk_of(time: str, ntz: bool, chunk_seconds: int) -> Column:
    return F.expr(chunk_sql(time, ntz, chunk_seconds))
