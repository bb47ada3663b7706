"""Epoch conversions that do not depend on the session time zone.

Change records carry event times as epoch milliseconds; silver exposes them as
wall-clock timestamps without zone (TIMESTAMP_NTZ, read as UTC). Conversions of
NTZ values are plain wall-clock arithmetic against the NTZ epoch, so they give
the same numbers whatever ``spark.sql.session.timeZone`` is, and they stay
monotonic across daylight-saving changes; zoned TIMESTAMP values convert
through their instant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_to_ts(c: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ (UTC wall clock), keeping the milliseconds."""
    return F.timestamp_add("MILLISECOND", _col(c), F.expr(EPOCH_NTZ))


def ts_to_ms(c: Column | str, ntz: bool = True) -> Column:
    """Timestamp -> epoch milliseconds, truncated. ``ntz``: the input is a
    TIMESTAMP_NTZ wall clock read as UTC; otherwise a zoned TIMESTAMP."""
    if ntz:
        return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), _col(c))
    return F.unix_millis(_col(c))


def ts_to_us(c: Column | str, ntz: bool = True) -> Column:
    """Timestamp -> epoch microseconds (see :func:`ts_to_ms`)."""
    if ntz:
        return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), _col(c))
    return F.unix_micros(_col(c))


def _type(df: DataFrame, col: str):
    """Type of a column; plain names come from the DataFrame's cached schema
    (no new analysis), dotted ones are resolved by Spark."""
    if col in df.columns:
        return df.schema[col].dataType
    return df.select(F.col(col).alias("x")).schema["x"].dataType


def is_ntz(df: DataFrame, col: str) -> bool:
    """Whether a (possibly nested, dotted) column of ``df`` is TIMESTAMP_NTZ."""
    return isinstance(_type(df, col), TimestampNTZType)


def epoch_us(df: DataFrame, col: str) -> Column:
    """Epoch microseconds of a timestamp column of ``df``, by its type."""
    return ts_to_us(col, is_ntz(df, col))


_PY_FORMAT = "%Y-%m-%d %H:%M:%S.%f"
_SPARK_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def ts_lit(value, dtype: str = "timestamp_ntz") -> Column:
    """A timestamp literal read as a wall clock: NTZ as is, a zoned TIMESTAMP
    in the session zone. Going through text keeps the Python process's own
    zone out of it (``F.lit(datetime)`` would convert with it)."""
    return F.lit(value.strftime(_PY_FORMAT)).cast(dtype)


def type_name(df: DataFrame, col: str) -> str:
    return _type(df, col).simpleString()


def max_ts(df: DataFrame, col: str):
    """``MAX(col)`` as a naive datetime holding the wall clock (the session
    zone's, for a zoned column), or None. One-row aggregate; formatting happens
    in Spark, so the value round-trips exactly through :func:`ts_lit`."""
    import datetime as _dt
    s = df.agg(F.date_format(F.max(col), _SPARK_FORMAT).alias("m")).first()["m"]
    return _dt.datetime.strptime(s, _PY_FORMAT) if s else None
