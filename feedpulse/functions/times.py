"""Time expressions: epoch seconds, floors, display text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTER = "15 minutes"
UNITS = (QUARTER, "hour", "day", "week")


def epoch_to_ts(col: Column) -> Column:
    """Epoch seconds, whole or fractional, as a timestamp.

    Null, 0 and values out of range give null. Rounding to the microsecond undoes
    the error of the double, which truncation would let slip by one.
    """
    return seconds_to_ts(F.nullif(col.cast("double"), F.lit(0.0)))


def seconds_to_ts(col: Column) -> Column:
    """As :func:`epoch_to_ts`, but 0 is the epoch itself."""
    return F.timestamp_micros(F.rint(col * F.lit(1e6)).try_cast("bigint"))


def ts_to_epoch(col: Column) -> Column:
    """Timestamp as epoch seconds with its fraction."""
    return F.unix_micros(col.cast("timestamp")) / F.lit(1e6)


def ts_literal(moment: datetime | Column) -> Column:
    """A moment as a timestamp; one without a zone is meant in session time."""
    if isinstance(moment, Column):
        return moment.cast("timestamp")
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def floor_ts(col: Column, unit: str) -> Column:
    """Start of the quarter hour, hour, day or (Monday) week."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    ts = col.cast("timestamp")
    if unit == QUARTER:
        seconds = F.unix_seconds(ts)
        return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(900)))
    return F.date_trunc(unit, ts)


def time_text(col: Column) -> Column:
    return F.coalesce(F.date_format(col, "yyyy-MM-dd HH:mm:ss"), F.lit("Unknown"))
