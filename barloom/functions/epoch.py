"""Epoch arithmetic. Integer only and independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: epoch numbers above this are microseconds, the others milliseconds.
MICROSECOND_THRESHOLD = 10**14

# Years 0001 to 9999. Time stamps outside are damage, and come out as null instead of
# failing the job on an overflow.
_MIN_MS = -62_135_596_800_000
_MAX_MS = 253_402_300_799_999


def int_div(a: Column, b: int | Column) -> Column:
    """Integer division that truncates toward zero."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def floor_div(a: Column, b: int) -> Column:
    """Integer division that rounds down, also below zero."""
    return int_div(a - F.pmod(a, F.lit(b)), b)


def normalize_epoch_ms(c: Column) -> Column:
    """Milliseconds from a column that mixes millisecond and microsecond epochs."""
    return F.when(c > MICROSECOND_THRESHOLD, int_div(c, 1000)).otherwise(c)


def _seconds(ms: Column) -> Column:
    return F.when(ms.between(_MIN_MS, _MAX_MS), int_div(ms, 1000))


def epoch_ms_to_ts(ms: Column) -> Column:
    """Timestamp in whole seconds."""
    return F.timestamp_seconds(_seconds(ms))


def bar_date(ms: Column) -> Column:
    """Calendar date (UTC)."""
    days = floor_div(_seconds(ms), 86_400)
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def year_month(ms: Column) -> Column:
    """Month as ``yyyy-MM`` (UTC)."""
    return F.substring(bar_date(ms).cast("string"), 1, 7)
