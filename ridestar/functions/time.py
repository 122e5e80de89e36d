"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# A string literal cast to timestamp_ntz is zone-free (a Python datetime literal is an instant).
_EPOCH_NTZ = "1970-01-01 00:00:00"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_instant(c: str | Column) -> Column:
    """Read a zone-less timestamp as UTC wall clock and return the instant."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), _c(c))
    return F.timestamp_micros(micros)


def instant_to_ntz(c: str | Column) -> Column:
    """The UTC wall clock of an instant, as a zone-less timestamp."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(c)), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def epoch_seconds(c: str | Column) -> Column:
    """Seconds since the epoch (double) of an instant."""
    return F.unix_micros(_c(c)) / F.lit(1_000_000.0)


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole minutes from start to end, truncated toward zero (NULL if either is NULL)."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def utc_instant(value: _dt.datetime | str) -> Column:
    """A literal instant from a zone-less wall clock read as UTC (independent of session and Python zones).

    Aware datetimes are converted to UTC first.
    """
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return ntz_to_instant(F.lit(value).cast("timestamp_ntz"))


def wall_clock_text(c: str | Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of a zone-less timestamp, without going through the session zone.

    (``date_format`` on a timestamp_ntz converts through the session zone, which
    shifts wall times inside a DST gap.)
    """
    return F.substring(_c(c).cast("string"), 1, 19)


# --- fixed values: day names, in dayofweek() order (1 = Sunday) ---
DAY_NAMES_SUNDAY_FIRST = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def day_name(c: str | Column) -> Column:
    """English day name of a zone-less timestamp (zone-free, unlike date_format 'EEEE')."""
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES_SUNDAY_FIRST]), F.dayofweek(_c(c)))
