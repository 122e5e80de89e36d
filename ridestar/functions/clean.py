"""CSV value cleaning, typed per column (the producer's rules as Spark expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridestar.functions.json import FLOAT_PATTERN, INT_PATTERN
from ridestar.spec import NA_TOKENS

# Python's int() accepts surrounding blanks and a sign; float() also accepts inf/nan,
# which cannot be written as JSON, so non-finite numbers become NULL here.
_FINITE = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?)\s*$"


_OUTER_SPACE = r"(?U)^\s+|\s+$"


def clean_csv_value(raw: Column, kind: str, na_tokens: Sequence[str] = NA_TOKENS) -> Column:
    """Clean one raw CSV string.

    NA tokens give NULL (tested before trimming, so blanks stay text). ``kind``:
    ``int`` (hour/day/month: integer text else NULL), ``double`` (number if it
    parses and is finite, else NULL) or ``string`` (text without outer white space of any kind).
    """
    is_na = raw.isNull() | raw.isin(*na_tokens)
    if kind == "int":
        typed = F.when(raw.rlike(INT_PATTERN), raw.try_cast("bigint"))
    elif kind == "double":
        typed = F.when(raw.rlike(_FINITE), raw.try_cast("double"))
    elif kind == "string":
        typed = F.regexp_replace(raw, _OUTER_SPACE, "")
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return F.when(is_na, F.lit(None)).otherwise(typed)


def event_key(c: str | Column) -> Column:
    """Message key: the value, or 'unknown' when NULL or empty."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(col.cast("string"), F.lit("")), F.lit("unknown"))


__all__ = ["clean_csv_value", "event_key", "FLOAT_PATTERN"]
