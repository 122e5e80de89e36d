"""Surrogate keys: hex md5 over business columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "_"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the parts joined by ``_``, NULL parts read as ''. Never NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.md5(F.concat(*parts))


def natural_key(c: str | Column) -> Column:
    """md5 of one column; a NULL value gives a NULL key."""
    return F.md5(_col(c).cast("string"))


def weather_key_dim_reference(temperature: str | Column = "temperature",
                              short_summary: str | Column = "weather_short_summary") -> Column:
    """Dimension-side weather key as the reference writes it: md5(temperature text || summary).

    ``concat`` is NULL when the summary is NULL, so the key is NULL then.
    """
    return F.md5(F.concat(F.coalesce(_col(temperature).cast("string"), F.lit("")), _col(short_summary)))


def weather_key_fact_reference(short: str | Column = "weather_short_summary",
                               long: str | Column = "weather_long_summary",
                               icon: str | Column = "weather_icon") -> Column:
    """Fact-side weather key as the reference writes it (and the shared key in aligned mode)."""
    return surrogate_key(short, long, icon)
