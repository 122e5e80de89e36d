"""Put one-row aggregates side by side without a cross join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_single_rows(*parts: DataFrame) -> DataFrame:
    """One row with the columns of every part; each part must be a global aggregate.

    The parts are unioned by name (missing columns NULL) and folded with
    ``first(ignorenulls)``: a handful of rows into one, no cartesian product.
    Column names must not repeat across parts.
    """
    names: list[str] = []
    for p in parts:
        for c in p.columns:
            if c in names:
                raise ValueError(f"column {c!r} appears in more than one part")
            names.append(c)
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])
