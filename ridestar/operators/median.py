"""Exact percentiles by distributed selection: no task and no buffer holds all values.

The ``percentile`` aggregate merges one counter per distinct value, which for real numbers are as many as rows. Here a
quantile sketch of bounded size proposes a narrow range around the wanted rank, an exact count of the values below and in it
confirms the range, and the search goes on inside: each round leaves about one value in a thousand, whatever the
distribution, until few are left, which are counted one by one. A value that holds a third of all rows is a range of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of the sketch: its ranks are off by at most one in so many.
ACCURACY = 5000
#: Values that are counted one by one.
FEW = 10_000


def select_rank(values: DataFrame, rank: int, few: int = FEW, accuracy: int = ACCURACY) -> float:
    """The value of 0-based ``rank`` in the order of the column ``v`` of ``values`` (no nulls)."""
    within, n = values, values.count()
    if not 0 <= rank < n:
        raise ValueError(f"no rank {rank} among {n} values")
    slack = 2
    while n > few:
        share = slack / accuracy
        at = [max(0.0, rank / n - share), min(1.0, (rank + 1) / n + share)]
        low, high = within.agg(F.percentile_approx("v", at, accuracy)).first()[0]
        below, inside = within.agg(F.count_if(F.col("v") < low), F.count_if(F.col("v").between(low, high))).first()
        if not below <= rank < below + inside or (inside == n and low != high):
            slack *= 4   # the sketch was further off than it promises, or every value is in range: look wider or give up narrowing
            if slack > accuracy:
                break
            continue
        if low == high:
            return low
        within, rank, n, slack = within.where(F.col("v").between(low, high)), rank - below, inside, 2
    for value, count in within.groupBy("v").count().orderBy("v").toLocalIterator():
        rank -= count
        if rank < 0:
            return value
    raise AssertionError("the counts changed while the rank was sought")


def exact_percentile(df: DataFrame, value: Column, q: float, few: int = FEW, accuracy: int = ACCURACY) -> float | None:
    """The ``q`` percentile of ``value`` (nulls left out) with linear interpolation, as the ``percentile`` aggregate gives it.

    None for no values. Several passes read ``df``: give it as a written table.
    """
    values = df.select(value.cast("double").alias("v")).where(F.col("v").isNotNull())
    n = values.count()
    if n == 0:
        return None
    place = (n - 1) * q
    low, part = math.floor(place), place - math.floor(place)
    first = select_rank(values, low, few, accuracy)
    if part == 0:
        return first
    up_to, above = values.agg(F.count_if(F.col("v") <= first), F.min(F.when(F.col("v") > first, F.col("v")))).first()
    second = first if up_to > low + 1 else above
    return (1 - part) * first + part * second
