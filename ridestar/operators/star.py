"""Star join + group-by with the fact pre-aggregated on its foreign keys.

``count``, ``count_if``, ``sum``, ``max``, ``min`` and ``avg`` over a fact joined
to dimensions equal the same aggregates computed per foreign-key combination
first and then combined per dimension attribute (an inner join only copies or
drops whole groups). So the fact is reduced with a partial (map-side) aggregate
before any shuffle, and only the reduced rows meet the dimensions. Joins are left to
the planner: a written dimension whose size is under Spark's byte threshold is broadcast, at
planning time by its file sizes or at run time by AQE.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


KINDS = ("count", "count_if", "sum", "max", "min", "avg")


@dataclass(frozen=True)
class Dim:
    """A dimension: its table, the fact's foreign key, its key, and the columns taken (out name -> dim column)."""

    table: DataFrame
    fact_key: str
    dim_key: str
    columns: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str
    expr: Column

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"measure kind must be one of {KINDS}")


def _partials(m: Measure) -> list[Column]:
    n = m.name
    if m.kind == "count":
        return [F.count(m.expr).alias(f"{n}__n")]
    if m.kind == "count_if":
        return [F.count_if(m.expr).alias(f"{n}__n")]
    if m.kind == "sum":
        return [F.sum(m.expr).alias(f"{n}__s")]
    if m.kind == "max":
        return [F.max(m.expr).alias(f"{n}__m")]
    if m.kind == "min":
        return [F.min(m.expr).alias(f"{n}__m")]
    return [F.sum(m.expr).alias(f"{n}__s"), F.count(m.expr).alias(f"{n}__n")]


def _final(m: Measure) -> Column:
    n = m.name
    if m.kind in ("count", "count_if"):
        return F.coalesce(F.sum(f"{n}__n"), F.lit(0)).cast("bigint").alias(n)
    if m.kind == "sum":
        return F.sum(f"{n}__s").alias(n)
    if m.kind == "max":
        return F.max(f"{n}__m").alias(n)
    if m.kind == "min":
        return F.min(f"{n}__m").alias(n)
    return F.try_divide(F.sum(f"{n}__s"), F.sum(f"{n}__n").cast("double")).alias(n)


def star_aggregate(
    fact: DataFrame,
    dims: Sequence[Dim],
    group_by: Sequence[str],
    measures: Sequence[Measure],
) -> DataFrame:
    """Inner-join ``fact`` to ``dims`` and aggregate ``measures`` by dimension columns ``group_by``."""
    fks = list(dict.fromkeys(d.fact_key for d in dims))
    partial = fact.groupBy(*fks).agg(*[p for m in measures for p in _partials(m)])
    joined = partial
    for i, d in enumerate(dims):
        key = f"__dk{i}"
        side = d.table.select(F.col(d.dim_key).alias(key), *[F.col(src).alias(out) for out, src in d.columns.items()])
        joined = joined.join(side, joined[d.fact_key] == side[key]).drop(key)
    return joined.groupBy(*group_by).agg(*[_final(m) for m in measures])
