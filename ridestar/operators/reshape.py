"""Union of projections in one scan, and null counts as rows (unpivot)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_projections(df: DataFrame, branches: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """UNION ALL of several projections of one table, in a single scan.

    Each branch is a list of expressions giving ``names``; rows are emitted with
    ``inline(array(struct...))`` instead of scanning the input once per branch.
    """
    structs = [F.struct(*[e.alias(n) for e, n in zip(b, names)]) for b in branches]
    return df.select(F.inline(F.array(*structs)))


def null_counts(df: DataFrame, columns: Sequence[str], total_col: str = "total_rows") -> DataFrame:
    """One row per column: column_name, null_count, and the table's row count.

    One aggregate pass computes every count; ``stack`` turns the single row into
    one row per column (no per-column scans, no cross join with the total).
    """
    aggs = [F.count(F.lit(1)).alias(total_col)] + [
        F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)
    ]
    row = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', n{i}" for i, c in enumerate(columns))
    return row.select(
        F.expr(f"stack({len(columns)}, {pairs}) as (column_name, null_count)"), F.col(total_col)
    )


def duplicates(df: DataFrame, keys: Sequence[str], count_col: str = "duplicate_count") -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)
