"""Packed exchanges: many small fixed-width records travel as a few binary values.

A task sorts its records by bin and emits one row (bin, data) per bin; a bin is a range
of hash values, so bins are even whatever the keys. ``repartitionById`` brings each bin to
one task, which reads all its records as one numpy array. The number of bins is the
session's number of shuffle partitions, as for any other shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "bin int, data binary"


def bin_count(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bin_of(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each 64-bit hash: equal ranges of the hash's upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int32)


def packed(records: np.ndarray, which: np.ndarray, bins: int) -> pa.RecordBatch:
    """One row per bin that has records."""
    order = np.argsort(which, kind="stable")
    records, which = records[order], which[order]
    ends = np.searchsorted(which, np.arange(bins + 1))
    used = np.flatnonzero(np.diff(ends))
    data = [records[ends[b]:ends[b + 1]].tobytes() for b in used]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(data, pa.binary())], names=["bin", "data"])


def dealt(df: DataFrame, bins: int) -> DataFrame:
    return df.repartitionById(bins, "bin")


def unpacked(batches: Iterator[pa.RecordBatch], kind: np.dtype, at: int = 1) -> np.ndarray:
    """All records of a task."""
    parts = [np.frombuffer(v.as_buffer(), dtype=kind) for b in batches for v in b.column(at) if v.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


def rows(names: list[str], columns: list[np.ndarray], step: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of plain columns."""
    n = len(columns[0])
    for i in range(0, n, step):
        yield pa.RecordBatch.from_arrays([pa.array(c[i:i + step]) for c in columns], names=names)
