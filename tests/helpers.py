"""Fixture builders: hand-written rides and bronze rows."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from ridestar.spec import PAYLOAD_FIELDS, STAGING_COLUMNS

BRONZE_SCHEMA = "key string, value string, partition int, offset bigint, kafka_timestamp timestamp, ingestion_time timestamp"

T0 = dt.datetime(2024, 3, 2, 12, 0, 0)  # a Saturday


def bronze(spark, rows):
    """rows: (value, partition, offset, kafka_timestamp[, ingestion_time])."""
    full = [(None, r[0], r[1], r[2], r[3], r[4] if len(r) > 4 else r[3]) for r in rows]
    return spark.createDataFrame(full, BRONZE_SCHEMA)


def payload(**kw) -> str:
    return json.dumps(kw)


def staging_rows(spark, rows: list[dict]):
    """A staging DataFrame from dicts (missing columns NULL)."""
    types = {f.column: f.dtype for f in PAYLOAD_FIELDS}
    types.update({"kafka_partition": "int", "kafka_offset": "bigint", "kafka_timestamp": "timestamp",
                  "ingestion_time": "timestamp"})
    schema = ", ".join(f"{c} {types[c]}" for c in STAGING_COLUMNS)
    data = [tuple(r.get(c) for c in STAGING_COLUMNS) for r in rows]
    return spark.createDataFrame(data, schema)


def collect_sorted(df, *cols):
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=lambda t: tuple(str(x) for x in t))


def ts(minutes: float = 0, seconds: float = 0) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minutes, seconds=seconds)


__all__ = ["bronze", "payload", "staging_rows", "collect_sorted", "ts", "T0", "F"]
