"""Readiness and freshness gates as checks over data (no polling loop)."""

from __future__ import annotations

import datetime as _dt

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestar.functions.time import utc_instant
from ridestar.spec import FRESHNESS_MINUTES, MIN_BACKLOG_MESSAGES


def backlog(topic: DataFrame) -> DataFrame:
    """Messages retained per partition: low and high (exclusive) offsets and their difference.

    Partially aggregated per task (min/max), so the shuffle is one row per
    partition per task.
    """
    return topic.groupBy("partition").agg(
        F.min("offset").alias("low"),
        (F.max("offset") + 1).alias("high"),
        (F.max("offset") - F.min("offset") + 1).alias("messages"),
    )


def has_backlog(topic: DataFrame | Callable[[], DataFrame], min_messages: int = MIN_BACKLOG_MESSAGES) -> bool:
    """True when the topic holds at least ``min_messages``; False when it cannot be read.

    Reading stops after ``min_messages`` offsets (values are not read), so the gate costs the same
    however much is retained. ``topic`` may be a function that opens it, so that a missing topic or a failing
    broker is a closed gate, not an error.
    """
    try:
        rows = topic() if callable(topic) else topic
        return len(rows.select("offset").take(min_messages)) >= min_messages
    except (PySparkException, Py4JError):
        return False


def fresh_files(spark: SparkSession, path: str, minutes: int = FRESHNESS_MINUTES,
                now: _dt.datetime | None = None) -> DataFrame:
    """Parquet files under ``path`` modified within the last ``minutes``.

    Uses the file listing only (``modifiedAfter`` filters at listing time; file
    contents are not read).
    """
    now = now or _dt.datetime.now(_dt.timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=_dt.timezone.utc)
    # The boundary is a UTC wall clock with an explicit timeZone option, so the
    # listing filter does not depend on the session time zone.
    boundary = (now - _dt.timedelta(minutes=minutes)).astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return (spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true")
            .option("timeZone", "UTC")
            .option("modifiedAfter", boundary.strftime("%Y-%m-%dT%H:%M:%S"))
            .load(path)
            .select("path", "modificationTime", "length"))


def is_fresh(spark: SparkSession, path: str, minutes: int = FRESHNESS_MINUTES) -> bool:
    return fresh_files(spark, path, minutes).limit(1).count() > 0


def fresh_rows(spark: SparkSession, path: str, minutes: int = FRESHNESS_MINUTES,
               now: _dt.datetime | None = None) -> DataFrame:
    """Rows of the table at ``path`` that lie in files modified within the last ``minutes``."""
    boundary = utc_instant((now or _dt.datetime.now(_dt.timezone.utc)) - _dt.timedelta(minutes=minutes))
    return spark.read.parquet(path).where(F.col("_metadata.file_modification_time") >= boundary)


def refresh_and_count(spark: SparkSession, path: str) -> DataFrame:
    """One row, ``total_rows``: the table's row count, its files listed afresh (other cached tables stay)."""
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("total_rows"))
