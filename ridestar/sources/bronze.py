"""Bronze archive: append-only Parquet written by a checkpointed stream.

Files are partitioned by ``ingest_date`` (the UTC date of ``ingestion_time``), so
retention drops whole partitions and date-bounded reads prune directories.
Readers go through ``spark.read.parquet(dir)``, which honours the sink's commit
log (``_spark_metadata``): files of a batch that never committed are not read.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridestar.functions.time import instant_to_ntz, utc_instant

PARTITION_COLUMN = "ingest_date"
DEFAULT_TRIGGER = "10 seconds"


@dataclass(frozen=True)
class BronzePaths:
    data: str
    checkpoint: str


def bronze_paths(base: str, name: str = "rideshare_events") -> BronzePaths:
    """Data and checkpoint locations under one base (any Hadoop path: ``gs://``, ``s3a://``, ``file:``)."""
    base = base.rstrip("/")
    return BronzePaths(f"{base}/bronze/{name}", f"{base}/bronze/checkpoint_{name}")


def with_ingest_date(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, F.to_date(instant_to_ntz("ingestion_time")))


def write_bronze(df: DataFrame, path: str, checkpoint: str, trigger: str | None = DEFAULT_TRIGGER,
                 available_now: bool = False, query_name: str | None = None) -> StreamingQuery:
    """Start the append-only Parquet sink (exactly-once through checkpoint + commit log).

    ``trigger`` is a processing-time interval; ``available_now`` processes what is
    there in as many micro-batches as the source limits allow, then stops.
    """
    writer = (with_ingest_date(df).writeStream.format("parquet")
              .option("path", path)
              .option("checkpointLocation", checkpoint)
              .partitionBy(PARTITION_COLUMN)
              .outputMode("append"))
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def read_bronze(spark: SparkSession, path: str, since: _dt.date | None = None) -> DataFrame:
    """Committed bronze rows; ``since`` prunes whole ``ingest_date`` partitions."""
    df = spark.read.parquet(path)
    if since is not None:
        df = df.where(F.col(PARTITION_COLUMN) >= F.lit(since))
    return df


def compact_bronze(spark: SparkSession, path: str, out: str, target_rows_per_file: int = 5_000_000) -> DataFrame:
    """Rewrite committed bronze into fewer, larger files per ``ingest_date`` (to a new path).

    Rows are spread over files by (date, partition, offset ranges) via a range
    repartition, so no single task holds one whole day.
    """
    df = read_bronze(spark, path)
    (df.repartitionByRange(PARTITION_COLUMN, "partition", "offset")
     .write.mode("overwrite").option("maxRecordsPerFile", target_rows_per_file)
     .partitionBy(PARTITION_COLUMN).parquet(out))
    return spark.read.parquet(out)


def apply_retention(df: DataFrame, ts_col: str, days: int, now: _dt.datetime | None = None) -> DataFrame:
    """Rows whose ``ts_col`` is within ``days`` of ``now`` (default: the current time)."""
    ref = F.current_timestamp() if now is None else utc_instant(now)
    return df.where(F.col(ts_col) >= ref - F.make_dt_interval(days=F.lit(days)))


def first_kept(days: int, today: _dt.date | None = None) -> _dt.date:
    """The first of the last ``days`` dates, today's included."""
    return (today or _dt.datetime.now(_dt.timezone.utc).date()) - _dt.timedelta(days=days - 1)


def retain_partitions(spark: SparkSession, path: str, out: str, days: int, today: _dt.date | None = None) -> DataFrame:
    """The last ``days`` ingest dates of bronze, written to ``out`` (expired partitions are not even listed for reading)."""
    kept = read_bronze(spark, path, since=first_kept(days, today))
    kept.write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(out)
    return spark.read.parquet(out)
