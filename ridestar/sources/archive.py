"""Bronze files behind snapshots: retention in place, and reads that open only the files they need.

The data files are those of the stream's sink (or any writer), partitioned by ingest date; they are never rewritten. Beside
them ``_index/part=P`` holds a row per file: its date, rows, and the least and greatest offset and event time of each
topic partition in it. A version (``sources.snapshots``) names the index parts and the first date that is kept.

Expiry is a version with a later first date: nothing is copied or deleted, readers of older versions go on with the files
they listed. ``vacuum`` deletes the files that no kept version can reach.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestar.sources.bronze import PARTITION_COLUMN, first_kept
from ridestar.sources.snapshots import Snapshots

INDEX = "_index"
INDEX_SCHEMA = ("path string, ingest_date date, partition int, rows long, first_offset long, last_offset long, "
                "first_time timestamp, last_time timestamp")


def _plain(path: Column) -> Column:
    """A local file's place without its scheme, which Spark writes in two ways; others as they are."""
    return F.regexp_replace(path, "^file:/+", "/")


class Archive:
    """The bronze files under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Snapshots(spark, f"{self.path}/{INDEX}")

    def _index(self, state: dict) -> DataFrame:
        if not state.get("index"):
            return self.spark.createDataFrame([], INDEX_SCHEMA)
        return self.spark.read.schema(INDEX_SCHEMA).parquet(*[self.versions.at(p) for p in state["index"]])

    def refresh(self) -> int:
        """Indexes the committed files that no version knows; gives their number. Only the indexed columns are read."""
        number, state = self.versions.current()
        every = self.spark.read.parquet(self.path)
        listed = self.spark.createDataFrame([(f,) for f in every.inputFiles()], "file string")
        known = self._index(state).select(F.col("path").alias("file")).distinct()
        new = [r.file for r in listed.select(_plain(F.col("file")).alias("file")).join(known, "file", "left_anti").collect()]
        if not new:
            return 0
        rows = self.spark.read.option("basePath", self.path).schema(every.schema).parquet(*new)
        part = self.versions.new_folder("part")
        (rows.groupBy(_plain(F.col("_metadata.file_path")).alias("path"), PARTITION_COLUMN, "partition")
         .agg(F.count(F.lit(1)).alias("rows"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
              F.min("kafka_timestamp").alias("first_time"), F.max("kafka_timestamp").alias("last_time"))
         .write.parquet(self.versions.at(part)))
        self.versions.commit(number + 1, {**state, "index": [*state.get("index", []), part]})
        return len(new)

    def expire(self, days: int, today: _dt.date | None = None) -> str:
        """A version with the last ``days`` ingest dates only; gives its first date. A later first date stays."""
        number, state = self.versions.current()
        first = max(first_kept(days, today).isoformat(), state.get("kept_from", ""))
        self.versions.commit(number + 1, {**state, "index": state.get("index", []), "kept_from": first})
        return first

    def files(self, version: int | None = None, partition: int | None = None, offsets: tuple[int, int] | None = None,
              times: tuple[_dt.datetime, _dt.datetime] | None = None) -> list[str]:
        """The live files that may hold such rows; ranges include both ends."""
        state = self.versions.read(version) if version else self.versions.current()[1]
        rows = self._index(state)
        if state.get("kept_from"):
            rows = rows.where(F.col("ingest_date") >= F.lit(state["kept_from"]).cast("date"))
        if partition is not None:
            rows = rows.where(F.col("partition") == partition)
        if offsets is not None:
            rows = rows.where((F.col("last_offset") >= offsets[0]) & (F.col("first_offset") <= offsets[1]))
        if times is not None:
            rows = rows.where((F.col("last_time") >= F.lit(times[0])) & (F.col("first_time") <= F.lit(times[1])))
        return sorted(r.path for r in rows.select("path").distinct().collect())

    def read(self, version: int | None = None, partition: int | None = None, offsets: tuple[int, int] | None = None,
             times: tuple[_dt.datetime, _dt.datetime] | None = None) -> DataFrame:
        """Rows of a version (the last one unless given) of that partition, offsets and event times."""
        if not self.versions.numbers():
            raise ValueError(f"{self.path} has no version: call refresh first")
        files = self.files(version, partition, offsets, times)
        schema = self._row_schema()
        if not files:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.option("basePath", self.path).schema(schema).parquet(*files)
        if partition is not None:
            rows = rows.where(F.col("partition") == partition)
        if offsets is not None:
            rows = rows.where(F.col("offset").between(*offsets))
        if times is not None:
            rows = rows.where(F.col("kafka_timestamp").between(F.lit(times[0]), F.lit(times[1])))
        return rows

    def _row_schema(self):
        """The columns of the files, from one that is still there."""
        known = self._index(self.versions.current()[1]).agg(F.max_by("path", "ingest_date")).first()[0]
        return self.spark.read.option("basePath", self.path).parquet(known).schema

    def vacuum(self, keep: int = 1) -> list[str]:
        """Deletes the files of dates before the first one of the last ``keep`` versions, and the versions before those."""
        numbers = self.versions.numbers()
        kept = [self.versions.read(n) for n in numbers[-keep:]]
        first = min((s.get("kept_from", "") for s in kept), default="")
        rows = self._index(kept[-1] if kept else {}).where(F.col("ingest_date") < F.lit(first or "0001-01-01").cast("date"))
        gone, conf = [], self.spark._jsc.hadoopConfiguration()
        for r in rows.select("path").distinct().orderBy("path").collect():
            place = self.spark._jvm.org.apache.hadoop.fs.Path(r.path)
            if place.getFileSystem(conf).delete(place, False):
                gone.append(r.path)
        self.versions.vacuum(lambda state: [], keep)
        return gone
