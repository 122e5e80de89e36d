"""Progress of streams as a table: a row per micro-batch, from which backlog is read without asking the source.

A listener on the session writes one small JSON file per micro-batch, named by run and batch, so a report that comes twice is
one row. Offsets behind are the difference of a source's latest and reached offsets, summed over its partitions.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = ("query string, run string, name string, batch long, at timestamp, input_rows long, input_per_second double, "
          "processed_per_second double, batch_ms long, reached string, latest string, behind long")


def _numbers(offset) -> dict[str, int]:
    """The numbers of an offset in a source's JSON by their path (topic and partition, say)."""
    if isinstance(offset, bool) or offset is None:
        return {}
    if isinstance(offset, (int, float)):
        return {"": int(offset)}
    if isinstance(offset, str):
        try:
            return _numbers(json.loads(offset))
        except ValueError:
            return {}
    return {f"{k}/{p}": n for k, v in offset.items() for p, n in _numbers(v).items()} if isinstance(offset, dict) else {}


def offsets_behind(reached: str | None, latest: str | None) -> int | None:
    """How far ``reached`` is behind ``latest``; None if a source does not say. A partition not reached yet counts from 0."""
    done, end = _numbers(reached), _numbers(latest)
    return sum(max(0, n - done.get(p, 0)) for p, n in end.items()) if end else None


class ProgressTable(StreamingQueryListener):
    """Writes the progress of all streams of a session to the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        behind = [offsets_behind(s.endOffset, s.latestOffset) for s in p.sources]
        row = {"query": str(p.id), "run": str(p.runId), "name": p.name, "batch": p.batchId, "at": p.timestamp,
               "input_rows": p.numInputRows, "input_per_second": p.inputRowsPerSecond,
               "processed_per_second": p.processedRowsPerSecond, "batch_ms": p.durationMs.get("triggerExecution"),
               "reached": "; ".join(str(s.endOffset) for s in p.sources), "latest": "; ".join(str(s.latestOffset) for s in p.sources),
               "behind": None if None in behind else sum(behind)}
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p.runId}-{p.batchId:012d}.json")
        out = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(place, True)
        try:
            out.write(bytearray(json.dumps(row).encode()))
        finally:
            out.close()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """A row per micro-batch; an idle report of a batch already there is the same row."""
    return spark.read.schema(SCHEMA).json(path)


def last_progress(progress: DataFrame) -> DataFrame:
    """The last row of each query."""
    last = Window.partitionBy("query").orderBy(F.col("batch").desc(), F.col("at").desc(), "run")
    return progress.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def is_behind(progress: DataFrame, query: str | None = None, at_least: int = 1) -> bool:
    """Gate: whether a query's last batch left ``at_least`` offsets; a query that has reported nothing is not behind."""
    rows = last_progress(progress)
    rows = rows if query is None else rows.where(F.col("query") == query)
    return not rows.where(F.col("behind") >= at_least).isEmpty()
