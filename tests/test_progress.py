"""Stream progress as rows: a processing-time stream, one row a batch, backlog read from them."""

import time

import pytest

from ridestar.sources.kafka import bronze_frame, read_event_files
from ridestar.streaming.progress import ProgressTable, is_behind, last_progress, offsets_behind, read_progress


@pytest.mark.parametrize("reached,latest,behind", [
    ('{"t":{"0":5,"1":7}}', '{"t":{"0":9,"1":7,"2":3}}', 7), ({"logOffset": 2}, '{"logOffset":2}', 0), (None, '{"t":{"0":4}}', 4),
    ('{"t":{"0":9}}', '{"t":{"0":5}}', 0), ("3", "10", 7), (None, None, None), ("x", "not json", None)])
def test_offsets_behind(reached, latest, behind):
    assert offsets_behind(reached, latest) == behind


def test_a_processing_time_stream_reports_each_batch(spark, tmp_dir):
    for i in range(3):
        (spark.range(10 * i, 10 * i + 10).selectExpr(
            "cast(null as binary) key", "cast('v' as binary) value", "'t' topic", "cast(id % 3 as int) partition", "id offset",
            "timestamp_seconds(id) timestamp", "0 timestampType").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in"))
    listener = ProgressTable(spark, f"{tmp_dir}/progress")
    spark.streams.addListener(listener)
    try:
        q = (bronze_frame(read_event_files(spark, f"{tmp_dir}/in", 1)).writeStream.format("parquet").queryName("trips")
             .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck").trigger(processingTime="100 milliseconds").start())
        q.processAllAvailable()
        deadline = time.time() + 60
        while time.time() < deadline and sum(1 for p in q.recentProgress if p.numInputRows) < 3:
            time.sleep(0.2)
        name = str(q.id)
        q.stop()
        time.sleep(2)
    finally:
        spark.streams.removeListener(listener)
    rows = read_progress(spark, f"{tmp_dir}/progress")
    got = rows.where("input_rows > 0").orderBy("batch").collect()
    assert [(r.query, r.name, r.batch, r.input_rows) for r in got] == [(name, "trips", i, 10) for i in range(3)]
    assert all(r.batch_ms > 0 and r["at"] is not None for r in got)
    assert [r.behind for r in last_progress(rows).collect()] == [None]   # a folder of files has no latest offset
    assert not is_behind(rows) and not is_behind(rows, "other")


def test_the_gate_reads_the_last_batch(spark):
    rows = spark.createDataFrame([("q", "r", 0, 9), ("q", "r", 1, 4), ("p", "r", 5, 0)], "query string, run string, batch long, behind long")
    rows = rows.selectExpr("*", "timestamp'2024-01-01' + make_interval(0,0,0,0,0,cast(batch as int)) as at")
    assert is_behind(rows) and is_behind(rows, "q", 4) and not is_behind(rows, "q", 5) and not is_behind(rows, "p")
