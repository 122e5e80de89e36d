"""Sources, sinks and the bronze stream: CSV cleaning, available-now stream, restart, stream = batch, upsert."""

import datetime as dt
import os

from helpers import ts

from pyspark.sql import functions as F

from ridestar.plans import gates, staging
from ridestar.sources import bronze as B
from ridestar.sources import csv as CSV
from ridestar.sources import kafka as K
from ridestar.sources import tables as TB
from ridestar.streaming import bronze_job as SJ


def test_clean_csv_cases(spark, tmp_dir):
    path = os.path.join(tmp_dir, "trips.csv")
    with open(path, "w") as f:
        f.write("id,hour,price,short_summary,source,temperature\n")
        f.write("a,9,12.5, Mostly Cloudy ,Back Bay,NA\n")
        f.write("b,9.0, 3.5 ,  ,,NaN\n")
        f.write("c,x,nan,plain,NA,inf\n")
        f.write("d,,1_000,t,s,1e2\n")
    raw = CSV.read_trips_csv(spark, path)
    assert all(t == "string" for _, t in raw.dtypes)
    rows = {r.id: r for r in CSV.clean_columns(raw).collect()}
    assert (rows["a"].hour, rows["a"].price, rows["a"].short_summary, rows["a"].temperature) == (9, 12.5, "Mostly Cloudy", None)
    assert (rows["b"].hour, rows["b"].price, rows["b"].short_summary, rows["b"].source) == (None, 3.5, "", None)
    assert (rows["c"].hour, rows["c"].price, rows["c"].source, rows["c"].temperature) == (None, None, None, None)
    assert (rows["d"].hour, rows["d"].price, rows["d"].temperature) == (None, None, 100.0)


def test_event_key_and_messages(spark):
    df = spark.createDataFrame([("Back Bay", 1.0), ("", 2.0), (None, 3.0)], "source string, price double")
    msgs = K.to_event_messages(df).select(F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v"))
    got = [(r.k, r.v) for r in msgs.collect()]
    assert [k for k, _ in got] == ["Back Bay", "unknown", "unknown"]
    assert got[2][1] == '{"source":null,"price":3.0}'


def _topic_files(spark, tmp_dir, n=60, files=6):
    rows = [(f"k{i % 3}".encode(), ('{"id":"t%d","price":%d.5}' % (i % 40, i)).encode(), "rides", i % 3, i // 3,
             ts(i), 0) for i in range(n)]
    df = spark.createDataFrame(rows, K.KAFKA_SOURCE_SCHEMA)
    path = os.path.join(tmp_dir, "topic")
    df.repartition(files).write.parquet(path)
    return path, df


def test_available_now_stream_restart_and_batch_equality(spark, tmp_dir):
    src, topic = _topic_files(spark, tmp_dir)
    paths = B.bronze_paths(os.path.join(tmp_dir, "lake"))
    SJ.run_file_bronze(spark, src, paths.data, paths.checkpoint, max_files_per_trigger=2)
    first = B.read_bronze(spark, paths.data)
    assert first.count() == 60
    assert set(first.columns) >= {"key", "value", "partition", "offset", "kafka_timestamp", "ingestion_time",
                                  "ingest_date"}
    # restart with the same checkpoint: nothing new, nothing repeated
    SJ.run_file_bronze(spark, src, paths.data, paths.checkpoint, max_files_per_trigger=2)
    assert B.read_bronze(spark, paths.data).count() == 60
    # stream = batch: staging from streamed bronze equals staging from the batch envelope decode
    streamed = staging.stg_events(B.read_bronze(spark, paths.data)).select("trip_id", "price", "kafka_offset")
    batch = staging.stg_events(K.with_ingestion_time(K.to_bronze(topic))).select("trip_id", "price", "kafka_offset")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    # gates over what was written
    assert gates.is_fresh(spark, paths.data, 15)
    assert gates.refresh_and_count(spark, paths.data).first().total_rows == 60
    assert gates.has_backlog(topic, 60) and not gates.has_backlog(topic, 61)


def test_quarantine_stream(spark, tmp_dir):
    rows = [(b"k", b'{"id":"a","price":1}', "t", 0, 0, ts(), 0), (b"k", b"{bad", "t", 0, 1, ts(), 0),
            (b"k", b'{"price":2}', "t", 0, 2, ts(), 0)]
    src = os.path.join(tmp_dir, "topic")
    spark.createDataFrame(rows, K.KAFKA_SOURCE_SCHEMA).write.parquet(src)
    good_p, bad_p = os.path.join(tmp_dir, "good"), os.path.join(tmp_dir, "bad")
    q = SJ.start_quarantine(K.read_event_files(spark, src), good_p, bad_p, os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    assert [r.trip_id for r in spark.read.parquet(good_p).collect()] == ["a"]
    assert sorted(r.reject_reason for r in spark.read.parquet(bad_p).collect()) == ["malformed_json", "missing_id"]


def test_retention_and_partitions(spark, tmp_dir):
    now = dt.datetime(2024, 1, 31)
    df = spark.createDataFrame([(now - dt.timedelta(days=d),) for d in (0, 6, 7, 8, 30)], "ts timestamp")
    assert B.apply_retention(df, "ts", 7, now).count() == 3


def test_upsert_append_replace_and_sync(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mart")
    a = spark.createDataFrame([(1, 10.0, "x")], "k int, v double, old string")
    TB.upsert(spark, a, path, "k")
    b = spark.createDataFrame([(2, 20.0, "x")], "k int, v double, old string")
    assert TB.upsert(spark, b, path, "k").count() == 2                       # append
    c = spark.createDataFrame([(1, 11.0, 5)], "k int, v double, new int")    # replace key 1, columns change
    out = TB.upsert(spark, c, path, "k")
    assert out.columns == ["k", "v", "new"]
    assert sorted(map(tuple, out.collect())) == [(1, 11.0, 5), (2, 20.0, None)]


def test_backlog_per_partition(spark):
    topic = spark.createDataFrame([(p, o) for p in range(3) for o in range(5, 5 + 10 * (p + 1))],
                                  "partition int, offset long")
    got = {r.partition: (r.low, r.high, r.messages) for r in gates.backlog(topic).collect()}
    assert got == {0: (5, 15, 10), 1: (5, 25, 20), 2: (5, 35, 30)}


def test_pipeline_end_to_end(spark, tmp_dir):
    import datetime as _dt

    from ridestar.plans.pipeline import run_pipeline

    rows = [(None, '{"id":"t%d","price":%d.5,"cab_type":"Uber","name":"X","source":"A","destination":"B",'
                   '"datetime":"2024-03-02 10:00:00","surge_multiplier":1.%d,"hour":10}' % (i % 7, i, i % 3),
             i % 3, i, ts(i), ts(i + 1)) for i in range(30)]
    b = spark.createDataFrame(rows, "key string, value string, partition int, offset bigint, "
                                    "kafka_timestamp timestamp, ingestion_time timestamp")
    src = os.path.join(tmp_dir, "bronze")
    b.write.parquet(src)
    r = run_pipeline(spark, spark.read.parquet(src), os.path.join(tmp_dir, "wh"),
                     measured_at=_dt.datetime(2024, 1, 1), bronze_path=src)
    assert r.tables["stg_rideshare_events"].count() == 7
    assert r.tables["fact_trips"].count() == 7
    assert r.tables["mart_surge_analysis"].count() == 1
    assert r.tables["mart_data_quality_metrics"].count() == 1
    assert r.check_results.count() == 63
    assert "error" not in r.report


def test_producer_stream_to_bronze_to_staging(spark, tmp_dir):
    """CSV files -> producer stream -> topic files -> bronze stream -> staging."""
    from ridestar.streaming.producer import start_producer_files

    csv_dir = os.path.join(tmp_dir, "csv")
    os.makedirs(csv_dir)
    cols = ["id", "source", "destination", "cab_type", "name", "price", "hour"]
    for f in range(3):
        with open(os.path.join(csv_dir, f"part{f}.csv"), "w") as fh:
            fh.write(",".join(cols) + "\n")
            for i in range(5):
                fh.write(f"x{f}{i},Back Bay,Fenway,Uber,UberX,{10 + i}.5,NA\n")
            fh.write(f"y{f},,Fenway,Lyft,Lyft,NaN,3\n")
    topic = os.path.join(tmp_dir, "topic")
    q = start_producer_files(spark, csv_dir, cols, topic, os.path.join(tmp_dir, "ck_prod"))
    q.awaitTermination()
    msgs = spark.read.parquet(topic)
    assert msgs.count() == 18
    assert {r.k for r in msgs.select(F.col("key").cast("string").alias("k")).distinct().collect()} == {"Back Bay", "unknown"}
    paths = B.bronze_paths(os.path.join(tmp_dir, "lake"))
    SJ.run_file_bronze(spark, topic, paths.data, paths.checkpoint)
    stg = staging.stg_events(B.read_bronze(spark, paths.data))
    rows = stg.collect()
    assert len(rows) == 18                                   # fresh uuid per event: no duplicates
    assert all(len(r.trip_id) == 36 and r.trip_hour is not None for r in rows)   # stamped from the clock
    assert [r.price for r in rows if r.cab_provider == "Lyft"] == [None, None, None]   # NaN token -> NULL


def test_ensure_utc_on_a_session_without_an_explicit_zone(spark):
    """Regression: reading the zone with a '' default raised in sessions that never set it."""
    from ridestar.session import ensure_utc

    spark.conf.unset("spark.sql.session.timeZone")
    try:
        ensure_utc(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_upsert_replaces_a_key_with_the_same_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mart2")
    TB.upsert(spark, spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double"), path, "k")
    out = TB.upsert(spark, spark.createDataFrame([(2, 20.0)], "k int, v double"), path, "k")
    assert sorted(map(tuple, out.collect())) == [(1, 1.0), (2, 20.0)]
