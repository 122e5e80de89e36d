"""Message strictness, producer offsets, CSV by name, retention, safe replacement: the cases that once went wrong."""

import datetime as dt
import os

import pytest
from helpers import bronze, ts

from pyspark.sql import functions as F

from ridestar.plans import gates, staging
from ridestar.session import work_dir
from ridestar.sources import bronze as B
from ridestar.sources import csv as CSV
from ridestar.sources import kafka as K
from ridestar.sources import tables as TB
from ridestar.streaming import bronze_job as SJ
from ridestar.streaming.producer import start_producer_files

CASES = [
    ('{"id":"a","price":1}{"id":"b"}', "malformed_json", None),
    ('{"id":"a","price":1} junk', "malformed_json", None),
    ('{"id":"a","price":1} junk }', "malformed_json", None),
    ('{"id":"a","price":1} ,', "malformed_json", None),
    ('{"id":"a"}],[', "malformed_json", None),
    ('{"id":"a"}} x {', "malformed_json", None),
    ('{"id":"a"},{"id":"b"}', "malformed_json", None),
    ('{"id":"a"}]', "malformed_json", None),
    ('{"id":"k","price":1,"price":2}', None, 2.0),
    ('{"id":"k","price":1,"price":2,"timezone":"{"}', None, 2.0),
    ('{"id":"k","price":1,"price":2,"timezone":"}"}', None, 2.0),
    (' {"id":"k","price":3} \n', None, 3.0),
    ('[{"id":"k"}]', "missing_id", None),
    ("null", "missing_id", None),
]


def test_text_around_a_message_is_never_ignored(spark):
    b = bronze(spark, [(v, 0, i, ts()) for i, (v, *_) in enumerate(CASES)])
    got = {r.kafka_offset: (r.reject_reason, r.price) for r in staging.parse_events(b, with_reason=True).collect()}
    for i, (value, reason, price) in enumerate(CASES):
        assert got[i][0] == reason, value
        if reason is None:
            assert got[i][1] == price, value


def _write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")


def test_csv_columns_go_by_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in", "a.csv")
    _write_csv(path, "b,a,c", ['B1,A1,"say ""hi"""', 'B2,A2,"two\nlines"'])
    got = CSV.read_trips_csv(spark, path, ["a", "b", "c", "d"], multi_line=True).collect()
    assert [tuple(r) for r in got] == [("A1", "B1", 'say "hi"', None), ("A2", "B2", "two\nlines", None)]
    stream = CSV.read_trips_csv_stream(spark, os.path.dirname(path), ["a", "b", "c"], multi_line=True)
    out = os.path.join(tmp_dir, "out")
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "_ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("A1", "B1", 'say "hi"'), ("A2", "B2", "two\nlines")]
    _write_csv(os.path.join(tmp_dir, "in", "z.csv"), "a,b,c", ["A3,B3,x"])
    with pytest.raises(Exception):
        CSV.read_trips_csv(spark, os.path.dirname(path), ["a", "b", "c"]).collect()


def test_cleaning_strips_all_white_space_and_takes_other_tokens(spark):
    df = spark.createDataFrame([("\t x \n", "-"), ("NA", "1.5"), ("none", "none")], "source string, price string")
    assert [tuple(r) for r in CSV.clean_columns(df).collect()] == [("x", None), (None, 1.5), ("none", None)]
    assert [tuple(r) for r in CSV.clean_columns(df, na_tokens=["none"]).collect()] == [("x", None), ("NA", 1.5), (None, None)]


def test_producer_offsets_are_dense_and_a_fresh_checkpoint_adds(spark, tmp_dir):
    csv_dir, topic = os.path.join(tmp_dir, "csv"), os.path.join(tmp_dir, "topic")
    cols = ["source", "price"]

    def offsets():
        rows = spark.read.parquet(topic).select("partition", "offset").collect()
        by = {}
        for r in rows:
            by.setdefault(r.partition, []).append(r.offset)
        assert all(sorted(v) == list(range(len(v))) for v in by.values())
        return len(rows)

    def run(checkpoint):
        start_producer_files(spark, csv_dir, cols, topic, os.path.join(tmp_dir, checkpoint)).awaitTermination()

    _write_csv(os.path.join(csv_dir, "a.csv"), "source,price", [f"s{i % 7},{i}" for i in range(40)])
    run("ck1")
    assert offsets() == 40
    _write_csv(os.path.join(csv_dir, "b.csv"), "source,price", [f"s{i % 5},{i}" for i in range(25)])
    run("ck1")   # a second batch
    assert offsets() == 65
    run("ck2")   # a fresh checkpoint sends everything again, behind what is there
    assert offsets() == 130
    held = spark.read.parquet(topic)
    assert gates.has_backlog(held, 130) and not gates.has_backlog(held, 131)
    assert gates.backlog(held).agg(F.sum("messages")).first()[0] == 130


def test_quarantine_keeps_the_output_of_other_checkpoints(spark, tmp_dir):
    rows = [(b"k", b'{"id":"a","price":1}', "t", 0, 0, ts(), 0), (b"k", b"{bad", "t", 0, 1, ts(), 0)]
    src = os.path.join(tmp_dir, "topic")
    spark.createDataFrame(rows, K.KAFKA_SOURCE_SCHEMA).write.parquet(src)
    good, bad = os.path.join(tmp_dir, "good"), os.path.join(tmp_dir, "bad")
    for ck in ("ck1", "ck1", "ck2"):
        SJ.start_quarantine(K.read_event_files(spark, src), good, bad, os.path.join(tmp_dir, ck)).awaitTermination()
    assert (spark.read.parquet(good).count(), spark.read.parquet(bad).count()) == (2, 2)


def test_gate_is_closed_when_the_topic_is_missing(spark, tmp_dir):
    assert gates.has_backlog(lambda: spark.read.parquet(os.path.join(tmp_dir, "missing")), 1) is False


def test_freshness_of_rows_and_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(10).write.parquet(path)
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    assert (gates.fresh_rows(spark, path).count(), gates.fresh_rows(spark, path, now=later).count()) == (10, 0)
    assert gates.fresh_files(spark, path, now=later).count() == 0


def test_refresh_leaves_other_cached_tables(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(3).write.parquet(path)
    spark.range(5).createOrReplaceTempView("kept_in_cache")
    spark.catalog.cacheTable("kept_in_cache")
    assert gates.refresh_and_count(spark, path).first().total_rows == 3
    assert spark.catalog.isCached("kept_in_cache")
    spark.catalog.uncacheTable("kept_in_cache")


def test_retention_keeps_as_many_dates_as_days(spark, tmp_dir):
    path, today = os.path.join(tmp_dir, "a"), dt.date(2024, 1, 31)
    rows = [(i, today - dt.timedelta(days=i)) for i in range(12)]
    spark.createDataFrame(rows, "n int, ingest_date date").write.partitionBy("ingest_date").parquet(path)
    kept = B.retain_partitions(spark, path, os.path.join(tmp_dir, "b"), 7, today)
    assert sorted(r.n for r in kept.collect()) == list(range(7))


def test_upsert_null_and_repeated_keys(spark, tmp_dir):
    path, schema = os.path.join(tmp_dir, "m"), "k int, v double"
    for v in (1.0, 2.0):
        out = TB.upsert(spark, spark.createDataFrame([(None, v), (1, v)], schema), path, "k")
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 2.0), (None, 2.0)]
    with pytest.raises(ValueError):
        TB.upsert(spark, spark.createDataFrame([(1, 1.0), (1, 2.0)], schema), path, "k")


def test_a_crash_between_the_renames_loses_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m")
    TB.upsert(spark, spark.createDataFrame([(1, 1.0)], "k int, v double"), path, "k")
    os.rename(path, path + "__previous")
    out = TB.upsert(spark, spark.createDataFrame([(2, 2.0)], "k int, v double"), path, "k")
    assert sorted(map(tuple, out.collect())) == [(1, 1.0), (2, 2.0)]


def test_the_quality_mart_is_written_when_the_run_fails(spark, tmp_dir):
    from ridestar.plans import checks as C
    from ridestar.plans.pipeline import run_pipeline

    rows = [(None, '{"id":"t%d","price":-5,"cab_type":"Uber","name":"X","source":"A","destination":"B",'
                   '"datetime":"2024-03-02 10:00:00","surge_multiplier":0.5,"distance":1,"hour":10}' % i, 0, i, ts(i), ts(i + 1))
            for i in range(5)]
    b = spark.createDataFrame(rows, "key string, value string, partition int, offset bigint, "
                                    "kafka_timestamp timestamp, ingestion_time timestamp")
    wh = os.path.join(tmp_dir, "wh")
    strict = [C.Check("fact_trips", "price", "expression_is_true", "error", expression="> 0")]
    with pytest.raises(C.DataQualityError):
        run_pipeline(spark, b, wh, raise_on_error=True, checks=C.DECLARED_CHECKS + tuple(strict))
    assert spark.read.parquet(f"{wh}/mart_data_quality_metrics").count() == 1


def test_views_and_model_references(spark):
    models = TB.Models()
    models.define("one", lambda r: spark.range(3))
    models.define("two", lambda r: r.ref("one").where("id > 0"))
    TB.register_view(models["two"], "two_view")
    assert spark.table("two_view").count() == 2 and models.names() == ["one", "two"]


def test_full_refresh_replaces_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    TB.write_table(spark.range(5), path)
    assert TB.write_table(spark.range(2), path).count() == 2


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="shared"):
        work_dir(Session())
