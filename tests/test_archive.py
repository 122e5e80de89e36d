"""Retention in place and file skipping: nothing kept is copied, readers see one version, only matching files are opened."""

import datetime as dt
import os

import pytest
from helpers import T0

from pyspark.sql import functions as F
from ridestar.sources import bronze as B
from ridestar.sources.archive import Archive

DAY = dt.timedelta(days=1)


def archive(spark, path, days=range(10)):
    for d in days:
        rows = [(None, f"v{d}-{i}", i % 2, 100 * d + i, T0 + d * DAY + dt.timedelta(minutes=i), T0 + d * DAY) for i in range(20)]
        df = spark.createDataFrame(rows, "key string, value string, partition int, offset long, kafka_timestamp timestamp, ingestion_time timestamp")
        B.with_ingest_date(df).coalesce(1).write.mode("append").partitionBy(B.PARTITION_COLUMN).parquet(path)
    return Archive(spark, path)


def state_of(path):
    return {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and "_index" not in r}


def test_expiry_copies_nothing_and_readers_keep_their_version(spark, tmp_dir):
    path = f"{tmp_dir}/bronze"
    a = archive(spark, path)
    assert a.refresh() == 10 and a.refresh() == 0
    before, old = state_of(path), a.versions.current()[0]
    reader = a.read()                                    # listed before the expiry
    first = a.expire(3, (T0 + 9 * DAY).date())
    assert first == (T0 + 7 * DAY).date().isoformat() and state_of(path) == before
    assert a.read().count() == 60 and reader.count() == 200 and a.read(version=old).count() == 200
    assert a.expire(5, (T0 + 9 * DAY).date()) == first   # what was given up does not come back
    archive(spark, path, [10])
    assert a.refresh() == 1 and a.read().count() == 80
    gone = a.vacuum()
    assert len(gone) == 7 and set(state_of(path)) < {*before, *state_of(path)} and a.vacuum() == []
    assert a.read().count() == 80 and a.read().select("ingest_date").distinct().count() == 4
    kept = {f: t for f, t in before.items() if f in state_of(path)}
    assert len(kept) == 3 and all(state_of(path)[f] == t for f, t in kept.items())


def test_vacuum_leaves_what_a_kept_version_reads(spark, tmp_dir):
    a = archive(spark, f"{tmp_dir}/bronze", range(4))
    a.refresh()
    a.expire(1, (T0 + 3 * DAY).date())
    assert a.vacuum(keep=2) == [] and a.read(version=1).count() == 80
    assert len(a.vacuum(keep=1)) == 3 and a.read().count() == 20


def test_only_matching_files_are_opened(spark, tmp_dir):
    path = f"{tmp_dir}/bronze"
    a = archive(spark, path)
    a.refresh()
    some = a.read(partition=1, offsets=(305, 512))
    assert len(some.inputFiles()) == 3
    assert sorted(r.offset for r in some.collect()) == [o for o in range(305, 513) if o % 100 < 20 and o % 2 == 1]
    noon = a.read(times=(T0 + 4 * DAY, T0 + 4 * DAY + dt.timedelta(minutes=5)))
    assert len(noon.inputFiles()) == 1 and noon.count() == 6
    assert a.read(offsets=(5000, 6000)).count() == 0 and a.read(offsets=(50, 60)).inputFiles() == []
    for f in state_of(path):                             # the others need not be readable
        if f not in {x.removeprefix("file://").removeprefix("file:") for x in some.inputFiles()}:
            open(f, "wb").close()
    assert some.agg(F.count(F.lit(1))).first()[0] == len([o for o in range(305, 513) if o % 100 < 20 and o % 2 == 1])


def test_an_archive_without_a_version(spark, tmp_dir):
    a = archive(spark, f"{tmp_dir}/bronze", [0])
    with pytest.raises(ValueError):
        a.read()


def test_files_of_a_stream(spark, tmp_dir):
    from ridestar.sources.kafka import bronze_frame, read_event_files

    source = f"{tmp_dir}/in"
    (spark.range(30).selectExpr("cast(null as binary) key", "cast('v' as binary) value", "'t' topic", "cast(id % 3 as int) partition",
                                "id offset", "timestamp_seconds(id) timestamp", "0 timestampType").repartition(3).write.parquet(source))
    for _ in range(2):
        B.write_bronze(bronze_frame(read_event_files(spark, source, 1)), f"{tmp_dir}/bronze", f"{tmp_dir}/ck", available_now=True).awaitTermination()
        Archive(spark, f"{tmp_dir}/bronze").refresh()
    assert Archive(spark, f"{tmp_dir}/bronze").read().count() == 30
