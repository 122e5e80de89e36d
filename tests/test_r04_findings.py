"""Findings of round 4: what queries leave on disk while they run, with whole results."""

import glob
import os
import time

from pyspark.sql import functions as F

from test_r03_findings import trips  # noqa: F401  (the tables of our own)


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _left(spark, *kinds) -> list[str]:
    """What a query left in the shared folder of these kinds."""
    from ridestar.session import strip_file_scheme, work_dir

    root = strip_file_scheme(work_dir(spark))
    return sorted(p for k in kinds for p in glob.glob(f"{root}/{k}-*"))


def test_line_items_are_shuffled_for_parts_and_orders_only(spark, trips, monkeypatch):  # noqa: F811
    from ridestar.sources import testdata

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _physical(testdata.trip_rows(spark, trips))
        few = sorted(map(str, testdata.trip_rows(spark, trips).collect()))
        assert "hashpartitioning(l_partkey" in plan and "hashpartitioning(l_orderkey" in plan
        assert "hashpartitioning(l_suppkey" not in plan
        monkeypatch.setattr(testdata, "BROADCAST_SUPPLIERS", 3)   # one supplier too many: left to the planner
        assert "hashpartitioning(l_suppkey" in _physical(testdata.trip_rows(spark, trips))
        assert sorted(map(str, testdata.trip_rows(spark, trips).collect())) == few and len(few) == 120
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_topic_is_numbered_without_shuffling_its_messages(spark, trips):  # noqa: F811
    from ridestar.sources import testdata

    topic = testdata.trip_topic(spark, trips)
    fields = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        lines = _physical(topic).splitlines()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    made = next(i for i, line in enumerate(lines) if "StructsToJson" in line or "to_json" in line)
    assert not any("Exchange" in line for line in lines[:made])
    rows = topic.collect()
    bronze = testdata.trip_bronze(spark, trips).collect()
    assert sorted((r.partition, r.value) for r in rows) == sorted((r.partition, r.value) for r in bronze)
    given = {}
    for r in sorted(bronze, key=lambda r: (r.partition, r.offset, r.kafka_timestamp, r.value)):
        given.setdefault(r.partition, []).append(r.value)
    for p, values in given.items():
        assert [r.value for r in sorted(rows, key=lambda r: r.offset) if r.partition == p] == values
        assert sorted(r.offset for r in rows if r.partition == p) == list(range(1, len(values) + 1))


def test_a_write_drops_its_shuffle_files(spark, tmp_dir):
    from ridestar.session import _FREE_SHUFFLES
    from ridestar.sources.tables import write_table

    def shuffles() -> int:
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(os.path.basename(files.apply(i).getPath()).startswith("shuffle_") for i in range(files.size()))

    before, setting = shuffles(), spark.conf.get(_FREE_SHUFFLES, None)
    out = write_table(spark.range(10_000).repartition(7, "id"), f"{tmp_dir}/t")
    end = time.time() + 20
    while shuffles() > before and time.time() < end:
        time.sleep(0.2)
    assert shuffles() <= before and out.count() == 10_000
    assert spark.conf.get(_FREE_SHUFFLES, None) == setting


def test_merges_shuffle_rows_once_and_leave_no_scratch(spark, trips):  # noqa: F811
    from ridestar import queries as Q

    want = sorted(map(str, Q.REGISTRY["stg_parse"](spark, trips).drop("ingestion_time", "kafka_offset").collect()))
    kinds = ("topic", "messages", "increment", "hits")
    before = _left(spark, *kinds)
    for name in ("stg_incremental", "stg_stream", "dq_metrics_states"):
        got = Q.REGISTRY[name](spark, trips)
        if name != "dq_metrics_states":
            assert sorted(map(str, got.drop("ingestion_time", "kafka_offset").collect())) == want
        assert _left(spark, *kinds) == before, name


def test_a_merge_of_known_trips_shuffles_its_rows_once(spark, tmp_dir, monkeypatch):
    from helpers import bronze, payload, ts

    from ridestar.plans import silver

    def messages(first, price):
        return bronze(spark, [(payload(id=f"t{i}", price=price), 0, first + i, ts(first + i)) for i in range(20)])

    table = silver.Silver(spark, f"{tmp_dir}/stg", buckets=3)
    table.merge(messages(0, 1.0))
    plans, write = [], silver.write_table
    monkeypatch.setattr(silver, "write_table", lambda df, path, **kw: (plans.append(_physical(df)) if kw else None, write(df, path, **kw))[1])
    did = table.merge(messages(100, 2.0))
    assert did["merged"] and len(plans) == 1 and plans[0].count("Exchange") == 1
    rows = table.read().collect()
    assert sorted((r.trip_id, r.price) for r in rows) == sorted((f"t{i}", 2.0) for i in range(20))


def test_raw_csv_is_on_disk_for_one_slice_at_a_time(spark, trips, monkeypatch):  # noqa: F811
    from ridestar import queries as Q

    want = sorted(map(str, Q.REGISTRY["clean_columns"](spark, trips).collect()))
    before, seen, write = _left(spark, "csv", "rows"), [], Q._write_trip_csv

    def watched(rows, **options):
        path = write(rows, **options)
        seen.append([p for p in _left(spark, "csv") if p not in before])
        return path

    monkeypatch.setattr(Q, "_write_trip_csv", watched)
    monkeypatch.setattr(Q, "CSV_SLICE_BYTES", 1)
    # rows in several files: of a shuffled join's partitions
    several = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in several.items():
        spark.conf.set(name, value)
    try:
        got = sorted(map(str, Q.REGISTRY["clean_columns"](spark, trips).collect()))
    finally:
        for name in several:
            spark.conf.unset(name)
    assert got == want and len(want) == 120
    assert len(seen) > 1 and all(len(s) == 1 for s in seen)
    assert _left(spark, "csv", "rows") == before


def test_the_producers_csv_files_are_dropped_once_streamed(spark, trips):  # noqa: F811
    from ridestar import queries as Q

    before = _left(spark, "csv")
    got = Q.REGISTRY["producer_stream"](spark, trips)
    assert _left(spark, "csv") == before and got.count() == 120
    assert got.where(F.col("distance_miles").isNotNull()).count() == 120
