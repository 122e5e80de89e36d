"""Physical-plan properties the design relies on at scale (checked on small inputs)."""

import contextlib
import io
import os

import pytest

from ridestar.plans import core, marts, quality, staging

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _tree(text: str) -> str:
    return text.split("\n\n")[0]


def test_staging_parses_once_and_limits_before_shuffle(spark, tmp_dir):
    from ridestar.sources import testdata

    src = os.path.join(tmp_dir, "bronze")
    testdata.trip_bronze(spark, SF).write.parquet(src)
    text = plan(staging.stg_events(spark.read.parquet(src)))
    tree = _tree(text)
    assert text.count("from_json(") == 1                      # one typed parse per row
    assert "Generate" in tree
    lines = [ln for ln in tree.splitlines() if "WindowGroupLimit" in ln or "Exchange" in ln]
    # top-down: final limit, exchange, partial limit below it
    assert [("Exchange" in ln) for ln in lines] == [False, True, False]
    assert "Partial" in text and "Final" in text


def _warehouse(spark, tmp_dir):
    from ridestar.plans.pipeline import run_pipeline
    from ridestar.sources import testdata

    src = os.path.join(tmp_dir, "bronze")
    testdata.trip_bronze(spark, SF).write.parquet(src)
    return run_pipeline(spark, spark.read.parquet(src), os.path.join(tmp_dir, "wh"), store_failures=False,
                        table_prefix="plans_test_")


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    return _warehouse(spark, str(tmp_path_factory.mktemp("wh")))


def test_mart_prunes_columns_and_broadcasts_small_dims(warehouse):
    t = warehouse.tables
    text = plan(marts.mart_surge_analysis(t["fact_trips"], t["dim_locations"], t["dim_cabs"]))
    fact_schema = [ln for ln in text.splitlines() if ln.startswith("ReadSchema") and "trip_id" in ln][0]
    assert "kafka_offset" not in fact_schema and "temperature" not in fact_schema
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    tree = _tree(text)
    # the fact is aggregated (partial + final) below the first join
    first_join = next(i for i, ln in enumerate(tree.splitlines()) if "Join" in ln)
    assert sum("HashAggregate" in ln for ln in tree.splitlines()[first_join:]) >= 2


def test_no_cartesian_products(warehouse):
    from ridestar.plans import checks as C

    t = warehouse.tables
    for df in (quality.dq_metrics(t[C.STG], t["fact_trips"]), C.run_checks(t),
               C.assert_reconciled(t[C.STG], t["fact_trips"]), C.assert_complete(t[C.STG])):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_id_aggregates_on_bucketed_fact_need_no_shuffle(warehouse):
    text = plan(quality.id_profile(warehouse.tables["fact_trips"]))
    assert "Bucketed: true" in text
    assert "hashpartitioning" not in text                      # only the single-partition final exchange


def test_registered_marts_read_pruned_staging_and_broadcast_by_size(spark):
    from ridestar import queries as Q

    text = plan(Q.REGISTRY["mart_surge_analysis"](spark, SF))
    schemas = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert schemas and all("pressure" not in ln and "kafka_offset" not in ln for ln in schemas)
    assert "ExistingRDD" not in text
    assert "GlobalLimit" not in text and "CartesianProduct" not in text


def test_single_consumers_are_lazy_and_parse_once(spark):
    from ridestar import queries as Q

    for name in ("dim_cabs", "assert_lag"):
        assert plan(Q.REGISTRY[name](spark, SF)).count("from_json(") == 1


def test_a_calendar_prunes_the_partitions_of_the_fact(spark, tmp_dir):
    from helpers import staging_rows

    stg = staging_rows(spark, [dict(trip_id=f"t{d}-{i}", trip_datetime=f"2024-03-{d:02d} 10:00:0{i}", price=float(i)) for d in range(1, 15)
                               for i in range(3)] + [dict(trip_id="x", trip_datetime="no date")])
    core.fact_by_date(stg).repartition(core.TRIP_DATE).write.partitionBy(core.TRIP_DATE).parquet(f"{tmp_dir}/fact")
    core.dim_calendar(stg).write.parquet(f"{tmp_dir}/days")
    fact, days = spark.read.parquet(f"{tmp_dir}/fact"), spark.read.parquet(f"{tmp_dir}/days")
    assert fact.columns == [*core.fact_trips(stg).columns, core.TRIP_DATE] and days.count() == 14
    out = marts.mart_daily_trends(fact, days.where("is_weekend AND month = 3"))
    assert "dynamicpruning" in plan(out).lower()
    assert sorted((r.day_of_week, r.total_trips, r.avg_price) for r in out.collect()) == [("Saturday", 6, 1.0), ("Sunday", 6, 1.0)]
    # the partitions of other dates are not opened
    import glob
    for f in glob.glob(f"{tmp_dir}/fact/trip_date=*/*.parquet"):
        if f.split("trip_date=")[1][:10] not in ("2024-03-02", "2024-03-03", "2024-03-09", "2024-03-10"):
            open(f, "wb").close()
    assert sum(r.total_trips for r in marts.mart_daily_trends(spark.read.schema(fact.schema).parquet(f"{tmp_dir}/fact"), days.where("is_weekend AND month = 3")).collect()) == 12
