"""Quality mart and checks: lag truncation, empty input, NULL semantics, statuses, verdict, failure store."""

import pytest
from helpers import staging_rows, ts

from ridestar.plans import checks as C
from ridestar.plans import core, quality


def _ride(tid, **kw):
    base = dict(trip_id=tid, cab_provider="Uber", cab_tier="UberX", source_neighborhood="A",
                destination_neighborhood="B", price=10.0, distance_miles=1.0, surge_multiplier=1.0, trip_hour=5,
                trip_datetime="2024-03-02 10:00:00", kafka_partition=0, kafka_offset=0,
                kafka_timestamp=ts(), ingestion_time=ts())
    base.update(kw)
    return base


@pytest.mark.parametrize("seconds, expected", [(119, 1), (120 * 60 + 59, 120), (121 * 60, 121), (-119, -1)])
def test_lag_cases(spark, seconds, expected):
    stg = staging_rows(spark, [_ride("a", ingestion_time=ts(seconds=seconds))])
    t = quality.timeliness(core.fact_trips(stg)).first()
    assert t.max_lag_minutes == expected
    assert t.records_exceeding_sla == (1 if expected > 120 else 0)


def test_null_lag_left_out(spark):
    stg = staging_rows(spark, [_ride("a", ingestion_time=None), _ride("b", ingestion_time=ts(10))])
    t = quality.timeliness(core.fact_trips(stg)).first()
    assert (t.avg_lag_minutes, t.median_lag_minutes, t.timeliness_rate) == (10.0, 10.0, 100.0)


def test_empty_input_gives_null_rates(spark):
    stg = staging_rows(spark, [])
    row = quality.dq_metrics(stg, core.fact_trips(stg)).first()
    assert row.stg_total_rows == 0 and row.overall_completeness_rate is None and row.uniqueness_rate is None
    assert row.accuracy_rate == 100.0


def test_rates_and_composite(spark):
    stg = staging_rows(spark, [_ride("a"), _ride("b", price=None, cab_provider="Other", trip_hour=24),
                               _ride("c", surge_multiplier=0.9, distance_miles=None)])
    r = quality.dq_metrics(stg, core.fact_trips(stg)).first()
    assert r.completeness_price == round(2 / 3 * 100, 2)
    assert r.validity_price_rate == 100.0          # NULL price counts as valid here
    assert r.validity_cab_provider_rate == round(2 / 3 * 100, 2)
    assert r.validity_hour_rate == round(2 / 3 * 100, 2)
    parts = [r.completeness_trip_id, r.completeness_price, r.completeness_distance, r.completeness_cab_provider,
             r.completeness_cab_tier, r.completeness_source_nbhd, r.completeness_surge]
    assert min(parts) <= r.overall_completeness_rate <= max(parts)
    five = [r.overall_completeness_rate, r.uniqueness_rate, r.overall_validity_rate, r.accuracy_rate,
            r.timeliness_rate]
    assert r.composite_dq_score == round(sum(five) / 5, 2)


def _models(spark, rides):
    stg = staging_rows(spark, rides)
    return {C.STG: stg, "stg": stg, "dim_cabs": core.dim_cabs(stg), "dim_datetime": core.dim_datetime(stg),
            "dim_locations": core.dim_locations(stg), "dim_weather": core.dim_weather(stg),
            "fact_trips": core.fact_trips(stg)}


def test_generic_check_semantics(spark):
    m = _models(spark, [_ride("a"), _ride("a", kafka_offset=1), _ride("b", cab_provider=None),
                        _ride("c", cab_provider="Other", surge_multiplier=None), _ride(None)])
    res = {r.check_name: r for r in C.check_counts(m).collect()}
    assert res["not_null__stg_rideshare_events__trip_id"].failures == 1
    assert res["not_null__stg_rideshare_events__trip_id"].status == "fail"
    assert res["unique__stg_rideshare_events__trip_id"].failures == 1          # one duplicated value
    assert res["accepted_values__stg_rideshare_events__cab_provider"].failures == 1   # NULL passes
    assert res["expression_is_true__stg_rideshare_events__surge_multiplier"].failures == 0  # NULL passes
    assert res["not_null__stg_rideshare_events__cab_provider"].status == "warn"
    assert res["relationships__fact_trips__cab_key"].failures == 0


def test_relationship_orphans(spark):
    m = _models(spark, [_ride("a"), _ride("b", source_neighborhood="Z")])
    m["dim_locations"] = m["dim_locations"].where("neighborhood <> 'Z'")
    res = {r.check_name: r for r in C.check_counts(m).collect()}
    assert res["relationships__fact_trips__source_location_key"].failures == 1


def test_verdict_and_evaluate(spark):
    m = _models(spark, [_ride("a"), _ride("b", cab_provider=None)])
    results = C.run_checks(m)
    v = {(r.severity, r.status): r.checks for r in C.verdict(results).collect()}
    assert v.get(("warn", "warn"), 0) >= 1
    report = C.evaluate(results)
    assert any("cab_provider" in n for n, _ in report["warn"])
    bad = _models(spark, [_ride("a"), _ride("a", kafka_offset=1)])
    with pytest.raises(C.DataQualityError):
        C.evaluate(C.run_checks(bad))


def test_failure_store_layout(spark, tmp_dir):
    m = _models(spark, [_ride("a"), _ride("b", cab_provider=None, price=None)])
    C.write_failures(m, tmp_dir)
    rows = spark.read.parquet(f"{tmp_dir}/row_checks/{C.STG}")
    names = {r.check_name for r in rows.select("check_name").distinct().collect()}
    assert "not_null__stg_rideshare_events__cab_provider" in names
    assert "not_null__stg_rideshare_events__price" in names
    assert spark.read.parquet(f"{tmp_dir}/assert_price_positive").count() == 1
    by_name = {ck.name: ck for ck in C.DECLARED_CHECKS}
    assert C.read_failures(spark, tmp_dir, by_name["not_null__stg_rideshare_events__price"], m).count() == 1
    assert C.read_failures(spark, tmp_dir, by_name["not_null__dim_cabs__cab_key"], m).count() == 0   # empty store
    assert C.read_failures(spark, tmp_dir, by_name["unique__fact_trips__trip_id"], m).count() == 0


def test_singular_tests(spark):
    m = _models(spark, [_ride("a", price=None), _ride("b", price=-1.0), _ride("c", ingestion_time=ts(121))])
    assert C.assert_positive(m[C.STG]).count() == 2
    assert C.assert_lag(m["fact_trips"]).count() == 1
    comp = {r.column_name: r.null_pct for r in C.assert_complete(m[C.STG]).collect()}
    assert comp == {"price": round(100 / 3, 2)}
    assert C.assert_reconciled(m[C.STG], m["fact_trips"]).count() == 0


def test_counts_from_store_equal_direct_counts(spark, tmp_dir):
    m = _models(spark, [_ride("a"), _ride("a", kafka_offset=1), _ride("b", cab_provider=None, price=None),
                        _ride("c", cab_provider="Other", surge_multiplier=0.5, ingestion_time=ts(200)),
                        _ride("d", source_neighborhood="Z")])
    m["dim_locations"] = m["dim_locations"].where("neighborhood <> 'Z'")
    direct = sorted(map(tuple, C.run_checks(m).collect()), key=str)
    C.write_failures(m, tmp_dir, threads=3)
    stored = sorted(map(tuple, C.results_from_store(spark, tmp_dir, m).collect()), key=str)
    assert stored == direct


def test_checks_are_counted_while_the_models_are_written(spark, tmp_dir):
    m = _models(spark, [_ride("a"), _ride("a", kafka_offset=1), _ride("b", cab_provider=None, price=None),
                        _ride("c", surge_multiplier=0.5, ingestion_time=ts(200)), _ride(None)])
    del m["stg"]
    seen = C.Observed(C.DECLARED_CHECKS, C.SINGULAR_TESTS)
    kept = {}
    for name, df in m.items():
        seen.watch(name, df).write.parquet(f"{tmp_dir}/{name}")
        kept[name] = spark.read.parquet(f"{tmp_dir}/{name}")
    counted = seen.counts()
    rows = [ck for ck in C.DECLARED_CHECKS if ck.kind in C.ROW_LEVEL]
    by_row = [t for t in C.SINGULAR_TESTS if t.violation]
    assert set(counted) == {x.name for x in rows + by_row} and sum(n > 0 for n in counted.values()) > 3
    direct, free = C.check_counts(kept, rows, by_row), C.check_counts(kept, rows, by_row, counted)
    assert sorted(map(tuple, free.collect()), key=str) == sorted(map(tuple, direct.collect()), key=str)
    # a scan less for each model
    scans = [d._jdf.queryExecution().optimizedPlan().toString().count("parquet") for d in (direct, free)]
    assert scans == [len(m), 0]


def test_a_store_without_failures_reads_as_empty(spark, tmp_dir):
    m = _models(spark, [_ride("a")])
    C.write_failures(m, tmp_dir, [], [])
    assert all(C.read_failures(spark, tmp_dir, x, m).count() == 0
               for x in (C.DECLARED_CHECKS[0], C.DECLARED_CHECKS[1], C.SINGULAR_TESTS[3]))
