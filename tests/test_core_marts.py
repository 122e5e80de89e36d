"""Star schema and marts on hand-written rides: key rules, tie-breaks, fan-out, empty input."""

import datetime as dt

from helpers import collect_sorted, staging_rows, ts

from pyspark.sql import functions as F

from ridestar.plans import core, marts


def _ride(tid, **kw):
    base = dict(trip_id=tid, trip_datetime="2024-03-02 10:00:00", source_neighborhood="Back Bay",
                destination_neighborhood="Fenway", cab_provider="Uber", product_id="p1", cab_tier="UberX",
                price=10.0, distance_miles=2.0, surge_multiplier=1.0, latitude=42.3, longitude=-71.1,
                temperature=40.0, weather_short_summary="Clear", weather_long_summary="Clear all day",
                weather_icon="clear-day", kafka_partition=0, kafka_offset=1, kafka_timestamp=ts(),
                ingestion_time=ts(1))
    base.update(kw)
    return base


def test_cab_key_null_and_empty_share_key(spark):
    stg = staging_rows(spark, [_ride("a", product_id=None), _ride("b", product_id="")])
    cabs = core.dim_cabs(stg).collect()
    assert [(r.cab_provider, r.product_id, r.cab_tier) for r in cabs] == [("Uber", "", "UberX")]   # one row per key
    trips = marts.mart_trip_trends(core.fact_trips(stg), core.dim_datetime(stg), core.dim_cabs(stg)).collect()
    assert [r.total_trips for r in trips] == [2]


def test_null_neighbourhood_gives_null_key(spark):
    stg = staging_rows(spark, [_ride("a", source_neighborhood=None)])
    fact = core.fact_trips(stg).first()
    assert fact.source_location_key is None
    locs = {r.neighborhood: r for r in core.dim_locations(stg).collect()}
    assert locs[None].location_key is None
    assert locs["Fenway"].latitude == 42.3     # destination gets the pickup coordinates


def test_dim_datetime_weekend(spark):
    stg = staging_rows(spark, [_ride("a", trip_datetime="2024-03-02 23:59:59"),   # Saturday
                               _ride("b", trip_datetime="2024-03-03 00:00:00"),   # Sunday
                               _ride("c", trip_datetime="2024-03-04 07:30:00")])  # Monday
    got = {r.trip_datetime: (r.day_of_week, r.is_weekend, r.hour) for r in core.dim_datetime(stg).collect()}
    assert got[dt.datetime(2024, 3, 2, 23, 59, 59)] == ("Saturday", True, 23)
    assert got[dt.datetime(2024, 3, 3, 0, 0, 0)] == ("Sunday", True, 0)
    assert got[dt.datetime(2024, 3, 4, 7, 30, 0)] == ("Monday", False, 7)


def test_dim_weather_aligned_and_reference(spark):
    stg = staging_rows(spark, [
        _ride("a", temperature=40.0, humidity=0.5),
        _ride("b", temperature=41.0, humidity=0.4),
        _ride("c", temperature=41.0, humidity=0.6),      # tie on temperature: higher humidity wins
        _ride("d", temperature=None),                      # no temperature: not in the dimension
        _ride("e", weather_icon="clear-night"),            # other icon: own key in aligned mode
    ])
    w = core.dim_weather(stg, core.ALIGNED).collect()
    assert len(w) == 2
    day = [r for r in w if r.weather_icon == "clear-day"][0]
    assert (day.temperature, day.humidity) == (41.0, 0.6)
    fact = core.fact_trips(stg)
    assert marts.mart_weather_impact(fact, core.dim_weather(stg, core.ALIGNED), core.dim_cabs(stg)).count() == 1
    ref = core.dim_weather(stg, core.REFERENCE)
    assert ref.count() == 2                              # keys: temperature text || summary
    assert marts.mart_weather_impact(fact, ref, core.dim_cabs(stg)).count() == 0


def _naive_surge(fact, loc, cabs):
    j = fact.join(loc, fact.source_location_key == loc.location_key).join(cabs, "cab_key")
    return j.groupBy(F.col("neighborhood").alias("source_neighborhood"), "cab_provider", "cab_tier").agg(
        F.count("trip_id").alias("total_trips"),
        F.count(F.when(F.col("surge_multiplier") > 1.0, 1)).alias("surge_trips"),
        F.max("surge_multiplier").alias("max_surge_multiplier"),
        F.avg("price").alias("avg_price"), F.avg("surge_multiplier").alias("avg_surge_multiplier"))


def test_preaggregated_star_equals_join_then_aggregate_with_fanout(spark):
    rides = [_ride(str(i), price=float(i), surge_multiplier=1.0 + (i % 3) / 10,
                   source_neighborhood=["A", "B", None][i % 3], product_id=[None, "", "p"][i % 3])
             for i in range(30)]
    stg = staging_rows(spark, rides)
    fact, loc, cabs = core.fact_trips(stg), core.dim_locations(stg), core.dim_cabs(stg)
    got = marts.mart_surge_analysis(fact, loc, cabs)
    want = _naive_surge(fact, loc, cabs)
    cols = ["source_neighborhood", "cab_provider", "cab_tier", "total_trips", "surge_trips", "max_surge_multiplier"]
    assert collect_sorted(got, *cols) == collect_sorted(want, *cols)
    g = {(r.source_neighborhood, r.cab_tier): round(r.avg_price, 9) for r in got.collect()}
    w = {(r.source_neighborhood, r.cab_tier): round(r.avg_price, 9) for r in want.collect()}
    assert g == w


def test_empty_staging(spark):
    stg = staging_rows(spark, [])
    fact = core.fact_trips(stg)
    assert marts.mart_surge_analysis(fact, core.dim_locations(stg), core.dim_cabs(stg)).count() == 0
    assert marts.mart_trip_trends(fact, core.dim_datetime(stg), core.dim_cabs(stg)).count() == 0


def test_dim_datetime_strict_and_lenient(spark):
    import pytest

    stg = staging_rows(spark, [_ride("a"), _ride("b", trip_datetime="junk")])
    with pytest.raises(Exception):
        core.dim_datetime(stg).collect()
    rows = core.dim_datetime(stg, strict=False).collect()
    assert sorted(r.hour is None for r in rows) == [False, True]
