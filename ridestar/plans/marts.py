"""Business marts over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridestar.functions.numeric import pct
from ridestar.operators.star import Dim, Measure, star_aggregate

_CAB_COLUMNS = {"cab_provider": "cab_provider", "cab_tier": "cab_tier"}


def mart_trip_trends(fact: DataFrame, dim_dt: DataFrame, cabs: DataFrame) -> DataFrame:
    """Trips, average price, distance and surge by calendar hour x provider x tier."""
    cal = ["year", "month", "day", "hour", "day_of_week", "is_weekend"]
    return star_aggregate(
        fact,
        [Dim(dim_dt, "datetime_key", "datetime_key", {c: c for c in cal}),
         Dim(cabs, "cab_key", "cab_key", _CAB_COLUMNS)],
        cal + ["cab_provider", "cab_tier"],
        [Measure("total_trips", "count", F.col("trip_id")),
         Measure("avg_price", "avg", F.col("price")),
         Measure("avg_distance_miles", "avg", F.col("distance_miles")),
         Measure("avg_surge_multiplier", "avg", F.col("surge_multiplier"))],
    )


def mart_surge_analysis(fact: DataFrame, locations: DataFrame, cabs: DataFrame) -> DataFrame:
    """Surge share, maximum and averages by source neighbourhood x provider x tier."""
    agg = star_aggregate(
        fact,
        [Dim(locations, "source_location_key", "location_key", {"source_neighborhood": "neighborhood"}),
         Dim(cabs, "cab_key", "cab_key", _CAB_COLUMNS)],
        ["source_neighborhood", "cab_provider", "cab_tier"],
        [Measure("total_trips", "count", F.col("trip_id")),
         Measure("surge_trips", "count_if", F.col("surge_multiplier") > F.lit(1.0)),
         Measure("max_surge_multiplier", "max", F.col("surge_multiplier")),
         Measure("avg_price", "avg", F.col("price")),
         Measure("avg_surge_multiplier", "avg", F.col("surge_multiplier"))],
    )
    return agg.select(
        "source_neighborhood", "cab_provider", "cab_tier", "total_trips", "surge_trips",
        pct(F.col("surge_trips"), F.col("total_trips")).alias("surge_percentage"),
        "max_surge_multiplier", "avg_price", "avg_surge_multiplier",
    )


def mart_weather_impact(fact: DataFrame, weather: DataFrame, cabs: DataFrame) -> DataFrame:
    """Trips and averages (temperature, rain chance, price, surge) by weather summary x provider x tier."""
    return star_aggregate(
        fact,
        [Dim(weather, "weather_key", "weather_key", {"weather_short_summary": "weather_short_summary"}),
         Dim(cabs, "cab_key", "cab_key", _CAB_COLUMNS)],
        ["weather_short_summary", "cab_provider", "cab_tier"],
        [Measure("total_trips", "count", F.col("trip_id")),
         Measure("avg_temperature", "avg", F.col("temperature")),
         Measure("avg_precip_probability", "avg", F.col("precip_probability")),
         Measure("avg_price", "avg", F.col("price")),
         Measure("avg_surge_multiplier", "avg", F.col("surge_multiplier"))],
    )


def mart_daily_trends(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Trips and averages by day of week and month, for the dates that ``calendar`` (filtered, say) holds.

    ``fact`` is partitioned by trip date: the calendar's dates prune its partitions at run time, before any is read.
    """
    days = calendar.select("trip_date", "year", "month", "day_of_week", "is_weekend")
    return (fact.join(days, "trip_date").groupBy("year", "month", "day_of_week", "is_weekend")
            .agg(F.count(F.lit(1)).alias("total_trips"), F.avg("price").alias("avg_price"),
                 F.avg("distance_miles").alias("avg_distance_miles")))
