"""Core star schema: four dimensions and the trip fact, all derived from staging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestar.functions.keys import (
    natural_key,
    surrogate_key,
    weather_key_dim_reference,
    weather_key_fact_reference,
)
from ridestar.functions.time import day_name
from ridestar.operators.dedup import dedup_latest
from ridestar.operators.reshape import union_projections
from ridestar.spec import FACT_ENVIRONMENT_COLUMNS, WEEKEND_DAYS

ALIGNED = "aligned"
REFERENCE = "reference"
KEY_MODES = (ALIGNED, REFERENCE)

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

_CABS = ("cab_provider", "product_id", "cab_tier")

# Staging columns that each dimension reads.
DIM_INPUTS: dict[str, tuple[str, ...]] = {
    "dim_cabs": _CABS,
    "dim_datetime": ("trip_datetime",),
    "dim_locations": ("source_neighborhood", "destination_neighborhood", "latitude", "longitude"),
    "dim_weather": ("temperature", "apparent_temperature", "humidity", "precip_probability",
                    "weather_short_summary", "weather_long_summary", "weather_icon"),
}

# Staging columns that the fact's keys are made of; its other columns are taken as they are.
_KEY_INPUTS: dict[str, tuple[str, ...]] = {
    "source_location_key": ("source_neighborhood",),
    "destination_location_key": ("destination_neighborhood",),
    "cab_key": _CABS,
    "weather_key": ("weather_short_summary", "weather_long_summary", "weather_icon"),
    "datetime_key": ("trip_datetime",),
}
FACT_COLUMNS: tuple[str, ...] = (
    "trip_id", *_KEY_INPUTS, "price", "distance_miles", "surge_multiplier", *FACT_ENVIRONMENT_COLUMNS,
    "kafka_partition", "kafka_offset", "kafka_timestamp", "ingestion_time",
)


def fact_inputs(columns: Sequence[str] | None = None) -> list[str]:
    """Staging columns that the given columns of the fact (None: all) are made of."""
    return [i for c in columns or FACT_COLUMNS for i in _KEY_INPUTS.get(c, (c,))]


def dim_cabs(stg: DataFrame) -> DataFrame:
    """One row per cab key (md5 of provider, product, tier; NULL and '' share a key): its greatest values.

    A key with several spellings would count its trips once per spelling in every mart.
    """
    return (stg.groupBy(surrogate_key(*_CABS).alias("cab_key")).agg(F.max(F.struct(*_CABS)).alias("c"))
            .select("cab_key", *[F.col(f"c.{x}") for x in _CABS]))


def dim_datetime(stg: DataFrame, strict: bool = True) -> DataFrame:
    """Distinct trip datetimes, parsed once, with calendar parts.

    ``strict`` (default, as upstream): text that does not match the format fails
    the job. ``strict=False``: such text gives a NULL timestamp and parts.
    """
    dts = stg.select("trip_datetime").distinct()
    parse = F.to_timestamp_ntz if strict else F.try_to_timestamp
    ts = parse(F.col("trip_datetime"), F.lit(DATETIME_FORMAT))
    if not strict:
        ts = ts.cast("timestamp_ntz")
    parsed = dts.select(natural_key("trip_datetime").alias("datetime_key"), ts.alias("__ts"))
    dow = day_name("__ts")
    return parsed.select(
        "datetime_key",
        F.col("__ts").alias("trip_datetime"),
        F.hour("__ts").cast("bigint").alias("hour"),
        F.dayofmonth("__ts").cast("bigint").alias("day"),
        F.month("__ts").cast("bigint").alias("month"),
        F.year("__ts").cast("bigint").alias("year"),
        dow.alias("day_of_week"),
        F.coalesce(dow.isin(*WEEKEND_DAYS), F.lit(False)).alias("is_weekend"),
    )


def dim_locations(stg: DataFrame) -> DataFrame:
    """Neighbourhoods from both trip ends with average coordinates.

    Both ends carry the trip's (pickup) coordinates, as upstream. The two
    projections are produced from one scan; the average is partially aggregated
    before the shuffle (one row per neighbourhood per task).
    """
    ends = union_projections(
        stg,
        [
            [F.col("source_neighborhood"), F.col("latitude"), F.col("longitude")],
            [F.col("destination_neighborhood"), F.col("latitude"), F.col("longitude")],
        ],
        ["neighborhood", "latitude", "longitude"],
    )
    return ends.groupBy("neighborhood").agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")
    ).select(natural_key("neighborhood").alias("location_key"), "neighborhood", "latitude", "longitude")


def weather_key_dim(key_mode: str = ALIGNED):
    if key_mode == ALIGNED:
        return weather_key_fact_reference()
    if key_mode == REFERENCE:
        return weather_key_dim_reference()
    raise ValueError(f"key_mode must be one of {KEY_MODES}")


def dim_weather(stg: DataFrame, key_mode: str = ALIGNED) -> DataFrame:
    """One row per weather key among trips with a temperature (the warmest, ties broken on all columns).

    ``aligned``: the key is the fact's key over (short, long, icon), so the fact
    joins. ``reference``: md5(temperature text || short summary), as written
    upstream; it never equals the fact key.
    """
    cols = ["temperature", "apparent_temperature", "humidity", "precip_probability",
            "weather_short_summary", "weather_long_summary"]
    if key_mode == ALIGNED:
        cols.append("weather_icon")
    rows = stg.where(F.col("temperature").isNotNull()).select(weather_key_dim(key_mode).alias("weather_key"), *cols)
    return dedup_latest(rows, ["weather_key"], cols)


def fact_trips(stg: DataFrame, key_mode: str = ALIGNED, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per staged trip: 5 foreign keys, 3 measures, 11 environment columns, 4 metadata.

    ``columns``: only these columns of it, for models that read no others; ``fact_inputs`` names what staging must hold.
    """
    if key_mode not in KEY_MODES:
        raise ValueError(f"key_mode must be one of {KEY_MODES}")
    keys = {
        "source_location_key": natural_key("source_neighborhood"),
        "destination_location_key": natural_key("destination_neighborhood"),
        "cab_key": surrogate_key(*_CABS),
        "weather_key": weather_key_fact_reference(),
        "datetime_key": natural_key("trip_datetime"),
    }
    return stg.select(*[keys[c].alias(c) if c in keys else F.col(c)
                        for c in FACT_COLUMNS if columns is None or c in columns])


TRIP_DATE = "trip_date"


def _trip_date() -> Column:
    """The calendar date of a trip's wall-clock time; NULL for text that is none."""
    return F.try_to_timestamp(F.col("trip_datetime"), F.lit(DATETIME_FORMAT)).cast("timestamp_ntz").cast("date")


def fact_by_date(stg: DataFrame, key_mode: str = ALIGNED, columns: Sequence[str] | None = None) -> DataFrame:
    """The fact with its trip date, to be written partitioned by ``TRIP_DATE``; ``columns`` (with the id) as in ``fact_trips``."""
    names = fact_trips(stg, key_mode, columns).columns
    # the date goes along the fact's projection as one more column of its input
    keyed = fact_trips(stg.withColumn("trip_id", F.struct("trip_id", _trip_date().alias(TRIP_DATE))), key_mode, columns)
    return keyed.select(F.col("trip_id.trip_id").alias("trip_id"), *[c for c in names if c != "trip_id"],
                        F.col(f"trip_id.{TRIP_DATE}").alias(TRIP_DATE))


def dim_calendar(stg: DataFrame) -> DataFrame:
    """The trips' dates with their calendar parts."""
    dates = stg.select(_trip_date().alias(TRIP_DATE)).where(F.col(TRIP_DATE).isNotNull()).distinct()
    dow = day_name(F.col(TRIP_DATE).cast("timestamp_ntz"))
    return dates.select(TRIP_DATE, F.year(TRIP_DATE).cast("bigint").alias("year"), F.month(TRIP_DATE).cast("bigint").alias("month"),
                        dow.alias("day_of_week"), dow.isin(*WEEKEND_DAYS).alias("is_weekend"))
