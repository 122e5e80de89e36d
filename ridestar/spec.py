"""Column specs and fixed values the results depend on.

Everything here is a fixed value that must equal the pipeline we reproduce:
payload keys, staging names and types, accepted values and thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass

STRING = "string"
DOUBLE = "double"
LONG = "bigint"


@dataclass(frozen=True)
class Field:
    key: str      # key in the JSON payload (= CSV header name)
    column: str   # staging column name
    dtype: str    # STRING, DOUBLE or LONG


# --- fixed values: payload key, staging column, type (natural order of the staging model) ---
PAYLOAD_FIELDS: tuple[Field, ...] = (
    Field("id", "trip_id", STRING),
    Field("timestamp", "trip_timestamp", DOUBLE),
    Field("hour", "trip_hour", LONG),
    Field("day", "trip_day", LONG),
    Field("month", "trip_month", LONG),
    Field("datetime", "trip_datetime", STRING),
    Field("timezone", "timezone", STRING),
    Field("source", "source_neighborhood", STRING),
    Field("destination", "destination_neighborhood", STRING),
    Field("cab_type", "cab_provider", STRING),
    Field("product_id", "product_id", STRING),
    Field("name", "cab_tier", STRING),
    Field("price", "price", DOUBLE),
    Field("distance", "distance_miles", DOUBLE),
    Field("surge_multiplier", "surge_multiplier", DOUBLE),
    Field("latitude", "latitude", DOUBLE),
    Field("longitude", "longitude", DOUBLE),
    Field("temperature", "temperature", DOUBLE),
    Field("apparentTemperature", "apparent_temperature", DOUBLE),
    Field("short_summary", "weather_short_summary", STRING),
    Field("long_summary", "weather_long_summary", STRING),
    Field("precipIntensity", "precip_intensity", DOUBLE),
    Field("precipProbability", "precip_probability", DOUBLE),
    Field("humidity", "humidity", DOUBLE),
    Field("windSpeed", "wind_speed", DOUBLE),
    Field("windGust", "wind_gust", DOUBLE),
    Field("windGustTime", "wind_gust_time", DOUBLE),
    Field("visibility", "visibility", DOUBLE),
    Field("visibility.1", "visibility_1", DOUBLE),
    Field("icon", "weather_icon", STRING),
    Field("dewPoint", "dew_point", DOUBLE),
    Field("pressure", "pressure", DOUBLE),
    Field("windBearing", "wind_bearing", DOUBLE),
    Field("cloudCover", "cloud_cover", DOUBLE),
    Field("uvIndex", "uv_index", DOUBLE),
    Field("uvIndexTime", "uv_index_time", DOUBLE),
    Field("ozone", "ozone", DOUBLE),
    Field("temperatureHigh", "temp_high", DOUBLE),
    Field("temperatureHighTime", "temp_high_time", DOUBLE),
    Field("temperatureLow", "temp_low", DOUBLE),
    Field("temperatureLowTime", "temp_low_time", DOUBLE),
    Field("temperatureMin", "temp_min", DOUBLE),
    Field("temperatureMinTime", "temp_min_time", DOUBLE),
    Field("temperatureMax", "temp_max", DOUBLE),
    Field("temperatureMaxTime", "temp_max_time", DOUBLE),
    Field("apparentTemperatureHigh", "apparent_temp_high", DOUBLE),
    Field("apparentTemperatureHighTime", "apparent_temp_high_time", DOUBLE),
    Field("apparentTemperatureLow", "apparent_temp_low", DOUBLE),
    Field("apparentTemperatureLowTime", "apparent_temp_low_time", DOUBLE),
    Field("apparentTemperatureMin", "apparent_temp_min", DOUBLE),
    Field("apparentTemperatureMinTime", "apparent_temp_min_time", DOUBLE),
    Field("apparentTemperatureMax", "apparent_temp_max", DOUBLE),
    Field("apparentTemperatureMaxTime", "apparent_temp_max_time", DOUBLE),
    Field("sunriseTime", "sunrise_time", DOUBLE),
    Field("sunsetTime", "sunset_time", DOUBLE),
    Field("moonPhase", "moon_phase", DOUBLE),
    Field("precipIntensityMax", "precip_intensity_max", DOUBLE),
)

# Kafka envelope metadata carried into staging: (bronze column, staging column, type).
METADATA_COLUMNS: tuple[tuple[str, str, str], ...] = (
    ("partition", "kafka_partition", "int"),
    ("offset", "kafka_offset", "bigint"),
    ("kafka_timestamp", "kafka_timestamp", "timestamp"),
    ("ingestion_time", "ingestion_time", "timestamp"),
)

STAGING_COLUMNS: tuple[str, ...] = tuple(f.column for f in PAYLOAD_FIELDS) + tuple(
    m[1] for m in METADATA_COLUMNS
)

# Bronze archive columns (Kafka envelope decoded + ingestion stamp).
BRONZE_COLUMNS: tuple[str, ...] = ("key", "value", "partition", "offset", "kafka_timestamp", "ingestion_time")

# --- fixed values: CSV cleaning ---
NA_TOKENS: tuple[str, ...] = ("NA", "NaN", "")
INT_CSV_COLUMNS: tuple[str, ...] = ("hour", "day", "month")
# CSV columns that carry text (kept as trimmed strings); every other column is numeric.
TEXT_CSV_COLUMNS: tuple[str, ...] = tuple(
    f.key for f in PAYLOAD_FIELDS if f.dtype == STRING and f.key not in ("id", "datetime")
) + ("datetime",)

# --- fixed values: quality rules ---
VALID_PROVIDERS: tuple[str, ...] = ("Uber", "Lyft")
WEEKEND_DAYS: tuple[str, ...] = ("Saturday", "Sunday")
WEEK_DAYS: tuple[str, ...] = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
LAG_SLA_MINUTES = 120
RECONCILE_TOLERANCE = 0.0001          # 0.01 %: 1 basis point
COMPLETENESS_FAIL_PCT = 5.0
FRESHNESS_MINUTES = 15
MIN_BACKLOG_MESSAGES = 100
TOPIC_PARTITIONS = 3
TOPIC_RETENTION_DAYS = 7
DEAD_LETTER_RETENTION_DAYS = 30
FILE_RETENTION_DAYS = 30

# Columns of the completeness dimension of the quality mart (mart name suffix, column).
COMPLETENESS_COLUMNS: tuple[tuple[str, str], ...] = (
    ("trip_id", "trip_id"),
    ("price", "price"),
    ("distance", "distance_miles"),
    ("cab_provider", "cab_provider"),
    ("cab_tier", "cab_tier"),
    ("source_nbhd", "source_neighborhood"),
    ("surge", "surge_multiplier"),
)

# Columns of the critical-field completeness test (null share over 5 % fails).
CRITICAL_COLUMNS: tuple[str, ...] = (
    "price",
    "distance_miles",
    "cab_provider",
    "cab_tier",
    "source_neighborhood",
    "destination_neighborhood",
    "surge_multiplier",
)

FACT_ENVIRONMENT_COLUMNS: tuple[str, ...] = (
    "temperature",
    "apparent_temperature",
    "precip_intensity",
    "precip_probability",
    "humidity",
    "wind_speed",
    "wind_gust",
    "visibility",
    "visibility_1",
    "uv_index",
    "ozone",
)
