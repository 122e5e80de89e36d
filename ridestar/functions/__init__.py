"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from ridestar.functions.keys import natural_key, surrogate_key, weather_key_dim_reference, weather_key_fact_reference
from ridestar.functions.json import json_double, json_long, json_string, parse_payload
from ridestar.functions.numeric import pct, safe_ratio
from ridestar.functions.time import epoch_seconds, minutes_between, ntz_to_instant, instant_to_ntz
from ridestar.functions.clean import clean_csv_value, event_key

__all__ = [
    "natural_key", "surrogate_key", "weather_key_dim_reference", "weather_key_fact_reference",
    "json_double", "json_long", "json_string", "parse_payload",
    "pct", "safe_ratio",
    "epoch_seconds", "minutes_between", "ntz_to_instant", "instant_to_ntz",
    "clean_csv_value", "event_key",
]
