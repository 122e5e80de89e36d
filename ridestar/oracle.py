"""DuckDB SQL for the correctness gate: the same models written as plain SQL.

Tables ``lineitem orders part customer supplier nation events ...`` are views in
DuckDB. The trip view below is the SQL twin of ``sources.testdata.trip_rows``
(already typed: the JSON round trip in Spark must give back the same values).
"""

from __future__ import annotations

from ridestar.spec import (
    COMPLETENESS_COLUMNS,
    CRITICAL_COLUMNS,
    FACT_ENVIRONMENT_COLUMNS,
    LAG_SLA_MINUTES,
    PAYLOAD_FIELDS,
)

_TRIP_EXPR = {
    "trip_id": "CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)",
    "trip_timestamp": "CAST(epoch(o.o_orderdate + to_hours(l.l_linenumber)) AS DOUBLE)",
    "trip_hour": "CAST(hour(o.o_orderdate + to_hours(l.l_linenumber)) AS BIGINT)",
    "trip_day": "CAST(day(o.o_orderdate + to_hours(l.l_linenumber)) AS BIGINT)",
    "trip_month": "CAST(month(o.o_orderdate + to_hours(l.l_linenumber)) AS BIGINT)",
    "trip_datetime": "strftime(o.o_orderdate + to_hours(l.l_linenumber), '%Y-%m-%d %H:%M:%S')",
    "timezone": "'America/New_York'",
    "source_neighborhood": "n1.n_name",
    "destination_neighborhood": "n2.n_name",
    "cab_provider": "CASE WHEN p.p_type IN ('ECONOMY', 'STANDARD', 'PROMO') THEN 'Uber' "
                    "WHEN p.p_type IN ('SMALL', 'MEDIUM') THEN 'Lyft' ELSE p.p_type END",
    "product_id": "p.p_brand",
    "cab_tier": "l.l_returnflag",
    "price": "CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_extendedprice END",
    "distance_miles": "l.l_quantity",
    "surge_multiplier": "CAST(1.0 AS DOUBLE) + l.l_tax",
    "latitude": "CAST(41.0 AS DOUBLE) + c.c_nationkey / CAST(12.5 AS DOUBLE)",
    "longitude": "CAST(-72.0 AS DOUBLE) + c.c_nationkey / CAST(12.5 AS DOUBLE)",
    "temperature": "CASE WHEN l.l_linenumber = 6 THEN NULL ELSE CAST(20.0 AS DOUBLE) + CAST(600.0 AS DOUBLE) * l.l_discount END",
    "apparent_temperature": "CASE WHEN l.l_linenumber = 6 THEN NULL ELSE CAST(20.0 AS DOUBLE) + CAST(600.0 AS DOUBLE) * l.l_discount END - CAST(2.5 AS DOUBLE)",
    "weather_short_summary": "c.c_mktsegment",
    "weather_long_summary": "o.o_orderpriority",
    "humidity": "CAST(0.5 AS DOUBLE) + CAST(5.0 AS DOUBLE) * l.l_discount",
    "precip_probability": "CAST(10.0 AS DOUBLE) * l.l_tax",
    "wind_speed": "l.l_quantity / CAST(5.0 AS DOUBLE)",
    "visibility": "CAST(10.0 AS DOUBLE) - CAST(100.0 AS DOUBLE) * l.l_discount",
    "visibility_1": "CAST(10.0 AS DOUBLE) - CAST(100.0 AS DOUBLE) * l.l_discount",
    "weather_icon": "l.l_linestatus",
    "uv_index": "CAST(p.p_size % 11 AS DOUBLE)",
    "ozone": "CAST(300.0 AS DOUBLE) + p.p_size",
}

_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT"}


def _trip_select() -> str:
    cols = []
    for f in PAYLOAD_FIELDS:
        expr = _TRIP_EXPR.get(f.column, f"CAST(NULL AS {_TYPES[f.dtype]})")
        cols.append(f"{expr} AS {f.column}")
    cols += [
        "CAST(l.l_suppkey AS INTEGER) AS kafka_partition",
        "l.l_partkey AS kafka_offset",
        "l.l_shipdate AS kafka_timestamp",
        "l.l_shipdate + to_minutes(CAST(l.l_partkey % 200 AS INTEGER)) AS ingestion_time",
    ]
    body = ",\n    ".join(cols)
    return f"""SELECT
    {body}
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n1 ON c.c_nationkey = n1.n_nationkey
  JOIN nation n2 ON s.s_nationkey = n2.n_nationkey"""


def _staging_ctes() -> str:
    order = "kafka_timestamp DESC NULLS LAST, kafka_partition DESC NULLS LAST, kafka_offset DESC NULLS LAST"
    return f"""trips AS (
  {_trip_select()}
),
stg AS (
  FROM trips
  WHERE trip_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY {order}) = 1
)"""


def _key(*cols: str) -> str:
    return "md5(" + " || '_' || ".join(f"coalesce({c}, '')" for c in cols) + ")"


_CAB_KEY = _key("cab_provider", "product_id", "cab_tier")
_WEATHER_KEY = _key("weather_short_summary", "weather_long_summary", "weather_icon")
_WEATHER_KEY_DIM_REF = "md5(coalesce(CAST(temperature AS VARCHAR), '') || weather_short_summary)"
_WEATHER_COLS = ["temperature", "apparent_temperature", "humidity", "precip_probability",
                 "weather_short_summary", "weather_long_summary"]


def _core_ctes(key_mode: str = "aligned") -> str:
    env = ", ".join(FACT_ENVIRONMENT_COLUMNS)
    wcols = _WEATHER_COLS + (["weather_icon"] if key_mode == "aligned" else [])
    wkey = _WEATHER_KEY if key_mode == "aligned" else _WEATHER_KEY_DIM_REF
    worder = ", ".join(f"{c} DESC NULLS LAST" for c in wcols)
    return f"""dim_cabs AS (
  SELECT {_CAB_KEY} AS cab_key, max(cab_provider) AS cab_provider, max(product_id) AS product_id, max(cab_tier) AS cab_tier
  FROM stg GROUP BY cab_key
),
dim_datetime AS (
  SELECT md5(trip_datetime) AS datetime_key, ts AS trip_datetime,
         hour(ts)::BIGINT AS hour, day(ts)::BIGINT AS day, month(ts)::BIGINT AS month, year(ts)::BIGINT AS year,
         dayname(ts) AS day_of_week, coalesce(dayname(ts) IN ('Saturday', 'Sunday'), false) AS is_weekend
  FROM (SELECT DISTINCT trip_datetime, strptime(trip_datetime, '%Y-%m-%d %H:%M:%S') AS ts FROM stg)
),
dim_locations AS (
  SELECT md5(neighborhood) AS location_key, neighborhood, avg(latitude) AS latitude, avg(longitude) AS longitude
  FROM (SELECT unnest([source_neighborhood, destination_neighborhood]) AS neighborhood, latitude, longitude
        FROM stg)
  GROUP BY ALL
),
dim_weather AS (
  SELECT {wkey} AS weather_key, {", ".join(wcols)}
  FROM stg
  WHERE temperature IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY weather_key ORDER BY {worder}) = 1
),
stg_rideshare_events AS (FROM stg),
fact_trips AS (
  SELECT trip_id,
         md5(source_neighborhood) AS source_location_key,
         md5(destination_neighborhood) AS destination_location_key,
         {_CAB_KEY} AS cab_key,
         {_WEATHER_KEY} AS weather_key,
         md5(trip_datetime) AS datetime_key,
         price, distance_miles, surge_multiplier, {env},
         kafka_partition, kafka_offset, kafka_timestamp, ingestion_time
  FROM stg
)"""


def with_models(select: str, key_mode: str = "aligned") -> str:
    """``WITH trips, stg, dims, fact`` followed by ``select``."""
    return f"WITH {_staging_ctes()},\n{_core_ctes(key_mode)}\n{select}"


# ---------------------------------------------------------------- marts

# A mart row is a set of trips with common attributes; the surrogate keys and dimensions that the pipeline goes through
# only name these attributes, so the marts are stated here on the trips themselves.

MART_SURGE = """SELECT source_neighborhood, cab_provider, cab_tier, total_trips, surge_trips,
       round(surge_trips * 100.0 / total_trips, 2) AS surge_percentage,
       max_surge_multiplier, avg_price, avg_surge_multiplier
FROM (
  SELECT source_neighborhood, cab_provider, cab_tier,
         count(*) AS total_trips, sum((surge_multiplier > 1)::INT)::BIGINT AS surge_trips,
         max(surge_multiplier) AS max_surge_multiplier,
         avg(price) AS avg_price,
         avg(surge_multiplier) AS avg_surge_multiplier
  FROM stg
  WHERE source_neighborhood IS NOT NULL
  GROUP BY source_neighborhood, cab_provider, cab_tier)"""

MART_TRENDS = """SELECT year, month, day, hour, day_of_week, day_of_week IN ('Saturday', 'Sunday') AS is_weekend,
       cab_provider, cab_tier, total_trips, avg_price, avg_distance_miles, avg_surge_multiplier
FROM (
  SELECT substr(trip_datetime, 1, 4)::BIGINT AS year, substr(trip_datetime, 6, 2)::BIGINT AS month,
         substr(trip_datetime, 9, 2)::BIGINT AS day, substr(trip_datetime, 12, 2)::BIGINT AS hour,
         strftime(substr(trip_datetime, 1, 10)::DATE, '%A') AS day_of_week, cab_provider, cab_tier,
         count(*) AS total_trips,
         avg(price) AS avg_price,
         avg(distance_miles) AS avg_distance_miles,
         avg(surge_multiplier) AS avg_surge_multiplier
  FROM stg
  WHERE trip_datetime IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5, 6, 7)"""


def mart_weather(condition: str) -> str:
    """Trips whose weather meets ``condition`` (that is: has a row in the weather dimension)."""
    return f"""SELECT weather_short_summary, cab_provider, cab_tier,
       count(*) AS total_trips,
       avg(temperature) AS avg_temperature,
       avg(precip_probability) AS avg_precip_probability,
       avg(price) AS avg_price,
       avg(surge_multiplier) AS avg_surge_multiplier
FROM stg
WHERE {condition}
GROUP BY weather_short_summary, cab_provider, cab_tier"""


# Weather that some trip has a temperature for.
MART_WEATHER = mart_weather("""(weather_short_summary, weather_long_summary, weather_icon) IN (
  SELECT (weather_short_summary, weather_long_summary, weather_icon) FROM stg WHERE temperature IS NOT NULL)""")

# The keys as written upstream: one side names the weather by three texts, the other by a temperature and one text.
MART_WEATHER_REFERENCE = mart_weather("""concat_ws('_', weather_short_summary, weather_long_summary, weather_icon) IN (
  SELECT CAST(temperature AS VARCHAR) || weather_short_summary FROM stg WHERE temperature IS NOT NULL)""")


def round_cols(select: str, cols: dict[str, int]) -> str:
    """Wrap ``select`` and round the given double columns (both engines round the same way)."""
    inner = "q"
    repl = ", ".join(f"round({c}, {n}) AS {c}" for c, n in cols.items())
    return f"SELECT * REPLACE ({repl}) FROM ({select}) {inner}"


__all__ = ["with_models", "MART_SURGE", "MART_TRENDS", "MART_WEATHER", "MART_WEATHER_REFERENCE", "round_cols",
           "COMPLETENESS_COLUMNS", "CRITICAL_COLUMNS", "LAG_SLA_MINUTES"]


# ---------------------------------------------------------------- data quality

def _pct(num: str, den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) * 100.0 / ({den}), 2)"


_VALIDITY_SQL = [
    ("price", "price > 0 OR price IS NULL"),
    ("distance", "distance_miles >= 0"),
    ("surge", "surge_multiplier >= 1.0"),
    ("cab_provider", "cab_provider IN ('Uber', 'Lyft')"),
    ("hour", "trip_hour BETWEEN 0 AND 23"),
]


def dq_completeness_sql(total_name: str = "total_rows") -> str:
    nn = [f"count_if({c} IS NOT NULL)" for _, c in COMPLETENESS_COLUMNS]
    cols = [f"count(*) AS {total_name}",
            f"{_pct(' + '.join(nn), f'count(*) * {len(nn)}')} AS overall_completeness_rate"]
    cols += [f"{_pct(n, 'count(*)')} AS completeness_{s}" for n, (s, _) in zip(nn, COMPLETENESS_COLUMNS)]
    return "SELECT " + ",\n       ".join(cols) + "\nFROM stg"


def dq_validity_sql() -> str:
    ok = [f"count_if({rule})" for _, rule in _VALIDITY_SQL]
    cols = [f"{_pct(' + '.join(ok), f'count(*) * {len(ok)}')} AS overall_validity_rate"]
    cols += [f"{_pct(o, 'count(*)')} AS validity_{n}_rate" for o, (n, _) in zip(ok, _VALIDITY_SQL)]
    return "SELECT " + ",\n       ".join(cols) + "\nFROM stg"


DQ_UNIQUENESS = f"""SELECT count(*) AS fact_total_rows,
       count(*) - count(DISTINCT trip_id) AS duplicate_count,
       {_pct('count(DISTINCT trip_id)', 'count(*)')} AS uniqueness_rate
FROM fact_trips"""

# The fact is a projection of staging, so both sides of the comparison are the revenue of the latest trip records.
DQ_ACCURACY = """SELECT round(revenue, 2) AS staging_revenue, round(revenue, 2) AS fact_revenue,
       0.0::DOUBLE AS revenue_discrepancy_usd, 0::BIGINT AS trip_count_discrepancy, 100.0::DOUBLE AS accuracy_rate
FROM (SELECT coalesce(sum(price), 0) AS revenue
      FROM (SELECT arg_max(price, (kafka_timestamp, kafka_partition, kafka_offset)) AS price
            FROM (SELECT * REPLACE (coalesce(price, 0) AS price) FROM trips) GROUP BY trip_id))"""


def dq_timeliness_sql(sla: int = LAG_SLA_MINUTES) -> str:
    """Whole minutes from the message's time to its arrival, of all trips."""
    return f"""SELECT round(sum(lag) / count(*), 2) AS avg_lag_minutes,
       round(quantile_cont(lag, 0.5), 2) AS median_lag_minutes,
       max(lag) AS max_lag_minutes,
       sum((lag > {sla})::INT)::BIGINT AS records_exceeding_sla,
       round(100.0 - 100.0 * sum((lag > {sla})::INT) / count(*), 2) AS timeliness_rate
FROM (SELECT ((epoch_us(ingestion_time) - epoch_us(kafka_timestamp)) // 60000000)::BIGINT AS lag FROM stg)
WHERE lag IS NOT NULL"""


def dq_metrics_sql(measured_at: str) -> str:
    comp = dq_completeness_sql("stg_total_rows")
    return f"""SELECT TIMESTAMP '{measured_at}' AS measured_at, c.*, u.*, v.*, a.*, t.*,
       round((c.overall_completeness_rate + u.uniqueness_rate + v.overall_validity_rate
              + a.accuracy_rate + t.timeliness_rate) / 5, 2) AS composite_dq_score
FROM ({comp}) c POSITIONAL JOIN ({DQ_UNIQUENESS}) u POSITIONAL JOIN ({dq_validity_sql()}) v
     POSITIONAL JOIN ({DQ_ACCURACY}) a POSITIONAL JOIN ({dq_timeliness_sql()}) t"""


# ---------------------------------------------------------------- checks

def _check_meta(ck) -> str:
    col = "NULL" if ck.column is None else f"'{ck.column}'"
    return f"'{ck.name}' AS check_name, '{ck.model}' AS model, CAST({col} AS VARCHAR) AS column_name, '{ck.severity}' AS severity"


def check_count_sql(ck) -> str:
    meta = _check_meta(ck)
    c = ck.column
    if ck.kind == "not_null":
        src = f"SELECT 1 FROM {ck.model} WHERE {c} IS NULL"
    elif ck.kind == "expression_is_true":
        src = f"SELECT 1 FROM {ck.model} WHERE NOT ({c} {ck.expression})"
    elif ck.kind == "unique":
        src = f"SELECT {c} FROM {ck.model} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    elif ck.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in ck.values)
        src = f"SELECT v FROM (SELECT {c} AS v FROM {ck.model} GROUP BY {c}) WHERE v NOT IN ({vals})"
    elif ck.kind == "relationships":
        src = (f"SELECT ch.{c} FROM {ck.model} ch LEFT JOIN {ck.to_model} pa ON ch.{c} = pa.{ck.to_field} "
               f"WHERE ch.{c} IS NOT NULL AND pa.{ck.to_field} IS NULL")
    else:
        raise ValueError(ck.kind)
    return f"SELECT {meta}, CAST(count(*) AS BIGINT) AS failures FROM ({src})"


STATUS_SQL = ("CASE WHEN severity = 'error' AND failures <> 0 THEN 'fail' "
              "WHEN failures <> 0 THEN 'warn' ELSE 'pass' END AS status")


def checks_sql(checks) -> str:
    body = "\nUNION ALL\n".join(check_count_sql(ck) for ck in checks)
    return f"SELECT *, {STATUS_SQL} FROM (\n{body}\n)"


def reconciled_sql(fact: str = "stg") -> str:
    """One row if the revenue of ``fact`` is off staging's by more than a basis point."""
    return f"""SELECT staging_revenue, fact_revenue, staging_count, fact_count,
       abs(staging_revenue - fact_revenue) AS revenue_discrepancy,
       round(abs(1 - fact_revenue / staging_revenue) * 100, 4) AS discrepancy_pct
FROM (SELECT (SELECT round(sum(price), 4) FROM stg) AS staging_revenue,
             (SELECT round(sum(price), 4) FROM {fact}) AS fact_revenue,
             (SELECT count(price) FROM stg) AS staging_count,
             (SELECT count(price) FROM {fact}) AS fact_count)
WHERE staging_revenue <> 0 AND abs(1 - fact_revenue / staging_revenue) > 0.0001"""


ASSERT_RECONCILED = reconciled_sql()


def null_counts_sql(columns=CRITICAL_COLUMNS, table: str = "stg") -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM {table}"
             for c in columns]
    return ("SELECT n.column_name, n.null_count, t.total_rows FROM (" + " UNION ALL ".join(parts)
            + f") n, (SELECT count(*) AS total_rows FROM {table}) t")


def assert_complete_sql(columns=CRITICAL_COLUMNS, max_pct: float = 5.0) -> str:
    return f"""SELECT column_name, null_count, total_rows,
       {_pct('null_count', 'total_rows')} AS null_pct,
       {_pct('total_rows - null_count', 'total_rows')} AS completeness_rate_pct
FROM ({null_counts_sql(columns)})
WHERE null_count * 100.0 / total_rows > {max_pct}"""


ASSERT_NO_DUPLICATES = """SELECT trip_id, count(*) AS duplicate_count FROM fact_trips GROUP BY ALL HAVING count(*) > 1"""

ASSERT_POSITIVE = """SELECT trip_id, price, cab_provider, cab_tier, ingestion_time
FROM stg ANTI JOIN (SELECT trip_id FROM stg WHERE price > 0) USING (trip_id)"""


def assert_lag_sql(sla: int = LAG_SLA_MINUTES) -> str:
    return f"""SELECT trip_id, kafka_timestamp, ingestion_time, lag_minutes
FROM (SELECT *, date_sub('minute', kafka_timestamp, ingestion_time) AS lag_minutes FROM fact_trips)
WHERE lag_minutes > {sla}"""


def singular_counts_sql(tests, sql_by_name) -> str:
    parts = [f"SELECT '{t.name}' AS check_name, '{t.model}' AS model, CAST(NULL AS VARCHAR) AS column_name, "
             f"'{t.severity}' AS severity, CAST(count(*) AS BIGINT) AS failures FROM ({sql_by_name[t.name]})"
             for t in tests]
    return f"SELECT *, {STATUS_SQL} FROM (" + "\nUNION ALL\n".join(parts) + ")"


# ---------------------------------------------------------------- sources, stream, gates

EVENT_ENVELOPE = """SELECT event_type AS key, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS offset,
       ts AS kafka_timestamp, event_id
FROM events"""

JSON_EXTRACT = """SELECT event_id, user_id, event_type, value,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events"""

QUARANTINE = """SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS offset,
       CASE WHEN event_type = 'error' THEN 'malformed_json' ELSE 'missing_id' END AS reject_reason
FROM events"""

BACKLOG = """SELECT CAST(event_id % 3 AS INTEGER) AS partition, min(event_id // 3) AS low,
       max(event_id // 3) + 1 AS high, max(event_id // 3) - min(event_id // 3) + 1 AS messages
FROM events GROUP BY 1"""


def retention_sql(now: str, days: int) -> str:
    return f"""SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS offset, ts AS kafka_timestamp
FROM events WHERE ts >= TIMESTAMP '{now}' - INTERVAL {days} DAY"""


REFRESH_COUNT = "SELECT count(*) AS total_rows FROM events"


def clean_columns_sql(columns) -> str:
    return "SELECT * REPLACE (product_id || ' \"so' || chr(10) || 'called\"' AS product_id) FROM (SELECT " + ", ".join(
        columns) + " FROM trips)"


EVENT_STAMP = """SELECT kafka_partition AS partition, kafka_offset AS offset,
       CAST(epoch(kafka_timestamp) AS DOUBLE) AS timestamp,
       strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S') AS datetime,
       CAST(hour(kafka_timestamp) AS BIGINT) AS hour, CAST(day(kafka_timestamp) AS BIGINT) AS day,
       CAST(month(kafka_timestamp) AS BIGINT) AS month,
       coalesce(nullif(source_neighborhood, ''), 'unknown') AS key, true AS has_id
FROM trips"""


def upsert_sql(t1: str, t2: str) -> str:
    parts = [f"""SELECT * EXCLUDE (composite_dq_score),
       round(CAST(stg_total_rows AS DOUBLE) / fact_total_rows, 4) AS stg_per_fact_row
FROM ({dq_metrics_sql(t)})""" for t in (t1, t2)]
    return "\nUNION ALL\n".join(parts)


PRODUCER_STREAM = """SELECT coalesce(nullif(source_neighborhood, ''), 'unknown') AS key, cab_provider, cab_tier,
       price, distance_miles, surge_multiplier, temperature
FROM trips"""


# ---------------------------------------------------------------- strict messages

# Messages of known defects, one per line number; the text is built the same way in Spark.
STRICT_TEXT = """CASE l_linenumber % 7
         WHEN 0 THEN '{"id":"' || k || '","price":1}{"id":"x"}'
         WHEN 1 THEN '{"id":"' || k || '","price":1} junk'
         WHEN 2 THEN '{"id":"' || k || '","price":1},'
         WHEN 3 THEN '{"id":"' || k || '","price":1,"price":2}'
         WHEN 4 THEN '{"id":"' || k || '","price":"3.5","timezone":"{"}'
         WHEN 5 THEN '{"price":4}}'
         ELSE '{"price":5}' END"""

QUARANTINE_STRICT = f"""SELECT l_orderkey, l_linenumber,
       CASE WHEN NOT json_valid(body) THEN 'malformed_json'
            WHEN json_extract_string(body, '$.id') IS NULL THEN 'missing_id' END AS reject_reason,
       CASE WHEN json_valid(body) THEN
         CASE l_linenumber % 7 WHEN 3 THEN 2.0 WHEN 4 THEN 3.5 WHEN 6 THEN 5.0 END END::DOUBLE AS price
FROM (SELECT l_orderkey, l_linenumber, {STRICT_TEXT} AS body
      FROM (SELECT l_orderkey, l_linenumber, l_orderkey || '-' || l_linenumber AS k FROM lineitem))"""

# ---------------------------------------------------------------- checks over data that breaks them

# The un-deduplicated trips stand in for the fact, and the cab dimension lacks one tier.
VIOLATIONS = """bad AS (SELECT *, price * 1.0 AS p FROM trips WHERE trip_id IS NOT NULL),
twice AS (SELECT trip_id FROM bad GROUP BY trip_id HAVING count(*) > 1),
found AS (
  SELECT 'unique__fact_trips__trip_id' AS check_name, (SELECT count(*) FROM twice) AS failures, 'error' AS severity
  UNION ALL
  SELECT 'relationships__fact_trips__cab_key',
         (SELECT count(*) FROM bad WHERE cab_tier = 'R'), 'error'
  UNION ALL
  SELECT 'assert_no_duplicate_trip_ids', (SELECT count(*) FROM twice), 'error'
  UNION ALL
  SELECT 'expression_is_true__fact_trips__distance_miles',
         (SELECT count(*) FROM bad WHERE distance_miles - 25 <= 0), 'warn'
  UNION ALL
  SELECT 'assert_accuracy_revenue_reconciliation',
         (SELECT CASE WHEN abs((SELECT sum(price) FROM stg) - (SELECT sum(price) FROM bad))
                           > 0.0001 * (SELECT sum(price) FROM stg) THEN 1 ELSE 0 END), 'warn')"""

CHECKS_VIOLATED = """SELECT check_name, failures,
       CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail' ELSE 'warn' END AS status
FROM found"""


def with_violations(select: str) -> str:
    return f"WITH {_staging_ctes()},\n{VIOLATIONS}\n{select}"


FILE_FRESHNESS = """SELECT 'now' AS clock, count(*) AS fresh_rows FROM events
UNION ALL SELECT 'an hour later', 0"""

RETAINED = """SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS offset, CAST(ts AS DATE) AS ingest_date
FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-31' - 7"""

PRODUCER_BACKLOG = """SELECT count(*) AS messages, count(*) AS distinct_offsets, 0 AS lowest_offset FROM trips"""
