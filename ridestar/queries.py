"""Registered queries: one per operator/model, each with its DuckDB twin where SQL can say it.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame built from the whole tables under
``sf_dir``. Queries with one consumer of staging are lazy. Those whose models read staging several times, and
those that show a sink or a stream, first write what they read, as the pipeline does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridestar import oracle as O
from ridestar.functions.keys import natural_key, surrogate_key
from ridestar.functions.time import instant_to_ntz
from ridestar.operators.combine import combine_single_rows
from ridestar.operators.dedup import dedup_latest
from ridestar.plans import core, marts, staging
from ridestar.session import ensure_utc, freeing_shuffles, scratch_path
from ridestar.sources import testdata
from ridestar.spec import STAGING_COLUMNS

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

AVG_DECIMALS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def stable(df: DataFrame, round_cols: dict[str, int] | None = None) -> DataFrame:
    """Instants as UTC wall clock (timestamp_ntz) and the named doubles rounded."""
    round_cols = round_cols or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = instant_to_ntz(c)
        elif f.name in round_cols:
            c = F.round(c, round_cols[f.name])
        out.append(c.alias(f.name))
    return df.select(*out)


# ------------------------------------------------------------------ model chain

def staged(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Staging over all messages; ``columns``: those a query reads (None: all)."""
    ensure_utc(spark)
    return staging.stg_events(testdata.trip_bronze(spark, sf_dir), columns)


def _inputs(need: Mapping[str, Sequence[str] | None]) -> list[str] | None:
    """Staging columns that the needed models are made of; None: all."""
    if "stg" in need and need["stg"] is None:
        return None
    read = list(need.get("stg", ()))
    if "fact_trips" in need:
        read += core.fact_inputs(need["fact_trips"])
    return read + [c for name, columns in core.DIM_INPUTS.items() if name in need for c in columns]


_WHOLE_STAR = {"stg": None, "fact_trips": None, **dict.fromkeys(core.DIM_INPUTS)}


def star(spark: SparkSession, sf_dir: str, key_mode: str = core.ALIGNED, write: bool = True,
         need: Mapping[str, Sequence[str] | None] = _WHOLE_STAR) -> dict[str, DataFrame]:
    """The star schema over staging.

    ``need``: the models a query reads, with the columns it reads of staging and the fact (None: all; dimensions are
    whole). Payload fields that none of them is made of are not converted, shuffled or written.

    ``write``: staging is written as Parquet in the shared folder and read back, as the pipeline does, for queries
    whose models read it several times: each then reads its own columns only, and the payload is
    parsed once. Without it the models are lazy, for a single consumer.
    """
    from ridestar.sources.tables import write_table

    stg = staged(spark, sf_dir, _inputs(need))
    if write:
        stg = write_table(stg, scratch_path(spark, "staging"))
    return {"stg": stg} | _models_of(stg, key_mode, need)


def _models_of(stg: DataFrame, key_mode: str, need: Mapping[str, Sequence[str] | None]) -> dict[str, DataFrame]:
    models = {
        "dim_cabs": lambda: core.dim_cabs(stg),
        "dim_datetime": lambda: core.dim_datetime(stg),
        "dim_locations": lambda: core.dim_locations(stg),
        "dim_weather": lambda: core.dim_weather(stg, key_mode),
        "fact_trips": lambda: core.fact_trips(stg, key_mode, need["fact_trips"]),
    }
    return {name: model() for name, model in models.items() if name in need}


# ------------------------------------------------------------------ marts

_SURGE_ROUND = {"avg_price": AVG_DECIMALS, "avg_surge_multiplier": AVG_DECIMALS}
_TRENDS_ROUND = {"avg_price": AVG_DECIMALS, "avg_distance_miles": AVG_DECIMALS, "avg_surge_multiplier": AVG_DECIMALS}
_WEATHER_ROUND = {"avg_temperature": AVG_DECIMALS, "avg_precip_probability": AVG_DECIMALS,
                  "avg_price": AVG_DECIMALS, "avg_surge_multiplier": AVG_DECIMALS}
_WEATHER_NEED = {"fact_trips": ("trip_id", "weather_key", "cab_key", "price", "surge_multiplier", "temperature", "precip_probability"),
                 "dim_weather": None, "dim_cabs": None}


@register("mart_surge_analysis", O.with_models(O.round_cols(O.MART_SURGE, _SURGE_ROUND)))
def mart_surge_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = star(spark, sf_dir, need={"fact_trips": ("trip_id", "source_location_key", "cab_key", "price", "surge_multiplier"),
                                  "dim_locations": None, "dim_cabs": None})
    out = marts.mart_surge_analysis(m["fact_trips"], m["dim_locations"], m["dim_cabs"])
    return stable(out, _SURGE_ROUND)


@register("mart_trip_trends", O.with_models(O.round_cols(O.MART_TRENDS, _TRENDS_ROUND)))
def mart_trip_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = star(spark, sf_dir, need={
        "fact_trips": ("trip_id", "datetime_key", "cab_key", "price", "distance_miles", "surge_multiplier"),
        "dim_datetime": None, "dim_cabs": None})
    out = marts.mart_trip_trends(m["fact_trips"], m["dim_datetime"], m["dim_cabs"])
    return stable(out, _TRENDS_ROUND)


@register("mart_weather_impact", O.with_models(O.round_cols(O.MART_WEATHER, _WEATHER_ROUND)))
def mart_weather_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = star(spark, sf_dir, need=_WEATHER_NEED)
    out = marts.mart_weather_impact(m["fact_trips"], m["dim_weather"], m["dim_cabs"])
    return stable(out, _WEATHER_ROUND)


@register("mart_weather_impact_reference",
          O.with_models(O.round_cols(O.MART_WEATHER_REFERENCE, _WEATHER_ROUND)))
def mart_weather_impact_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather mart with both weather keys as written upstream: they never match, so 0 rows."""
    m = star(spark, sf_dir, core.REFERENCE, need=_WEATHER_NEED)
    out = marts.mart_weather_impact(m["fact_trips"], m["dim_weather"], m["dim_cabs"])
    return stable(out, _WEATHER_ROUND)


_DAILY_ROUND = {"avg_price": AVG_DECIMALS, "avg_distance_miles": AVG_DECIMALS}


@register("mart_daily_trends", O.with_models(O.round_cols(
    "SELECT year(d) AS year, month(d) AS month, dayname(d) AS day_of_week, TRUE AS is_weekend, count(*) AS total_trips, "
    "avg(price) AS avg_price, avg(distance_miles) AS avg_distance_miles "
    "FROM (SELECT *, substr(trip_datetime, 1, 10)::DATE AS d FROM stg) "
    "WHERE dayname(d) IN ('Saturday', 'Sunday') AND year(d) = 1996 GROUP BY ALL", _DAILY_ROUND)))
def mart_daily_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekend trips of a year over a fact partitioned by date; the calendar prunes the partitions that are read."""
    from ridestar.sources.tables import write_table

    read = ("trip_id", "price", "distance_miles")
    stg = write_table(staged(spark, sf_dir, [*core.fact_inputs(read), "trip_datetime"]), scratch_path(spark, "staging"))
    by_date = core.fact_by_date(stg, columns=read)
    fact = write_table(by_date.repartition(core.TRIP_DATE), scratch_path(spark, "fact"), partition_by=[core.TRIP_DATE])
    calendar = write_table(core.dim_calendar(stg), scratch_path(spark, "calendar"))
    return stable(marts.mart_daily_trends(fact, calendar.where("is_weekend AND year = 1996")), _DAILY_ROUND)


# ------------------------------------------------------------------ core models

def _dim(spark: SparkSession, sf_dir: str, name: str, key_mode: str = core.ALIGNED) -> DataFrame:
    return star(spark, sf_dir, key_mode, write=False, need={name: None})[name]


def _fact(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    return star(spark, sf_dir, write=False, need={"fact_trips": columns})["fact_trips"]


@register("dim_cabs", O.with_models("SELECT * FROM dim_cabs"))
def dim_cabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(_dim(spark, sf_dir, "dim_cabs"))


@register("dim_datetime", O.with_models("SELECT * FROM dim_datetime"))
def dim_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(_dim(spark, sf_dir, "dim_datetime"))


@register("dim_locations", O.with_models(O.round_cols("SELECT * FROM dim_locations",
                                                      {"latitude": AVG_DECIMALS, "longitude": AVG_DECIMALS})))
def dim_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(_dim(spark, sf_dir, "dim_locations"), {"latitude": AVG_DECIMALS, "longitude": AVG_DECIMALS})


@register("dim_weather", O.with_models("SELECT * FROM dim_weather"))
def dim_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(_dim(spark, sf_dir, "dim_weather"))


@register("dim_weather_reference", O.with_models("SELECT * FROM dim_weather", key_mode="reference"))
def dim_weather_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(_dim(spark, sf_dir, "dim_weather", core.REFERENCE))


@register("fact_trips", O.with_models("SELECT * FROM fact_trips"))
def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(_fact(spark, sf_dir))


@register("stg_parse", O.with_models("SELECT * FROM stg"))
def stg_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging from bronze JSON: parse, id filter, latest per trip (JSON round trip of trip rows)."""
    return stable(staged(spark, sf_dir))


#: Messages are long texts, half as large as with the default codec.
TOPIC_CODEC = "zstd"


def _numbered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Trip messages with dense offsets, written once (and where): increments of them are parts of one topic."""
    from ridestar.sources.tables import write_table

    ensure_utc(spark)
    path = scratch_path(spark, "topic")
    return write_table(testdata.trip_topic(spark, sf_dir), path, compression=TOPIC_CODEC), path


@register("stg_incremental", O.with_models("SELECT * FROM stg"))
def stg_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging merged from increments, later messages first, some of them repeated, one empty: equal to the full run."""
    from ridestar.plans.silver import Silver
    from ridestar.sources.tables import drop_path, write_table

    ensure_utc(spark)
    # messages of one partition and offset are in the same increments, so their own offsets tell which are repeated
    path = scratch_path(spark, "topic")
    topic = write_table(testdata.trip_bronze(spark, sf_dir), path, compression=TOPIC_CODEC)
    late = F.coalesce(F.col("offset") % 2 == 0, F.lit(False))
    table = Silver(spark, scratch_path(spark, "silver"))
    for part in (topic.where(late), topic.where(~late | (F.col("partition") % 3 == 0)), topic.where("false")):
        table.merge(part)
    drop_path(spark, path)
    return stable(table.read())


@register("stg_stream", O.with_models("SELECT * EXCLUDE (kafka_offset, ingestion_time) FROM stg"))
def stg_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging merged by a stream, a micro-batch a file; the stream is started twice. Ingestion times are the run's own."""
    from ridestar.plans.silver import Silver
    from ridestar.sources.kafka import read_event_files
    from ridestar.sources.tables import drop_path, write_table
    from ridestar.streaming.silver_job import start_silver

    source, base, checkpoint = (scratch_path(spark, n) for n in ("messages", "silver", "checkpoint"))
    topic, path = _numbered(spark, sf_dir)
    messages = topic.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit("trips").alias("topic"),
        "partition", "offset", F.col("kafka_timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))
    # three files; a topic read by three tasks or more is not shuffled for them
    messages = messages.coalesce(3) if messages.rdd.getNumPartitions() >= 3 else messages.repartition(3)
    write_table(messages, source, compression=TOPIC_CODEC)
    drop_path(spark, path)
    for _ in range(2):
        start_silver(read_event_files(spark, source, 1), base, checkpoint).awaitTermination()
    drop_path(spark, source)
    return stable(Silver(spark, base).read().drop("kafka_offset", "ingestion_time"))


@register("new_trips", O.with_models(
    "SELECT trip_id, NOT bool_or(kafka_timestamp < TIMESTAMP '1995-06-01') AS is_new FROM trips "
    "GROUP BY trip_id HAVING bool_or(kafka_timestamp >= TIMESTAMP '1995-06-01')"))
def new_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a later increment against the filters of an earlier one: those without a hit are new, hits are looked up."""
    from ridestar.plans.silver import PART, filter_hits, id_filters
    from ridestar.sources.tables import write_table

    ensure_utc(spark)
    rows = testdata.trip_rows(spark, sf_dir).select(
        F.col("id").alias("trip_id"), "kafka_timestamp", F.pmod(F.xxhash64("id"), F.lit(16)).cast("int").alias("bucket"))
    rows = write_table(rows, scratch_path(spark, "ids"))
    before = instant_to_ntz("kafka_timestamp") < F.lit("1995-06-01").cast("timestamp_ntz")
    old, ids = (rows.where(c).select("trip_id", "bucket").distinct() for c in (before, ~before))
    filters = write_table(id_filters(old).withColumn(PART, F.lit("old")), scratch_path(spark, "filters"))
    hits = filter_hits(ids, filters)
    known = old.join(hits.select("trip_id"), "trip_id", "left_semi").select("trip_id", F.lit(True).alias("known"))
    return ids.join(known, "trip_id", "left").select("trip_id", F.col("known").isNull().alias("is_new"))


# ------------------------------------------------------------------ single operators

@register("dedup_latest", O.with_models(
    "SELECT trip_id, kafka_timestamp, kafka_partition, kafka_offset, price FROM stg"))
def dedup_latest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row per trip id on typed rows (no JSON), total order timestamp > partition > offset."""
    ensure_utc(spark)
    rows = testdata.trip_rows(spark, sf_dir).select(
        F.col("id").alias("trip_id"), "kafka_timestamp", F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"), "price")
    out = dedup_latest(rows, ["trip_id"], ["kafka_timestamp", "kafka_partition", "kafka_offset"])
    return stable(out)


@register("surrogate_key", O.with_models(
    "SELECT trip_id, kafka_partition, kafka_offset, "
    "md5(coalesce(cab_provider, '') || '_' || coalesce(product_id, '') || '_' || coalesce(cab_tier, '')) AS cab_key, "
    "md5(source_neighborhood) AS source_location_key FROM trips"))
def surrogate_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md5 surrogate (NULL-safe, '_'-joined) and natural keys on every trip event."""
    ensure_utc(spark)
    rows = testdata.trip_rows(spark, sf_dir)
    return rows.select(
        F.col("id").alias("trip_id"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        surrogate_key("cab_type", "product_id", "name").alias("cab_key"),
        natural_key("source").alias("source_location_key"),
    )


# ------------------------------------------------------------------ data quality

from ridestar.plans import quality  # noqa: E402

MEASURED_AT = "2024-01-01 00:00:00"
_QUALITY_NEED = {"stg": quality.STAGING_READS, "fact_trips": quality.FACT_READS}
_REVENUE_ROUND = {"staging_revenue": 2, "fact_revenue": 2, "revenue_discrepancy_usd": 2}


@register("dq_completeness", O.with_models(O.dq_completeness_sql()))
def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.completeness(staged(spark, sf_dir, quality.STAGING_READS))


@register("dq_uniqueness", O.with_models(O.DQ_UNIQUENESS))
def dq_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.uniqueness(_fact(spark, sf_dir, ["trip_id"]))


@register("dq_validity", O.with_models(O.dq_validity_sql()))
def dq_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validity(staged(spark, sf_dir, quality.STAGING_READS))


@register("dq_accuracy", O.with_models(O.DQ_ACCURACY))
def dq_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = star(spark, sf_dir, need=_QUALITY_NEED)
    return stable(quality.accuracy(m["stg"], m["fact_trips"]), _REVENUE_ROUND)


@register("dq_timeliness", O.with_models(O.dq_timeliness_sql()))
def dq_timeliness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.timeliness(_fact(spark, sf_dir, quality.FACT_READS))


@register("dq_metrics", O.with_models(O.dq_metrics_sql(MEASURED_AT)))
def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole quality mart row at a fixed ``measured_at``."""
    import datetime as _dt

    m = star(spark, sf_dir, need=_QUALITY_NEED)
    at = _dt.datetime.fromisoformat(MEASURED_AT)
    out = quality.dq_metrics(m["stg"], m["fact_trips"], at)
    return stable(out, _REVENUE_ROUND)


@register("dq_metrics_states", O.with_models(O.dq_metrics_sql(MEASURED_AT)))
def dq_metrics_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality mart merged from the partial states of three increments; no row of staging is read for it."""
    import datetime as _dt

    from ridestar.plans.silver import Silver
    from ridestar.sources.tables import drop_path

    topic, path = _numbered(spark, sf_dir)
    table = Silver(spark, scratch_path(spark, "silver"))
    year = F.year(instant_to_ntz("ingestion_time"))
    for part in (year < 1994, year >= 1996, year.between(1994, 1995)):
        table.merge(topic.where(part))
    drop_path(spark, path)
    return stable(table.metrics(_dt.datetime.fromisoformat(MEASURED_AT)), _REVENUE_ROUND)


# ------------------------------------------------------------------ checks

from ridestar.operators.reshape import null_counts as _null_counts  # noqa: E402
from ridestar.plans import checks as C  # noqa: E402
from ridestar.spec import CRITICAL_COLUMNS  # noqa: E402


def models(spark: SparkSession, sf_dir: str, checks: Sequence[C.Check] = C.DECLARED_CHECKS,
           tests: Sequence[C.SingularTest] = C.SINGULAR_TESTS) -> dict[str, DataFrame]:
    """The models with what counting the failures of these checks reads."""
    read = C.columns_read(checks, tests)
    m = star(spark, sf_dir, need={"stg" if name == C.STG else name: columns for name, columns in read.items()})
    m[C.STG] = m["stg"]
    return m


def _of_kind(*kinds: str) -> list:
    return [ck for ck in C.DECLARED_CHECKS if ck.kind in kinds]


def _register_checks(name: str, kinds: tuple[str, ...]) -> None:
    cks = _of_kind(*kinds)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return C.check_counts(models(spark, sf_dir, cks, ()), cks)

    run.__doc__ = f"Declared {', '.join(kinds)} checks: failures and status per check."
    register(name, O.with_models(O.checks_sql(cks)))(run)


_register_checks("check_not_null", ("not_null",))
_register_checks("check_unique", ("unique",))
_register_checks("check_accepted_values", ("accepted_values",))
_register_checks("check_relationships", ("relationships",))
_register_checks("check_expression", ("expression_is_true",))

_SINGULAR_SQL = {
    "assert_accuracy_revenue_reconciliation": O.ASSERT_RECONCILED,
    "assert_completeness_critical_fields": O.assert_complete_sql(),
    "assert_no_duplicate_trip_ids": O.ASSERT_NO_DUPLICATES,
    "assert_price_positive": O.ASSERT_POSITIVE,
    "assert_timeliness_ingestion_lag": O.assert_lag_sql(),
}


@register("assert_reconciled", O.with_models(O.ASSERT_RECONCILED))
def assert_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = star(spark, sf_dir, need={"stg": ["price"], "fact_trips": ["price"]})
    return C.assert_reconciled(m["stg"], m["fact_trips"])


@register("assert_complete", O.with_models(O.assert_complete_sql()))
def assert_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.assert_complete(staged(spark, sf_dir, CRITICAL_COLUMNS))


@register("assert_no_duplicates", O.with_models(O.ASSERT_NO_DUPLICATES))
def assert_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.assert_no_duplicates(_fact(spark, sf_dir, ["trip_id"]))


@register("assert_positive", O.with_models(O.ASSERT_POSITIVE))
def assert_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(C.assert_positive(staged(spark, sf_dir, C.POSITIVE_COLUMNS)))


@register("assert_lag", O.with_models(O.assert_lag_sql()))
def assert_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable(C.assert_lag(_fact(spark, sf_dir, C.LAG_COLUMNS)))


@register("null_counts", O.with_models(O.null_counts_sql()))
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL count per critical column and the row count, from one scan (unpivoted)."""
    return _null_counts(staged(spark, sf_dir, CRITICAL_COLUMNS), CRITICAL_COLUMNS)


_ALL_CHECKS_SQL = (O.checks_sql(C.DECLARED_CHECKS) + "\nUNION ALL\n"
                   + O.singular_counts_sql(C.SINGULAR_TESTS, _SINGULAR_SQL))


@register("check_results", O.with_models(_ALL_CHECKS_SQL))
def check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 58 declared checks and 5 singular tests: failures, severity, status."""
    return C.run_checks(models(spark, sf_dir))


@register("check_results_observed", O.with_models(_ALL_CHECKS_SQL))
def check_results_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks, the row-level ones counted by the jobs that write the models."""
    from ridestar.sources.tables import write_table

    seen = C.Observed(C.DECLARED_CHECKS, C.SINGULAR_TESTS)
    # staging is counted by the job that makes it, and written once
    stg = write_table(seen.watch(C.STG, staged(spark, sf_dir)), scratch_path(spark, "staging"))
    m = _models_of(stg, core.ALIGNED, _WHOLE_STAR)
    kept = {C.STG: stg} | {n: write_table(seen.watch(n, m[n]), scratch_path(spark, n)) for n in m}
    return C.run_checks(kept, counted=seen.counts())


@register("verdict", O.with_models(
    "SELECT severity, status, count(*) AS checks, CAST(coalesce(sum(failures), 0) AS BIGINT) AS failing_rows "
    f"FROM ({_ALL_CHECKS_SQL}) GROUP BY severity, status"))
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results grouped by severity and status (the run's pass/fail verdict)."""
    return C.verdict(C.run_checks(models(spark, sf_dir)))


def violating_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Models that break their checks: un-deduplicated trips as fact (25 miles short), cabs without one tier."""
    from ridestar.sources.tables import write_table

    ensure_utc(spark)
    read = ("trip_id", "cab_key", "price", "distance_miles")
    parsed = write_table(staging.parse_events(testdata.trip_bronze(spark, sf_dir), columns=core.fact_inputs(read)),
                         scratch_path(spark, "parsed"))
    stg = dedup_latest(parsed, ["trip_id"], staging.DEDUP_ORDER)
    short = parsed.withColumn("distance_miles", F.col("distance_miles") - 25)
    return {C.STG: stg, "fact_trips": core.fact_trips(short, columns=read),
            "dim_cabs": core.dim_cabs(stg.where("cab_tier <> 'R'"))}


VIOLATED = {("unique", "fact_trips", "trip_id"), ("relationships", "fact_trips", "cab_key"),
            ("expression_is_true", "fact_trips", "distance_miles")}


def violated_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = violating_models(spark, sf_dir)
    declared = [ck for ck in C.DECLARED_CHECKS if (ck.kind, ck.model, ck.column) in VIOLATED]
    tests = [t for t in C.SINGULAR_TESTS
             if t.name in ("assert_no_duplicate_trip_ids", "assert_accuracy_revenue_reconciliation")]
    return C.run_checks(m, declared, tests)


@register("checks_violated", O.with_violations(O.CHECKS_VIOLATED))
def checks_violated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique, relationship, expression, duplicate and reconciliation checks over models that break them."""
    return violated_counts(spark, sf_dir).select("check_name", "failures", "status")


@register("verdict_violated", O.with_violations(
    "SELECT severity, status, count(*) AS checks, sum(failures)::BIGINT AS failing_rows "
    f"FROM ({O.CHECKS_VIOLATED}) JOIN (SELECT check_name, severity FROM found) USING (check_name) GROUP BY severity, status"))
def verdict_violated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict over models that break their checks: error-severity checks fail."""
    return C.verdict(violated_counts(spark, sf_dir))


@register("reconciliation_violated", O.with_violations(O.reconciled_sql("bad")))
def reconciliation_violated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation row where the fact counts trips more than once."""
    m = violating_models(spark, sf_dir)
    return C.assert_reconciled(m[C.STG], m["fact_trips"])


@register("duplicates_violated", O.with_violations("SELECT trip_id, count(*) AS duplicate_count FROM bad GROUP BY trip_id HAVING count(*) > 1"))
def duplicates_violated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip ids that the un-deduplicated fact holds more than once."""
    return C.assert_no_duplicates(violating_models(spark, sf_dir)["fact_trips"])


# ------------------------------------------------------------------ sources, sinks, stream, gates

import datetime as _dt  # noqa: E402

from ridestar.plans import gates as G  # noqa: E402
from ridestar.sources import bronze as B  # noqa: E402
from ridestar.sources import csv as CSV  # noqa: E402
from ridestar.sources import kafka as K  # noqa: E402
from ridestar.sources import tables as TB  # noqa: E402
from ridestar.spec import PAYLOAD_FIELDS, TOPIC_RETENTION_DAYS  # noqa: E402
from ridestar.streaming import bronze_job as SJ  # noqa: E402


def _event_id_from(value: str = "value") -> "F.Column":
    from ridestar.functions.json import json_long

    return json_long(F.try_parse_json(F.col(value)), "event_id")


@register("event_envelope", O.EVENT_ENVELOPE)
def event_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka envelope decode (binary key/value -> text, timestamp renamed) over the events topic."""
    ensure_utc(spark)
    b = K.to_bronze(testdata.event_topic(spark, sf_dir))
    return stable(b.select("key", "partition", "offset", "kafka_timestamp", _event_id_from().alias("event_id")))


@register("json_extract", O.JSON_EXTRACT)
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict JSON field reads (json_value + safe_cast) from the message body and a nested JSON string."""
    from ridestar.functions.json import json_double, json_long, json_string

    ensure_utc(spark)
    b = K.to_bronze(testdata.event_topic(spark, sf_dir)).select(F.try_parse_json("value").alias("v"))
    v = F.col("v")
    body = b.select(json_long(v, "event_id").alias("event_id"), json_long(v, "user_id").alias("user_id"),
                    json_string(v, "event_type").alias("event_type"), json_double(v, "value").alias("value"),
                    json_string(v, "props").alias("props"))
    return body.select("event_id", "user_id", "event_type", "value",
                       json_long(F.try_parse_json("props"), "k").alias("k"))


def _mixed_topic_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip messages plus event messages on one topic.

    'error' events carry a non-finite measurement, which a Python producer
    serialises as a bare ``NaN`` (invalid JSON); every message is kept whole.
    """
    ev = K.to_bronze(testdata.event_topic(spark, sf_dir))
    nan_value = F.regexp_replace(F.col("value"), r'"value":[^,}]*', '"value":NaN')
    ev = ev.withColumn("value", F.when(F.col("key") == "error", nan_value).otherwise(F.col("value"))) \
        .withColumn("ingestion_time", F.col("kafka_timestamp"))
    return ev.unionByName(testdata.trip_bronze(spark, sf_dir))


@register("quarantine_split", O.QUARANTINE)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead-letter split of a mixed topic: rejected rows and their reason (accepted rows go to staging)."""
    ensure_utc(spark)
    _, bad = SJ.split_valid(_mixed_topic_bronze(spark, sf_dir))
    return bad.select("partition", "offset", "reject_reason")


@register("quarantine_strict", O.QUARANTINE_STRICT)
def quarantine_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of known defects over all line items: glued objects, trailing text or comma, repeated keys,
    a quoted number beside a brace, a brace too many, a missing id."""
    ensure_utc(spark)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k")
    items = testdata.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key)
    text = F.expr(O.STRICT_TEXT)
    bronze = items.select(F.lit(None).cast("string").alias("key"), text.alias("value"),
                          F.col("l_linenumber").cast("int").alias("partition"), F.col("l_orderkey").cast("long").alias("offset"),
                          F.current_timestamp().alias("kafka_timestamp"), F.current_timestamp().alias("ingestion_time"))
    parsed = staging.parse_events(bronze, with_reason=True, columns=["price"])
    malformed = F.col("reject_reason").eqNullSafe("malformed_json")
    return parsed.select(F.col("kafka_offset").alias("l_orderkey"),
                         F.col("kafka_partition").cast("long").alias("l_linenumber"), "reject_reason",
                         F.when(~malformed, F.col("price")).alias("price"))


@register("backlog", O.BACKLOG)
def backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retained messages per topic partition (offset range), the readiness gate's input."""
    return G.backlog(testdata.event_topic(spark, sf_dir))


RETENTION_NOW = "2024-01-31 00:00:00"


@register("retention", O.retention_sql(RETENTION_NOW, TOPIC_RETENTION_DAYS))
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows kept by a 7-day retention at a fixed 'now'."""
    ensure_utc(spark)
    b = K.to_bronze(testdata.event_topic(spark, sf_dir))
    kept = B.apply_retention(b, "kafka_timestamp", TOPIC_RETENTION_DAYS, _dt.datetime.fromisoformat(RETENTION_NOW))
    return stable(kept.select("partition", "offset", "kafka_timestamp"))


def _write_topic_files(spark: SparkSession, sf_dir: str, files: int = 8) -> str:
    path = scratch_path(spark, "topic")
    testdata.event_topic(spark, sf_dir).repartition(files, "partition", "offset").write.parquet(path)
    return path


def _stream_to_bronze(spark: SparkSession, sf_dir: str) -> str:
    src = _write_topic_files(spark, sf_dir)
    base = scratch_path(spark, "lake")
    paths = B.bronze_paths(base)
    SJ.run_file_bronze(spark, src, paths.data, paths.checkpoint, max_files_per_trigger=2)
    return paths.data


@register("stream_bronze", O.EVENT_ENVELOPE)
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Available-now file stream of the topic -> checkpointed Parquet bronze, read back through the commit log."""
    ensure_utc(spark)
    data = _stream_to_bronze(spark, sf_dir)
    b = B.read_bronze(spark, data)
    return stable(b.select("key", "partition", "offset", "kafka_timestamp", _event_id_from().alias("event_id")))


@register("file_freshness", O.FILE_FRESHNESS)
def file_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in bronze files written within the last 15 minutes, by the true clock and by one an hour ahead."""
    ensure_utc(spark)
    data = _stream_to_bronze(spark, sf_dir)
    later = _dt.datetime.now(_dt.timezone.utc) + _dt.timedelta(hours=1)

    def rows(clock: str, now: _dt.datetime | None) -> DataFrame:
        return G.fresh_rows(spark, data, now=now).agg(F.count(F.lit(1)).alias("fresh_rows")).select(
            F.lit(clock).alias("clock"), "fresh_rows")

    return rows("now", None).unionByName(rows("an hour later", later))


@register("retained_partitions", O.RETAINED)
def retained_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 7 ingest dates of an archive partitioned by date, written anew without the expired ones."""
    ensure_utc(spark)
    b = K.to_bronze(testdata.event_topic(spark, sf_dir)).withColumn("ingestion_time", F.col("kafka_timestamp"))
    archive = TB.write_table(B.with_ingest_date(b), path := scratch_path(spark, "archive"), partition_by=[B.PARTITION_COLUMN])
    assert B.PARTITION_COLUMN in archive.columns
    today = _dt.datetime.fromisoformat(RETENTION_NOW).date()
    kept = B.retain_partitions(spark, path, scratch_path(spark, "retained"), TOPIC_RETENTION_DAYS, today)
    return kept.select("partition", "offset", B.PARTITION_COLUMN)


def _archive(spark: SparkSession, sf_dir: str):
    """Events in files by date and offset, indexed; event times stand for ingestion times."""
    from ridestar.sources.archive import Archive

    ensure_utc(spark)
    b = K.to_bronze(testdata.event_topic(spark, sf_dir)).withColumn("ingestion_time", F.col("kafka_timestamp"))
    path = scratch_path(spark, "archive")
    B.with_ingest_date(b).repartitionByRange(B.PARTITION_COLUMN, "partition", "offset").write.partitionBy(B.PARTITION_COLUMN).parquet(path)
    a = Archive(spark, path)
    a.refresh()
    return a


@register("retention_in_place", O.RETAINED)
def retention_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 7 ingest dates after an expiry that only changes which files are live."""
    a = _archive(spark, sf_dir)
    a.expire(TOPIC_RETENTION_DAYS, _dt.datetime.fromisoformat(RETENTION_NOW).date())
    a.vacuum()
    return a.read().select("partition", "offset", B.PARTITION_COLUMN)


@register("offset_range", "SELECT event_id // 3 AS offset, event_type AS key FROM events "
                          "WHERE event_id % 3 = 1 AND event_id // 3 BETWEEN 100 AND 900")
def offset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of offsets of one partition; the file index leaves out the files that cannot hold any."""
    return _archive(spark, sf_dir).read(partition=1, offsets=(100, 900)).select("offset", "key")


@register("exact_percentiles", O.with_models(
    "SELECT round(quantile_cont(price, 0.5), 6) AS median_price, round(quantile_cont(price, 0.9), 6) AS price_90, "
    "round(quantile_cont(humidity, 0.5), 6) AS median_humidity FROM stg"))
def exact_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of staged measures by distributed selection."""
    from ridestar.operators.median import exact_percentile
    from ridestar.sources.tables import write_table

    rows = write_table(staged(spark, sf_dir, ["price", "humidity"]), scratch_path(spark, "measures"))
    found = [(n, exact_percentile(rows, F.col(c), q)) for n, c, q in
             (("median_price", "price", 0.5), ("price_90", "price", 0.9), ("median_humidity", "humidity", 0.5))]
    return spark.createDataFrame([tuple(v for _, v in found)], ", ".join(f"{n} double" for n, _ in found)).select(
        *[F.round(n, AVG_DECIMALS).alias(n) for n, _ in found])


@register("refresh_count", O.REFRESH_COUNT)
def refresh_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of the bronze table read afresh after the stream wrote it."""
    ensure_utc(spark)
    data = _stream_to_bronze(spark, sf_dir)
    return G.refresh_and_count(spark, data)


@register("bronze_compaction", O.EVENT_ENVELOPE)
def bronze_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small stream files rewritten into larger files per ingest date; rows unchanged."""
    ensure_utc(spark)
    data = _stream_to_bronze(spark, sf_dir)
    out = B.compact_bronze(spark, data, scratch_path(spark, "compacted"))
    return stable(out.select("key", "partition", "offset", "kafka_timestamp", _event_id_from().alias("event_id")))


_CSV_KEYS = testdata.PAYLOAD_KEYS_IN_TRIPS
_KEY_TO_COLUMN = {f.key: f.column for f in PAYLOAD_FIELDS}


def _write_trip_csv(rows: DataFrame, rows_per_file: int = 0, compression: str = "none") -> str:
    """Trip rows as raw CSV text: columns in another order, NA / NaN tokens for missing numbers, text fields padded
    with blanks, tabs and line breaks, and a text with quotes and a line break within. ``rows_per_file``: 0 for no limit."""
    numeric = set(CSV.NUMERIC_CSV_COLUMNS)
    rendered = []
    for k in _CSV_KEYS:
        c = F.col(f"`{k}`")
        if k == "apparentTemperature":
            txt = F.coalesce(c.cast("string"), F.lit("NaN"))
        elif k in numeric or k in ("hour", "day", "month"):
            txt = F.coalesce(c.cast("string"), F.lit("NA"))
        elif k in ("short_summary", "long_summary"):
            txt = F.concat(F.lit(" \t "), c, F.lit(" \n"))
        elif k == "product_id":
            txt = F.concat(c, F.lit(' "so\ncalled"'))
        else:
            txt = c
        rendered.append(txt.alias(k))
    out = rows.select(*rendered[::-1])
    path = scratch_path(rows.sparkSession, "csv")
    with freeing_shuffles(rows.sparkSession):
        (out.write.option("header", "true").option("maxRecordsPerFile", rows_per_file).option("compression", compression)
         .option("ignoreLeadingWhiteSpace", "false")
         .option("ignoreTrailingWhiteSpace", "false").option("nullValue", "").option("escape", '"').csv(path))
    return path


#: Bytes of rows (as Parquet) whose raw CSV text, some eight times as many, is on disk at a time.
CSV_SLICE_BYTES = 512 << 20


def _slices(spark: SparkSession, path: str, target: int) -> list[list[str]]:
    """The Parquet files under ``path`` in groups of at most ``target`` bytes (a larger file is alone)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length").collect()
    groups: list[list[str]] = []
    held = 0
    for file, length in sorted(files):
        if not groups or held + length > target:
            groups.append([])
            held = 0
        groups[-1].append(file)
        held += length
    return groups


@register("clean_columns", O.with_models(O.clean_columns_sql([_KEY_TO_COLUMN[k] for k in _CSV_KEYS])))
def clean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip rows written as raw CSV text (NA/NaN tokens, padded text), read back from splits as strings and cleaned.

    The text is many times as large as the rows, so it is written, read and dropped for a slice of them at a time.
    """
    ensure_utc(spark)
    given, kept = scratch_path(spark, "rows"), scratch_path(spark, "cleaned")
    schema = TB.write_table(testdata.trip_rows(spark, sf_dir).select(*[f"`{k}`" for k in _CSV_KEYS]), given).schema
    for files in _slices(spark, given, CSV_SLICE_BYTES):
        path = _write_trip_csv(spark.read.schema(schema).parquet(*files))
        cleaned = CSV.clean_columns(CSV.read_trips_csv_splits(spark, path, _CSV_KEYS))
        with freeing_shuffles(spark):
            cleaned.select(*[F.col(f"`{k}`").alias(_KEY_TO_COLUMN[k]) for k in _CSV_KEYS]).write.mode("append").parquet(kept)
        TB.drop_path(spark, path)
    TB.drop_path(spark, given)
    return spark.read.parquet(kept)


@register("event_stamp", O.with_models(O.EVENT_STAMP))
def event_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer enrichment from one clock (uuid id, epoch, datetime text, hour/day/month) and message key."""
    from ridestar.functions.clean import event_key

    ensure_utc(spark)
    rows = testdata.trip_rows(spark, sf_dir).select("partition", "offset", "source",
                                                    F.col("kafka_timestamp").alias("event_time"))
    st = CSV.stamp_events(rows, "event_time")
    return st.select("partition", "offset", "timestamp", "datetime", "hour", "day", "month",
                     event_key("source").alias("key"), (F.length("id") == 36).alias("has_id"))


@register("upsert_sync", O.with_models(O.upsert_sql("2024-01-01 00:00:00", "2024-01-02 00:00:00")))
def upsert_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality mart as an incremental table: append a run, change columns, replace a run by key."""
    m = star(spark, sf_dir, need=_QUALITY_NEED)
    stg, fact = m["stg"], m["fact_trips"]
    t1, t2 = _dt.datetime(2024, 1, 1), _dt.datetime(2024, 1, 2)
    path = scratch_path(spark, "dq_mart")

    def run(at, extra: bool):
        df = quality.dq_metrics(stg, fact, at)
        if extra:  # a later version of the model: one column removed, one added
            df = df.drop("composite_dq_score").withColumn(
                "stg_per_fact_row", F.round(F.try_divide(F.col("stg_total_rows").cast("double"),
                                                         F.col("fact_total_rows").cast("double")), 4))
        return df

    TB.upsert(spark, run(t1, False), path, "measured_at")
    TB.upsert(spark, run(t2, True), path, "measured_at")
    out = TB.upsert(spark, run(t1, True), path, "measured_at")
    return stable(out, _REVENUE_ROUND)


@register("check_results_stored", O.with_models(_ALL_CHECKS_SQL))
def check_results_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing rows of every check stored (one pass per model), then the results counted from the store."""
    m = star(spark, sf_dir)   # failing rows are stored whole
    m[C.STG] = m["stg"]
    base = scratch_path(spark, "dq_failures")
    C.write_failures(m, base)
    return C.results_from_store(spark, base, m)


def _produce(spark: SparkSession, sf_dir: str) -> str:
    from ridestar.streaming.producer import start_producer_files

    ensure_utc(spark)
    # read whole by one task each, so many files; as they are not split, they may as well be compressed
    csv_dir = _write_trip_csv(testdata.trip_rows(spark, sf_dir), rows_per_file=250_000, compression="gzip")
    topic = scratch_path(spark, "produced")
    q = start_producer_files(spark, csv_dir, list(_CSV_KEYS), topic, scratch_path(spark, "producer_ck"), multi_line=True)
    q.awaitTermination()
    TB.drop_path(spark, csv_dir)
    return topic


@register("producer_backlog", O.with_models(O.PRODUCER_BACKLOG))
def producer_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by the offsets that the producer gave: as many as trip rows, each offset once, from 0."""
    topic = spark.read.parquet(_produce(spark, sf_dir))
    n = G.backlog(topic).agg(F.sum("messages").alias("messages"), F.min("low").cast("int").alias("lowest_offset"))
    distinct = topic.select("partition", "offset").distinct().agg(F.count(F.lit(1)).alias("distinct_offsets"))
    return combine_single_rows(n, distinct).select("messages", "distinct_offsets", "lowest_offset")


@register("producer_stream", O.with_models(O.PRODUCER_STREAM))
def producer_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip CSV files streamed through the producer (clean, stamp, key, JSON) into topic files."""
    from ridestar.functions.json import json_double, json_string

    topic = _produce(spark, sf_dir)
    msgs = spark.read.parquet(topic).select(F.col("key").cast("string").alias("key"),
                                            F.try_parse_json(F.col("value").cast("string")).alias("v"))
    v = F.col("v")
    return msgs.select("key", json_string(v, "cab_type").alias("cab_provider"), json_string(v, "name").alias("cab_tier"),
                       json_double(v, "price").alias("price"), json_double(v, "distance").alias("distance_miles"),
                       json_double(v, "surge_multiplier").alias("surge_multiplier"),
                       json_double(v, "temperature").alias("temperature"))
