"""Declarative data checks: failing rows, a count, a severity and a status per check.

Generic kinds: ``not_null``, ``unique`` (NULL ignored), ``accepted_values`` (one
failing row per distinct bad value; NULL passes), ``relationships`` (NULL child
passes) and ``expression_is_true`` (NULL passes). Singular tests are plain
functions returning failing rows. Status: an ``error`` check fails when its count
meets ``error_if``; a ``warn`` check (the default) warns when it meets
``warn_if``; both thresholds default to ``!= 0``.

Scan plan for counting: all row-level checks (``not_null``,
``expression_is_true``) of one model are counted in a single aggregate pass, or
with no pass at all while the model is written (``Observed``);
each set-level check (``unique``, ``accepted_values``, ``relationships``) is one
aggregation or anti join.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ridestar.functions.numeric import pct
from ridestar.functions.time import minutes_between
from ridestar.operators.combine import combine_single_rows
from ridestar.operators.reshape import duplicates, null_counts
from ridestar.spec import (
    COMPLETENESS_FAIL_PCT,
    CRITICAL_COLUMNS,
    LAG_SLA_MINUTES,
    RECONCILE_TOLERANCE,
    VALID_PROVIDERS,
    WEEK_DAYS,
)

WARN = "warn"
ERROR = "error"
GENERIC_KINDS = ("not_null", "unique", "accepted_values", "relationships", "expression_is_true")
ROW_LEVEL = ("not_null", "expression_is_true")

RESULT_COLUMNS = ("check_name", "model", "column_name", "severity", "failures", "status")

_OPS: dict[str, Callable[[int, int], bool]] = {
    "!=": operator.ne, ">=": operator.ge, "<=": operator.le, ">": operator.gt, "<": operator.lt, "=": operator.eq,
}


def _threshold(spec: str) -> tuple[str, int]:
    spec = spec.replace(" ", "")
    for op in ("!=", ">=", "<=", ">", "<", "="):
        if spec.startswith(op):
            return op, int(spec[len(op):])
    raise ValueError(f"bad threshold {spec!r}")


def _threshold_col(failures: Column, spec: str) -> Column:
    op, n = _threshold(spec)
    return {"!=": failures != n, ">=": failures >= n, "<=": failures <= n, ">": failures > n,
            "<": failures < n, "=": failures == n}[op]


@dataclass(frozen=True)
class Check:
    model: str
    column: str | None
    kind: str
    severity: str = WARN
    values: tuple[str, ...] = ()
    expression: str = ""
    to_model: str = ""
    to_field: str = ""
    error_if: str = "!=0"
    warn_if: str = "!=0"
    name_override: str = ""

    @property
    def name(self) -> str:
        if self.name_override:
            return self.name_override
        return f"{self.kind}__{self.model}__{self.column}"

    def status(self, failures: int) -> str:
        if self.severity == ERROR:
            op, n = _threshold(self.error_if)
            if _OPS[op](failures, n):
                return "fail"
        op, n = _threshold(self.warn_if)
        return WARN if _OPS[op](failures, n) else "pass"


def status_col(failures: Column, severity: Column, error_if: str = "!=0", warn_if: str = "!=0") -> Column:
    return (
        F.when((severity == ERROR) & _threshold_col(failures, error_if), F.lit("fail"))
        .when(_threshold_col(failures, warn_if), F.lit(WARN))
        .otherwise(F.lit("pass"))
    )


def nn(model: str, column: str, severity: str = WARN, **kw) -> Check:
    return Check(model, column, "not_null", severity, **kw)


def uq(model: str, column: str, severity: str = ERROR) -> Check:
    return Check(model, column, "unique", severity)


def av(model: str, column: str, values: Sequence[str], severity: str = WARN) -> Check:
    return Check(model, column, "accepted_values", severity, values=tuple(values))


def rel(model: str, column: str, to_model: str, to_field: str, severity: str = ERROR) -> Check:
    return Check(model, column, "relationships", severity, to_model=to_model, to_field=to_field)


def ex(model: str, column: str, expression: str, severity: str = WARN) -> Check:
    return Check(model, column, "expression_is_true", severity, expression=expression)


STG = "stg_rideshare_events"

# --- fixed values: the declared column checks (model, column, kind, severity, parameters) ---
DECLARED_CHECKS: tuple[Check, ...] = (
    nn(STG, "trip_id", ERROR, error_if=">0"),
    uq(STG, "trip_id", ERROR),
    nn(STG, "cab_provider"),
    av(STG, "cab_provider", VALID_PROVIDERS),
    nn(STG, "cab_tier"),
    nn(STG, "source_neighborhood"),
    nn(STG, "destination_neighborhood"),
    nn(STG, "price"),
    nn(STG, "distance_miles"),
    nn(STG, "surge_multiplier"),
    ex(STG, "surge_multiplier", ">= 1.0"),
    ex(STG, "trip_hour", "between 0 and 23"),
    ex(STG, "trip_day", "between 1 and 31"),
    ex(STG, "trip_month", "between 1 and 12"),
    ex(STG, "temperature", "between -50 and 150"),
    ex(STG, "humidity", "between 0.0 and 1.0"),
    ex(STG, "precip_probability", "between 0.0 and 1.0"),
    ex(STG, "latitude", "between 41.0 and 43.0"),
    ex(STG, "longitude", "between -72.0 and -70.0"),
    nn(STG, "kafka_timestamp"),
    nn(STG, "ingestion_time"),
    nn("dim_cabs", "cab_key", ERROR),
    uq("dim_cabs", "cab_key", ERROR),
    nn("dim_cabs", "cab_provider"),
    av("dim_cabs", "cab_provider", VALID_PROVIDERS),
    nn("dim_cabs", "cab_tier"),
    nn("dim_datetime", "datetime_key", ERROR),
    uq("dim_datetime", "datetime_key", ERROR),
    ex("dim_datetime", "hour", "between 0 and 23"),
    ex("dim_datetime", "month", "between 1 and 12"),
    av("dim_datetime", "day_of_week", WEEK_DAYS),
    nn("dim_locations", "location_key", ERROR),
    uq("dim_locations", "location_key", ERROR),
    nn("dim_locations", "neighborhood", ERROR),
    nn("dim_locations", "latitude"),
    ex("dim_locations", "latitude", "between 41.0 and 43.0"),
    nn("dim_locations", "longitude"),
    ex("dim_locations", "longitude", "between -72.0 and -70.0"),
    nn("dim_weather", "weather_key", ERROR),
    uq("dim_weather", "weather_key", ERROR),
    nn("fact_trips", "trip_id", ERROR),
    uq("fact_trips", "trip_id", ERROR),
    nn("fact_trips", "cab_key", ERROR),
    rel("fact_trips", "cab_key", "dim_cabs", "cab_key", ERROR),
    nn("fact_trips", "source_location_key", ERROR),
    rel("fact_trips", "source_location_key", "dim_locations", "location_key", ERROR),
    nn("fact_trips", "destination_location_key", ERROR),
    rel("fact_trips", "destination_location_key", "dim_locations", "location_key", ERROR),
    nn("fact_trips", "datetime_key", ERROR),
    rel("fact_trips", "datetime_key", "dim_datetime", "datetime_key", ERROR),
    nn("fact_trips", "weather_key", WARN),
    rel("fact_trips", "weather_key", "dim_weather", "weather_key", WARN),
    nn("fact_trips", "price"),
    ex("fact_trips", "price", "> 0"),
    nn("fact_trips", "distance_miles"),
    ex("fact_trips", "distance_miles", "> 0"),
    nn("fact_trips", "surge_multiplier"),
    ex("fact_trips", "surge_multiplier", ">= 1.0"),
)


# ------------------------------------------------------------------ generic checks

def _violation(check: Check) -> Column:
    """Row-level failure condition (TRUE = failing row; NULL passes)."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "expression_is_true":
        return ~F.expr(f"`{check.column}` {check.expression}")
    raise ValueError(f"{check.kind} is not a row-level check")


def failing_rows(check: Check, models: Mapping[str, DataFrame]) -> DataFrame:
    """The rows a check returns.

    Row-level checks return the model's failing rows. Set-level checks return
    one row per failing value with its count (``value_field``, ``n_records``):
    for relationships that is one row per orphan key rather than per child row,
    computed on child keys aggregated before the anti join (a hot key costs one
    row per task, and the stored result stays bounded by distinct keys).
    """
    df = models[check.model]
    c = F.col(check.column)
    if check.kind in ROW_LEVEL:
        return df.where(_violation(check))
    if check.kind == "unique":
        return (df.where(c.isNotNull()).groupBy(c.alias("value_field"))
                .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))
    if check.kind == "accepted_values":
        return (df.groupBy(c.alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
                .where(~F.col("value_field").isin(*check.values)))
    if check.kind == "relationships":
        parent = models[check.to_model].select(F.col(check.to_field).alias("__to"))
        child = (df.where(c.isNotNull()).groupBy(c.alias("value_field"))
                 .agg(F.count(F.lit(1)).alias("n_records")))
        return child.join(parent, child.value_field == parent["__to"], "left_anti")
    raise ValueError(f"unknown check kind {check.kind!r}")


def _failure_count(check: Check, models: Mapping[str, DataFrame]) -> DataFrame:
    """One row: the number of failing rows as the check defines them.

    unique / accepted_values: failing values; relationships: child rows whose key
    has no parent (the sum of the orphan keys' counts).
    """
    rows = failing_rows(check, models)
    if check.kind == "relationships":
        return rows.agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("failures"))
    return rows.agg(F.count(F.lit(1)).alias("failures"))


def _meta(check: Check) -> list[Column]:
    return [F.lit(check.name).alias("check_name"), F.lit(check.model).alias("model"),
            F.lit(check.column).cast("string").alias("column_name"), F.lit(check.severity).alias("severity")]


class Observed:
    """Row-level checks counted by the jobs that write the models: they cost no scan of their own.

    A task counts the rows it writes; a task that is run again counts once. ``watch`` a model's rows, write the result, then
    read ``counts``.
    """

    def __init__(self, checks: Sequence[Check] = (), tests: Sequence[SingularTest] = ()):
        self._conditions: dict[str, list[tuple[str, Column]]] = {}
        for ck in checks:
            if ck.kind in ROW_LEVEL:
                self._conditions.setdefault(ck.model, []).append((ck.name, _violation(ck)))
        for t in tests:
            if t.violation:
                self._conditions.setdefault(t.model, []).append((t.name, t.violation()))
        self._watched: dict[str, Observation] = {}

    def watch(self, model: str, df: DataFrame) -> DataFrame:
        """``df`` as it is; writing it counts the failing rows of the model's row-level checks."""
        conditions = self._conditions.get(model)
        if not conditions:
            return df
        self._watched[model] = Observation()
        return df.observe(self._watched[model], *[F.count_if(c).alias(f"c{i}") for i, (_, c) in enumerate(conditions)])

    def counts(self) -> dict[str, int]:
        """Failing rows by check name, of the models written so far."""
        return {name: int(seen.get[f"c{i}"] or 0) for model, seen in self._watched.items()
                for i, (name, _) in enumerate(self._conditions[model])}


def check_counts(models: Mapping[str, DataFrame], checks: Sequence[Check] = DECLARED_CHECKS,
                 tests: Sequence[SingularTest] = (), counted: Mapping[str, int] | None = None) -> DataFrame:
    """One row per check: check_name, model, column_name, severity, failures, status.

    All row-level conditions on a model, those of ``tests`` included, are counted in one scan of it. ``counted``: failing rows
    of checks that are known already, by name (see ``Observed``); a model all of whose row-level checks are known is not scanned.
    """
    parts: list[DataFrame] = []
    row_level: dict[str, list[tuple[str, str, Column]]] = {}
    counted = counted or {}
    known = [(ck.name, ck.model, ck.column, ck.severity, counted[ck.name]) for ck in checks if ck.name in counted]
    known += [(t.name, t.model, None, t.severity, counted[t.name]) for t in tests if t.name in counted]
    if known:
        spark = next(iter(models.values())).sparkSession
        parts.append(spark.createDataFrame(known, "check_name string, model string, column_name string, severity string, failures long"))
    for ck in (ck for ck in checks if ck.name not in counted):
        if ck.kind in ROW_LEVEL:
            label = f"'{ck.name}', '{ck.model}', '{ck.column}', '{ck.severity}'"
            row_level.setdefault(ck.model, []).append((ck.name, label, _violation(ck)))
        else:
            parts.append(_failure_count(ck, models).select(*_meta(ck), "failures"))
    for t in (t for t in tests if t.name not in counted):
        label = f"'{t.name}', '{t.model}', cast(null as string), '{t.severity}'"
        row_level.setdefault(t.model, []).append((t.name, label, t.violation()))
    for model, conditions in row_level.items():
        counted = models[model].agg(*[F.count_if(c).alias(f"c{i}") for i, (_, _, c) in enumerate(conditions)])
        rows = ", ".join(f"{label}, c{i}" for i, (_, label, _) in enumerate(conditions))
        parts.append(counted.select(F.expr(
            f"stack({len(conditions)}, {rows}) as (check_name, model, column_name, severity, failures)")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    thresholds = {ck.name: (ck.error_if, ck.warn_if) for ck in checks} | {t.name: ("!=0", "!=0") for t in tests}
    status = F.lit("pass")
    for spec in sorted(set(thresholds.values())):
        names = [n for n, t in thresholds.items() if t == spec]
        status = F.when(F.col("check_name").isin(*names),
                        status_col(F.col("failures"), F.col("severity"), *spec)).otherwise(status)
    return out.select("check_name", "model", "column_name", "severity",
                      F.col("failures").cast("bigint").alias("failures"), status.alias("status"))


# ------------------------------------------------------------------ singular tests (return failing rows)

def assert_reconciled(stg: DataFrame, fact: DataFrame, tolerance: float = RECONCILE_TOLERANCE) -> DataFrame:
    """Staging and fact revenue (rounded to 4 places) differ by more than ``tolerance`` (share)."""
    s = stg.where(F.col("price").isNotNull()).agg(
        F.round(F.sum("price"), 4).alias("staging_revenue"), F.count(F.lit(1)).alias("staging_count"))
    f = fact.where(F.col("price").isNotNull()).agg(
        F.round(F.sum("price"), 4).alias("fact_revenue"), F.count(F.lit(1)).alias("fact_count"))
    both = combine_single_rows(s, f)
    diff = F.abs(F.col("staging_revenue") - F.col("fact_revenue"))
    share = F.try_divide(diff, F.nullif(F.col("staging_revenue"), F.lit(0.0)))
    return both.where(share > tolerance).select(
        "staging_revenue", "fact_revenue", "staging_count", "fact_count",
        diff.alias("revenue_discrepancy"), F.round(share * 100, 4).alias("discrepancy_pct"))


def assert_complete(stg: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS,
                    max_null_pct: float = COMPLETENESS_FAIL_PCT) -> DataFrame:
    """Columns whose NULL share is over ``max_null_pct`` percent (one scan for all columns)."""
    nc = null_counts(stg, columns)
    null_share = F.try_divide(F.col("null_count").cast("double") * 100.0, F.col("total_rows").cast("double"))
    return nc.where(null_share > max_null_pct).select(
        "column_name", "null_count", "total_rows",
        pct(F.col("null_count"), F.col("total_rows")).alias("null_pct"),
        pct(F.col("total_rows") - F.col("null_count"), F.col("total_rows")).alias("completeness_rate_pct"))


def assert_no_duplicates(fact: DataFrame, key: str = "trip_id") -> DataFrame:
    return duplicates(fact, [key], "duplicate_count")


def not_positive(column: str = "price") -> Column:
    return F.col(column).isNull() | (F.col(column) <= 0)


POSITIVE_COLUMNS = ("trip_id", "price", "cab_provider", "cab_tier", "ingestion_time")


def assert_positive(stg: DataFrame, column: str = "price") -> DataFrame:
    return stg.where(not_positive(column)).select("trip_id", column, "cab_provider", "cab_tier", "ingestion_time")


LAG_COLUMNS = ("trip_id", "kafka_timestamp", "ingestion_time")


def too_late(max_minutes: int = LAG_SLA_MINUTES) -> Column:
    """TRUE where both times are known and lie more than ``max_minutes`` apart."""
    return F.coalesce(minutes_between("kafka_timestamp", "ingestion_time") > max_minutes, F.lit(False))


def assert_lag(fact: DataFrame, max_minutes: int = LAG_SLA_MINUTES) -> DataFrame:
    return fact.where(too_late(max_minutes)).select(
        "trip_id", "kafka_timestamp", "ingestion_time",
        minutes_between("kafka_timestamp", "ingestion_time").alias("lag_minutes"))


@dataclass(frozen=True)
class SingularTest:
    name: str
    model: str
    severity: str
    rows: Callable[[Mapping[str, DataFrame]], DataFrame] = field(compare=False)
    # the failing rows' condition, if the test is one on single rows of its model
    violation: Callable[[], Column] | None = field(default=None, compare=False)
    # the columns it reads, by model
    reads: Mapping[str, Sequence[str]] = field(default_factory=dict, compare=False)


# --- fixed values: singular tests and severities (no-duplicates is documented as error) ---
SINGULAR_TESTS: tuple[SingularTest, ...] = (
    SingularTest("assert_accuracy_revenue_reconciliation", "fact_trips", WARN,
                 lambda m: assert_reconciled(m[STG], m["fact_trips"]), reads={STG: ["price"], "fact_trips": ["price"]}),
    SingularTest("assert_completeness_critical_fields", STG, WARN, lambda m: assert_complete(m[STG]),
                 reads={STG: CRITICAL_COLUMNS}),
    SingularTest("assert_no_duplicate_trip_ids", "fact_trips", ERROR, lambda m: assert_no_duplicates(m["fact_trips"]),
                 reads={"fact_trips": ["trip_id"]}),
    SingularTest("assert_price_positive", STG, WARN, lambda m: assert_positive(m[STG]), not_positive,
                 {STG: POSITIVE_COLUMNS}),
    SingularTest("assert_timeliness_ingestion_lag", "fact_trips", WARN, lambda m: assert_lag(m["fact_trips"]), too_late,
                 {"fact_trips": LAG_COLUMNS}),
)


def columns_read(checks: Sequence[Check] = DECLARED_CHECKS, tests: Sequence[SingularTest] = SINGULAR_TESTS) -> dict[str, list[str]]:
    """The columns that counting these checks' failures reads, by model."""
    read: dict[str, list[str]] = {}
    for ck in checks:
        read.setdefault(ck.model, []).append(ck.column)
        if ck.to_model:
            read.setdefault(ck.to_model, []).append(ck.to_field)
    for t in tests:
        for model, columns in t.reads.items():
            read.setdefault(model, []).extend(columns)
    return read


def singular_counts(models: Mapping[str, DataFrame], tests: Sequence[SingularTest] = SINGULAR_TESTS) -> DataFrame:
    parts = [
        t.rows(models).agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(t.name).alias("check_name"), F.lit(t.model).alias("model"),
            F.lit(None).cast("string").alias("column_name"), F.lit(t.severity).alias("severity"),
            F.col("failures").cast("bigint").alias("failures"))
        for t in tests
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", status_col(F.col("failures"), F.col("severity")))


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check] = DECLARED_CHECKS,
               tests: Sequence[SingularTest] = SINGULAR_TESTS, counted: Mapping[str, int] | None = None) -> DataFrame:
    """Every declared check and singular test as one result table; ``counted`` as in ``check_counts``."""
    by_row = [t for t in tests if t.violation]
    out = check_counts(models, checks, by_row, counted)
    others = [t for t in tests if not t.violation]
    return out.unionByName(singular_counts(models, others)) if others else out


# ------------------------------------------------------------------ verdict

def verdict(results: DataFrame) -> DataFrame:
    """Failures grouped by severity and status: checks and failing rows per group."""
    return results.groupBy("severity", "status").agg(
        F.count(F.lit(1)).alias("checks"), F.coalesce(F.sum("failures"), F.lit(0)).cast("bigint").alias("failing_rows"))


class DataQualityError(RuntimeError):
    pass


def evaluate(results: DataFrame) -> dict[str, list[tuple[str, int]]]:
    """Warn-status checks are reported and the run continues; any fail-status check raises.

    Collects only the failing checks (at most one row per check).
    """
    bad = results.where(F.col("status") != "pass").select("check_name", "status", "failures").collect()
    report = {"warn": [(r.check_name, r.failures) for r in bad if r.status == WARN],
              "fail": [(r.check_name, r.failures) for r in bad if r.status == "fail"]}
    if report["fail"]:
        lines = "\n".join(f"  {n}: {k} failing rows" for n, k in report["fail"])
        raise DataQualityError(f"error-severity checks failed:\n{lines}")
    return report


def row_level_failures(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failing rows of several row-level checks on one model, from one scan.

    Each row carries the names of the checks it fails; a row failing k checks
    is emitted k times with ``check_name`` set (one copy per check).
    """
    names = F.array_compact(F.array(*[F.when(_violation(ck), F.lit(ck.name)) for ck in checks]))
    return (df.withColumn("__failed", names).where(F.size("__failed") > 0)
            .withColumn("check_name", F.explode("__failed")).drop("__failed"))


def write_failures(models: Mapping[str, DataFrame], base: str, checks: Sequence[Check] = DECLARED_CHECKS,
                   tests: Sequence[SingularTest] = SINGULAR_TESTS, threads: int = 1) -> list[str]:
    """Store failing rows of every check, overwritten per run; returns the written paths.

    * row-level checks of a model: one scan, one write, partitioned by ``check_name``;
    * set-level checks: one write of (check_name, value_field, n_records), partitioned by ``check_name``;
    * singular tests: a directory each (their own columns).

    ``threads`` > 1 submits the independent writes as concurrent Spark jobs.
    """
    base = base.rstrip("/")
    jobs: dict[str, Callable[[], None]] = {}
    row_level: dict[str, list[Check]] = {}
    set_level = []
    for ck in checks:
        if ck.kind in ROW_LEVEL:
            row_level.setdefault(ck.model, []).append(ck)
        else:
            set_level.append(failing_rows(ck, models).select(
                F.lit(ck.name).alias("check_name"), F.col("value_field").cast("string").alias("value_field"),
                F.col("n_records").cast("bigint").alias("n_records")))
    if set_level:
        u = set_level[0]
        for d in set_level[1:]:
            u = u.unionByName(d)
        jobs[f"{base}/set_checks"] = lambda u=u, p=f"{base}/set_checks": (
            u.write.mode("overwrite").partitionBy("check_name").parquet(p))
    for model, cks in row_level.items():
        p = f"{base}/row_checks/{model}"
        jobs[p] = lambda df=row_level_failures(models[model], cks), p=p: (
            df.write.mode("overwrite").partitionBy("check_name").parquet(p))
    for t in tests:
        p = f"{base}/{t.name}"
        jobs[p] = lambda df=t.rows(models), p=p: df.write.mode("overwrite").parquet(p)
    if threads > 1:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for f in [pool.submit(j) for j in jobs.values()]:
                f.result()
    else:
        for j in jobs.values():
            j()
    return list(jobs)


def read_failures(spark, base: str, check: Check | SingularTest, models: Mapping[str, DataFrame]) -> DataFrame:
    """Stored failing rows of one check (empty, with the right columns, when it had none)."""
    from pyspark.sql import types as T

    base = base.rstrip("/")
    if isinstance(check, SingularTest):
        place, schema = check.name, check.rows(models).schema
    elif check.kind in ROW_LEVEL:
        place = f"row_checks/{check.model}"
        schema = T.StructType(models[check.model].schema.fields + [T.StructField("check_name", T.StringType())])
    else:
        place = "set_checks"
        schema = T.StructType([T.StructField("value_field", T.StringType()), T.StructField("n_records", T.LongType()),
                               T.StructField("check_name", T.StringType())])
    try:
        df = spark.read.schema(schema).parquet(f"{base}/{place}")
    except AnalysisException:   # a run that found no such failures stored none
        df = spark.createDataFrame([], schema)
    if isinstance(check, SingularTest):
        return df
    return df.where(F.col("check_name") == check.name).drop("check_name")


def _check_catalog(spark, checks: Sequence[Check], tests: Sequence[SingularTest]) -> DataFrame:
    """The check definitions as a small table (configuration, one row per check)."""
    rows = [(ck.name, ck.model, ck.column, ck.severity, ck.error_if, ck.warn_if) for ck in checks]
    rows += [(t.name, t.model, None, t.severity, "!=0", "!=0") for t in tests]
    return spark.createDataFrame(rows, "check_name string, model string, column_name string, severity string, "
                                       "error_if string, warn_if string")


def results_from_store(spark, base: str, models: Mapping[str, DataFrame], checks: Sequence[Check] = DECLARED_CHECKS,
                       tests: Sequence[SingularTest] = SINGULAR_TESTS) -> DataFrame:
    """Check results counted from the stored failing rows (written by ``write_failures``).

    The models are not scanned again: counts come from the (small) failure
    store. Checks with no stored rows count 0.
    """
    from pyspark.sql import types as T

    base = base.rstrip("/")
    counts: list[DataFrame] = []
    for model in dict.fromkeys(ck.model for ck in checks if ck.kind in ROW_LEVEL):
        schema = T.StructType(models[model].schema.fields + [T.StructField("check_name", T.StringType())])
        counts.append(spark.read.schema(schema).parquet(f"{base}/row_checks/{model}")
                      .groupBy("check_name").agg(F.count(F.lit(1)).alias("failures")))
    rel = [ck.name for ck in checks if ck.kind == "relationships"]
    if any(ck.kind not in ROW_LEVEL for ck in checks):
        s = spark.read.schema("value_field string, n_records long, check_name string").parquet(f"{base}/set_checks")
        counts.append(s.groupBy("check_name").agg(
            F.when(F.col("check_name").isin(*rel), F.sum("n_records")).otherwise(F.count(F.lit(1))).alias("failures")))
    for t in tests:
        counts.append(spark.read.parquet(f"{base}/{t.name}").agg(F.count(F.lit(1)).alias("failures"))
                      .select(F.lit(t.name).alias("check_name"), "failures"))
    found = counts[0]
    for c in counts[1:]:
        found = found.unionByName(c)
    cat = _check_catalog(spark, checks, tests)
    out = cat.join(found, "check_name", "left").withColumn(
        "failures", F.coalesce(F.col("failures"), F.lit(0)).cast("bigint"))
    status = F.lit("pass")
    for spec in sorted({(ck.error_if, ck.warn_if) for ck in checks} | {("!=0", "!=0")}):
        status = F.when((F.col("error_if") == spec[0]) & (F.col("warn_if") == spec[1]),
                        status_col(F.col("failures"), F.col("severity"), *spec)).otherwise(status)
    return out.select("check_name", "model", "column_name", "severity", "failures", status.alias("status"))
