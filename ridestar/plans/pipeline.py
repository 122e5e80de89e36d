"""One run of the whole pipeline: bronze -> staging -> core -> marts -> checks -> quality mart.

Layers are written once and read back (staging is parsed once, not once per
dependent model); every written table also cuts the lineage, so a lost
executor recomputes from the last written layer, not from bronze. Output paths
live under ``base`` (a shared folder on a cluster).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ridestar.plans import checks as C
from ridestar.plans import core, marts, quality, staging
from ridestar.plans.silver import Silver
from ridestar.session import input_bytes, size_shuffles
from ridestar.sources.tables import Models, register_view, upsert, write_table

CORE_TABLES = ("dim_cabs", "dim_datetime", "dim_locations", "dim_weather", "fact_trips")
# Written bucketed by trip_id: staging leaves the dedup already hash-partitioned on it, the fact is a
# 1:1 projection of staging, and the unique checks, the no-duplicates test and the distinct-id count
# then group by trip_id without a shuffle.
BUCKETED = {"stg_rideshare_events": ("trip_id",), "fact_trips": ("trip_id",)}
MART_TABLES = ("mart_trip_trends", "mart_surge_analysis", "mart_weather_impact")


@dataclass
class RunResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    timings: dict[str, float] = field(default_factory=dict)
    check_results: DataFrame | None = None
    report: dict | None = None


# Independent models of one level run as concurrent Spark jobs (the upstream project runs 4 threads).
THREADS = 4


def _timed(result: RunResult, name: str, fn: Callable[[], DataFrame]) -> DataFrame:
    t0 = time.perf_counter()
    out = fn()
    result.timings[name] = round(time.perf_counter() - t0, 3)
    return out


def run_level(result: RunResult, level: str, tasks: Mapping[str, Callable[[], object]],
              threads: int = THREADS) -> dict[str, object]:
    """Run independent tasks as concurrent Spark jobs; records each task's time and the level's wall time."""
    t0 = time.perf_counter()
    if threads <= 1 or len(tasks) <= 1:
        out = {n: _timed(result, n, fn) for n, fn in tasks.items()}
    else:
        with ThreadPoolExecutor(max_workers=min(threads, len(tasks))) as pool:
            futures = {n: pool.submit(_timed, result, n, fn) for n, fn in tasks.items()}
            out = {n: f.result() for n, f in futures.items()}
    result.timings[f"level.{level}"] = round(time.perf_counter() - t0, 3)
    return out


def define_models(bronze: DataFrame, key_mode: str = core.ALIGNED) -> Models:
    """The model graph by name (staging -> core -> marts), each built from ``ref`` of its inputs."""
    m = Models()
    m.define(C.STG, lambda r: staging.stg_events(bronze))
    m.define("dim_cabs", lambda r: core.dim_cabs(r.ref(C.STG)))
    m.define("dim_datetime", lambda r: core.dim_datetime(r.ref(C.STG)))
    m.define("dim_locations", lambda r: core.dim_locations(r.ref(C.STG)))
    m.define("dim_weather", lambda r: core.dim_weather(r.ref(C.STG), key_mode))
    m.define("fact_trips", lambda r: core.fact_trips(r.ref(C.STG), key_mode))
    m.define("mart_trip_trends", lambda r: marts.mart_trip_trends(
        r.ref("fact_trips"), r.ref("dim_datetime"), r.ref("dim_cabs")))
    m.define("mart_surge_analysis", lambda r: marts.mart_surge_analysis(
        r.ref("fact_trips"), r.ref("dim_locations"), r.ref("dim_cabs")))
    m.define("mart_weather_impact", lambda r: marts.mart_weather_impact(
        r.ref("fact_trips"), r.ref("dim_weather"), r.ref("dim_cabs")))
    return m


def run_pipeline(spark: SparkSession, bronze: DataFrame, base: str, key_mode: str = core.ALIGNED,
                 measured_at: _dt.datetime | None = None, store_failures: bool = True,
                 raise_on_error: bool = False, marts_as_views: bool = False,
                 bronze_path: str | None = None, table_prefix: str | None = None,
                 threads: int = THREADS, checks: tuple = C.DECLARED_CHECKS, incremental: bool = False) -> RunResult:
    """Run every model once, in dependency order; staging and core are written tables.

    ``marts_as_views``: register the marts as temp views (computed when read)
    instead of writing them. ``bronze_path``: size shuffles from the input's
    file sizes first. Bucketed layers are catalog tables named
    ``table_prefix + model`` (external, at ``base/model``); the default prefix is made
    from ``base``, so runs with different bases do not share tables. The quality mart of a run is written even
    if its checks fail and ``raise_on_error`` ends the run afterwards.

    ``incremental``: staging is the table of ``plans.silver`` at ``base``, into which only those messages of ``bronze`` are merged
    that no run before has covered, and the quality mart is merged from that table's stored states. The results are those
    of a full run over all messages so far. Row-level checks are counted by the jobs that write the models (those of the
    incremental staging by a scan, as a merge writes only what changed), and failing rows are stored only for checks that failed.
    """
    base = base.rstrip("/")
    if table_prefix is None:
        table_prefix = f"ridestar_{hashlib.md5(base.encode()).hexdigest()[:8]}_"
    r = RunResult()
    if bronze_path:
        size_shuffles(spark, input_bytes(spark, bronze_path))
    m = define_models(bronze, key_mode)

    seen = C.Observed(checks, C.SINGULAR_TESTS)

    def write(n: str) -> Callable[[], DataFrame]:
        return lambda: write_table(seen.watch(n, m.ref(n)), f"{base}/{n}", bucket_by=BUCKETED.get(n, ()),
                                   table=f"{table_prefix}{n}")

    table = Silver(spark, f"{base}/{C.STG}") if incremental else None

    def merge() -> DataFrame:
        table.merge(bronze)
        return table.read()

    stg = run_level(r, "staging", {"staging": merge if incremental else write(C.STG)}, threads)["staging"]
    m.set(C.STG, stg)                        # dependents read the written table, not the plan
    r.tables[C.STG] = stg
    for n, df in run_level(r, "core", {n: write(n) for n in CORE_TABLES}, threads).items():
        m.set(n, df)
        r.tables[n] = df
    if marts_as_views:
        for n in MART_TABLES:
            r.tables[n] = register_view(m.ref(n), n)
    else:
        r.tables.update(run_level(r, "marts", {n: write(n) for n in MART_TABLES}, threads))
    t = r.tables
    results = _timed(r, "checks", lambda: write_table(
        C.run_checks(t, checks, counted=seen.counts()), f"{base}/dq_check_results"))
    if store_failures:
        bad = {x.check_name for x in results.where("failures > 0").select("check_name").collect()}   # at most a name per check
        run_level(r, "store_failures", {"store_failures": lambda: C.write_failures(
            t, f"{base}/dq_failures", [ck for ck in checks if ck.name in bad],
            [x for x in C.SINGULAR_TESTS if x.name in bad], threads=threads)}, 1)
    r.check_results = results
    dq = table.metrics(measured_at) if incremental else quality.dq_metrics(t[C.STG], t["fact_trips"], measured_at)
    r.tables["mart_data_quality_metrics"] = _timed(
        r, "mart_data_quality_metrics", lambda: upsert(spark, dq, f"{base}/mart_data_quality_metrics", "measured_at"))
    r.report = C.evaluate(results) if raise_on_error else _report(results)
    return r


def _report(results: DataFrame) -> dict:
    try:
        return C.evaluate(results)
    except C.DataQualityError as e:
        return {"error": str(e)}
