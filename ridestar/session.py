"""Session helpers: a local session for tests/bench and the shared work folder.

On a cluster the session comes from ``spark-submit`` and ``spark.checkpoint.dir``
names a shared folder; every lineage cut and scratch table goes there. Only when
it is unset (tests, local runs) do we create our own folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "ridestar", memory: str | None = None) -> SparkSession:
    """A local session with the settings we want on a cluster too (AQE, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory or os.environ.get("RIDESTAR_DRIVER_MEMORY", "4g"))
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Reads ``spark.checkpoint.dir`` (set by the cluster). When it is unset, a local
    session (one JVM) gets a fresh local folder; on any other master each executor would
    write to its own disk, so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext handle (remote sessions)
        sc = None
    if sc is None:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return conf_dir.rstrip("/")
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ridestar-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_utc(spark: SparkSession) -> None:
    """Instants in this pipeline are read and printed in UTC."""
    # no default argument: Spark validates a given default as a zone id
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def allow_repeated_keys(spark: SparkSession) -> None:
    """Of repeated JSON keys the last value counts in variant parses too, as in typed ones."""
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def compiled_methods(spark: SparkSession) -> None:
    """Stages whose generated method has over 8,000 bytes run by operators instead: HotSpot never compiles such a method."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing_shuffles(spark: SparkSession):
    """Writes begun here drop their shuffle files when they end; otherwise the files of all a query's writes stay side by side.

    A write's plan is its own and never runs again. For eager writes only: a DataFrame that is collected twice would have to
    make its shuffle anew.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)


#: Bytes of an Arrow batch that a task hands to Python; Spark's own bound is 10,000 rows, however long their texts.
ARROW_BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Rows with whole texts go to Python in batches of a few MB, so a task holds little of them on either side."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def strip_file_scheme(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:") or os.path.isabs(path)


# Spark's default spark.sql.sources.bucketing.maxBuckets: a bound of Spark, not a choice of ours.
MAX_BUCKETS = 100_000

# Target bytes per shuffle partition when sizing a run from its input (AQE coalesces below this).
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the Parquet files under ``path``, from the file listing (contents are not read)."""
    from pyspark.sql import functions as F

    row = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
           .option("recursiveFileLookup", "true").load(path)
           .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first())
    return int(row["n"]) if row else 0


def size_shuffles(spark: SparkSession, nbytes: int, target: int = TARGET_PARTITION_BYTES,
                  expansion: float = 3.0) -> int:
    """Raise ``spark.sql.shuffle.partitions`` so each shuffle partition holds about ``target`` bytes.

    ``expansion``: decoded rows are larger than their compressed files. Never
    lowers the current setting; AQE coalesces small partitions at run time.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, int(nbytes * expansion // target) + 1)
    if wanted > MAX_BUCKETS:   # keep a multiple of the bucket cap: each shuffle partition maps to one bucket
        wanted = -(-wanted // MAX_BUCKETS) * MAX_BUCKETS
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target // 4))
    return wanted
