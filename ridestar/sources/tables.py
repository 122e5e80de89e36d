"""Table materialisation: views, full refresh, incremental upsert with column sync, model registry."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestar.session import MAX_BUCKETS, freeing_shuffles


def register_view(df: DataFrame, name: str) -> DataFrame:
    """A view: the plan is kept, nothing is computed until read."""
    df.createOrReplaceTempView(name)
    return df


def bucket_count(spark: SparkSession) -> int:
    """Buckets for a table written right after a shuffle: the shuffle partition count, capped.

    With equal counts (or a count that divides the partition count) each task
    writes exactly one bucket.
    """
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (),
                table: str | None = None, buckets: int | None = None, compression: str | None = None) -> DataFrame:
    """Full refresh: overwrite the table's files, return a reader of the new table.

    The shuffles of the write are dropped at its end. ``compression``: the Parquet codec (None: the session's).

    ``bucket_by`` (needs ``table``): an external catalog table at ``path``,
    bucketed on those columns, so later aggregations and joins on them read
    co-located data without a shuffle.
    """
    spark = df.sparkSession
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        if not table:
            raise ValueError("bucketed tables need a table name")
        with freeing_shuffles(spark):
            w.bucketBy(buckets or bucket_count(spark), *bucket_by).option("path", path).saveAsTable(table)
        return spark.table(table)
    with freeing_shuffles(spark):
        w.parquet(path)
    return spark.read.parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes what a run wrote at ``path`` for itself; no DataFrame that is still to run may read it."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def align_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows in the new column set: new columns NULL, removed columns dropped, types cast to the new ones."""
    types = {f.name: f.dataType for f in new.schema.fields}
    have = set(old.columns)
    return old.select(*[
        (F.col(f"`{c}`").cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in types.items()
    ])


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path, for renames that Spark's readers and writers do not offer."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def replace_table(spark: SparkSession, staged: str, path: str) -> None:
    """Put the whole table at ``staged`` in the place of ``path`` by renames.

    The old table is kept aside until the new one is in place, so a crash leaves at least one whole table;
    ``read_table`` finishes what a crash left undone.
    """
    fs, new = _file_system(spark, staged)
    _, now = _file_system(spark, path)
    _, old = _file_system(spark, _aside(path))
    fs.delete(old, True)
    if fs.exists(now) and not fs.rename(now, old):
        raise OSError(f"{path} could not be put aside")
    if not fs.rename(new, now):
        raise OSError(f"{staged} could not be renamed to {path}")
    fs.delete(old, True)


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}__previous"


def recover_table(spark: SparkSession, path: str) -> None:
    """After a crash between the two renames of ``replace_table``: the previous table is put back."""
    fs, now = _file_system(spark, path)
    _, old = _file_system(spark, _aside(path))
    if not fs.exists(now) and fs.exists(old):
        fs.rename(old, now)


def upsert(spark: SparkSession, df: DataFrame, path: str, key: Sequence[str] | str) -> DataFrame:
    """Incremental merge on a unique key, with ``sync_all_columns`` schema evolution.

    * a key given twice in ``df`` is an error; NULL is a key like any other;
    * table missing: write it;
    * same columns and no key already present: plain append (no rewrite);
    * otherwise: old rows whose key is not in ``df`` are aligned to ``df``'s columns and written
      together with ``df`` beside the table, which is then replaced by renames. The table is whole at
      every moment.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if df.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"the rows to merge repeat a key {keys}")
    recover_table(spark, path)
    old = read_table(spark, path)
    if old is None:
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    same_schema = [(f.name, f.dataType) for f in old.schema.fields] == [(f.name, f.dataType) for f in df.schema.fields]
    given = df.select(*[F.col(k).alias(f"__new_{k}") for k in keys])
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__new_{k}")) for k in keys])
    if same_schema and old.join(given, same_key, "left_semi").limit(1).count() == 0:
        df.write.mode("append").parquet(path)
        return spark.read.parquet(path)
    staged = f"{path.rstrip('/')}__staged_{uuid.uuid4().hex[:12]}"
    align_columns(old.join(given, same_key, "left_anti"), df).unionByName(df).write.parquet(staged)
    replace_table(spark, staged, path)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)


class Models:
    """Models by name: ``ref(name)`` builds (or returns the materialised) DataFrame."""

    def __init__(self) -> None:
        self._builders: dict[str, Callable[["Models"], DataFrame]] = {}
        self._built: dict[str, DataFrame] = {}

    def define(self, name: str, builder: Callable[["Models"], DataFrame]) -> None:
        self._builders[name] = builder
        self._built.pop(name, None)

    def set(self, name: str, df: DataFrame) -> None:
        self._built[name] = df

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self)
        return self._built[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.ref(name)

    def names(self) -> list[str]:
        return list(dict.fromkeys([*self._builders, *self._built]))
