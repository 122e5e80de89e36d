"""Reading the corpus tables and cutting lineage in the shared work folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestar.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor re-reads files instead of repeating the
    work, and values that depend on the run (row ids) are fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of the filter of keys in ``stay``: 4 MB, whatever the number of keys.
SIEVE_BITS = 1 << 25


def stay(docs: DataFrame, key: dict[str, Column], keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` left by decisions on keys, all columns as they were.

    ``keys`` has a row per key under decision (named as in ``key``; nulls are equal): ``kept``,
    and ``copies``, the number of rows with that key. Rows without one stay. Of a kept key's rows one stays (the
    least row): an aggregate with map-side combination, run only if there are such keys.

    Most rows have no decision against them and are not shuffled: a filter of fixed size, broadcast as bitmaps, never misses a key
    that loses rows; only rows that it may hold are joined to the keys.
    """
    names = docs.columns
    mark = "__key"
    while any(c.lower().startswith(mark) for c in names):
        mark = "_" + mark
    at, kept, copies = (F.col(f"{mark}_{c}") for c in ("at", "kept", "copies"))
    place = F.pmod(F.xxhash64(mark), F.lit(SIEVE_BITS))
    keys = keys.where(~F.col("kept") | (F.col("copies") > 1)).select(
        *[F.col(c).alias(f"{mark}_{c}") for c in [*key, "copies", "kept"]])
    places = keys.select(F.struct(*[F.col(f"{mark}_{n}").alias(n) for n in key]).alias(mark)).select(place.alias(f"{mark}_at"))
    sieve = written(places.groupBy(F.shiftright(at, 15).alias(f"{mark}_part"))
                    .agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(SEGMENT - 1))).alias(f"{mark}_bits")), "sieve")
    keyed = docs.withColumn(mark, F.struct(*[c.alias(n) for n, c in key.items()])).withColumn(f"{mark}_at", place)
    keyed = keyed.join(F.broadcast(sieve), F.shiftright(at, 15) == F.col(f"{mark}_part"), "left")   # at most SIEVE_BITS / SEGMENT rows of 4 KB
    byte = F.substring(f"{mark}_bits", (at.bitwiseAND(F.lit(SEGMENT - 1)) / 8).cast("int") + 1, F.lit(1))
    known = F.coalesce(F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1, F.lit(False))
    same = reduce(lambda a, b: a & b, [F.col(f"{mark}.{c}").eqNullSafe(F.col(f"{mark}_{c}")) for c in key])
    out = [F.col(f"`{c}`") for c in names]
    free, held = keyed.where(~known).select(*out), keyed.where(known)
    once = free.unionByName(held.join(keys, same, "left_anti").select(*out))
    repeated = keys.where(kept & (copies > 1))
    if repeated.isEmpty():
        return once
    least = held.join(repeated, same, "left_semi").groupBy(mark).agg(F.min(F.struct(*out)).alias(f"{mark}_row"))
    return once.unionByName(least.select(*[F.col(f"{mark}_row").getField(c).alias(c) for c in names]))


#: Bits of one of Spark's bitmaps.
SEGMENT = 32768
