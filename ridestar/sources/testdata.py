"""Trip-shaped and topic-shaped views over the driver's TPC-H-like tables.

The given tables hold no rides, so rides are derived from them deterministically:
one trip event per lineitem (id = order-line, repeated ids make the dedup real),
with the customer's nation as source and the supplier's as destination. The event
topic is derived from ``events``. Every view is lazy and grows with its inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridestar.functions.time import ntz_to_instant, wall_clock_text
from ridestar.spec import TOPIC_PARTITIONS

TIMEZONE = "America/New_York"

#: Suppliers (two numbers each, some tens of bytes) are broadcast up to this many, so that no line item is shuffled for them.
BROADCAST_SUPPLIERS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _provider(p_type: Column) -> Column:
    # Two real providers and one unknown value, so provider checks have work to do.
    return (
        F.when(p_type.isin("ECONOMY", "STANDARD", "PROMO"), F.lit("Uber"))
        .when(p_type.isin("SMALL", "MEDIUM"), F.lit("Lyft"))
        .otherwise(p_type)
    )


def trip_rows(spark: SparkSession, sf_dir: str, by_partition: bool = False) -> DataFrame:
    """Typed trip rows (payload keys as columns) plus Kafka metadata columns.

    Join plan: line items meet parts while they are narrowest, then orders that have met their customers (sort-merge or AQE's
    choice). Suppliers are broadcast if they are few (``BROADCAST_SUPPLIERS``); other broadcasts are left to the planner (only
    under Spark's size threshold). Names of nations come last, so no shuffle holds them.

    ``by_partition``: the rows of a topic partition lie in one task. They are shuffled before the payload is made of them.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    if supp.limit(BROADCAST_SUPPLIERS + 1).count() <= BROADCAST_SUPPLIERS:
        supp = F.broadcast(supp)
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    src_nation = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("src_name"))
    dst_nation = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("dst_name"))

    # orders, the narrower table, meets the customers, so line items are shuffled for parts and orders only
    ordered = orders.join(cust, F.col("o_custkey") == cust.c_custkey).drop("o_custkey", "c_custkey")
    j = (
        li.join(part, F.col("l_partkey") == part.p_partkey).drop("p_partkey")
        .join(ordered, li.l_orderkey == ordered.o_orderkey)
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("partition", F.col("l_suppkey").cast("int"))
    )
    if by_partition:
        j = j.repartition("partition")
    j = j.join(src_nation, "c_nationkey").join(dst_nation, "s_nationkey")

    trip_dt = F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("o_orderdate"))
    temperature = F.when(F.col("l_linenumber") == 6, F.lit(None).cast("double")).otherwise(
        F.lit(20.0) + F.lit(600.0) * F.col("l_discount")
    )
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), trip_dt)
        .cast("double").alias("timestamp"),
        F.hour(trip_dt).cast("bigint").alias("hour"),
        F.dayofmonth(trip_dt).cast("bigint").alias("day"),
        F.month(trip_dt).cast("bigint").alias("month"),
        wall_clock_text(trip_dt).alias("datetime"),
        F.lit(TIMEZONE).alias("timezone"),
        F.col("src_name").alias("source"),
        F.col("dst_name").alias("destination"),
        _provider(F.col("p_type")).alias("cab_type"),
        F.col("p_brand").alias("product_id"),
        F.col("l_returnflag").alias("name"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")).alias("price"),
        F.col("l_quantity").alias("distance"),
        (F.lit(1.0) + F.col("l_tax")).alias("surge_multiplier"),
        (F.lit(41.0) + F.col("c_nationkey") / F.lit(12.5)).alias("latitude"),
        (F.lit(-72.0) + F.col("c_nationkey") / F.lit(12.5)).alias("longitude"),
        temperature.alias("temperature"),
        (temperature - F.lit(2.5)).alias("apparentTemperature"),
        F.col("c_mktsegment").alias("short_summary"),
        F.col("o_orderpriority").alias("long_summary"),
        (F.lit(0.5) + F.lit(5.0) * F.col("l_discount")).alias("humidity"),
        (F.lit(10.0) * F.col("l_tax")).alias("precipProbability"),
        (F.col("l_quantity") / F.lit(5.0)).alias("windSpeed"),
        (F.lit(10.0) - F.lit(100.0) * F.col("l_discount")).alias("visibility"),
        (F.lit(10.0) - F.lit(100.0) * F.col("l_discount")).alias("visibility.1"),
        F.col("l_linestatus").alias("icon"),
        (F.col("p_size") % 11).cast("double").alias("uvIndex"),
        (F.lit(300.0) + F.col("p_size")).alias("ozone"),
        # Kafka metadata: (id, timestamp, partition, offset) is a total order.
        "partition",
        F.col("l_partkey").alias("offset"),
        ntz_to_instant("l_shipdate").alias("kafka_timestamp"),
        ntz_to_instant(F.timestamp_add("MINUTE", F.col("l_partkey") % 200, F.col("l_shipdate"))).alias("ingestion_time"),
    )


PAYLOAD_KEYS_IN_TRIPS: tuple[str, ...] = (
    "id", "timestamp", "hour", "day", "month", "datetime", "timezone", "source", "destination",
    "cab_type", "product_id", "name", "price", "distance", "surge_multiplier", "latitude", "longitude",
    "temperature", "apparentTemperature", "short_summary", "long_summary", "humidity", "precipProbability",
    "windSpeed", "visibility", "visibility.1", "icon", "uvIndex", "ozone",
)


def trip_bronze(spark: SparkSession, sf_dir: str, by_partition: bool = False) -> DataFrame:
    """Bronze-shaped trip events: key, JSON value, partition, offset, timestamps.

    The value is the row as JSON with NULL fields kept (as the producer writes it). ``by_partition``: see ``trip_rows``.
    """
    rows = trip_rows(spark, sf_dir, by_partition)
    payload = F.struct(*[F.col(f"`{k}`") for k in PAYLOAD_KEYS_IN_TRIPS])
    from ridestar.functions.clean import event_key

    return rows.select(
        event_key("source").alias("key"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("value"),
        "partition",
        "offset",
        "kafka_timestamp",
        "ingestion_time",
    )


def trip_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trip_bronze`` as a topic numbers its messages: the offsets of each partition are dense and in the order given."""
    given = Window.partitionBy("partition").orderBy("offset", "kafka_timestamp", "value")
    return trip_bronze(spark, sf_dir, by_partition=True).withColumn("offset", F.row_number().over(given).cast("long"))


def event_topic(spark: SparkSession, sf_dir: str, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """The ``events`` table as a Kafka-like topic (binary key/value, partition, offset, timestamp).

    partition = event_id mod n, offset = event_id div n (ids are dense), key =
    event_type, value = the row as JSON, timestamp = ts read as UTC.
    """
    ev = table(spark, sf_dir, "events")
    body = F.to_json(
        F.struct("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                 "user_id", "event_type", "value", "props"),
        {"ignoreNullFields": "false"},
    )
    return ev.select(
        F.col("event_type").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % partitions).cast("int").alias("partition"),
        F.expr(f"event_id div {int(partitions)}").cast("bigint").alias("offset"),
        ntz_to_instant("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
