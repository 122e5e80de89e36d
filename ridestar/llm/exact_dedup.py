"""Exact duplicates with a heavy-hitter split, in DataFrame operations only.

1. Every text is read once: its normal form (all of ``[\\x20\\x09-\\x0D]`` deleted)
   gives a SHA-256 digest; a narrow table (row, doc_id, digest, length) is written.
2. A Misra-Gries summary (``approx_top_k``'s frequent-items sketch, built per task
   group and merged) names every digest holding more than about 1/``counters`` of
   the rows, along with false candidates.
3. The candidates' exact sizes and winners come from one aggregate over the narrow
   table (combined map-side); at most ``hot_digests`` of them are broadcast, and
   their rows are resolved where they lie, with no shuffle.
4. All other digests are too small to skew a shuffle and meet in a window.

Of equal texts the row with the most code points in the original text stays, then
the smallest doc_id (null: last), then one of the remaining identical rows. A
null text counts as empty; empty texts are equal to each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridestar.llm.space import stay, written

#: The characters of [\x20\x09-\x0D].
WHITE = " \t\n\x0b\f\r"


def normal_text(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), WHITE, "")


def narrow_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, digest, n_chars): all that the grouping needs, about 100 bytes a row."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        F.sha2(normal_text(F.col("text")), 256).alias("digest"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).alias("chars"),
    )


def frequent_digests(rows: DataFrame, hot_digests: int, counters: int, fan_in: int = 64) -> DataFrame:
    """Misra-Gries candidates, at most ``hot_digests`` rows: summaries per task, merged by groups, then once."""
    part = (rows.groupBy((F.spark_partition_id() % fan_in).alias("part"))
            .agg(F.expr(f"approx_top_k_accumulate(digest, {counters})").alias("sketch")))
    # keyed by a constant: an empty partition then hands on no (empty) summary
    merged = (part.groupBy(F.lit(0).alias("all"))
              .agg(F.expr(f"approx_top_k_combine(sketch, {counters})").alias("sketch")))
    return (merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {hot_digests})")).alias("top"))
            .select(F.col("top.item").alias("digest")).where(F.col("digest").isNotNull()))


def _rank() -> Column:
    """Largest first: length, then small doc_id (null last), then small row."""
    return F.struct(F.col("chars"), F.bitwise_not(F.col("doc_id")).alias("id"), F.bitwise_not(F.col("row")).alias("at"))


def exact_groups(docs: DataFrame, hot_digests: int = 1024, counters: int = 8192) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, digest, chars, keep_id, group_size, kept."""
    rows = written(narrow_rows(docs), "exact-rows")
    hot = frequent_digests(rows, hot_digests, counters)
    winners = written(
        rows.join(F.broadcast(hot), "digest")
        .groupBy("digest").agg(F.max(_rank()).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") > 1)
        .select("digest", F.bitwise_not(F.col("best.id")).alias("keep_id"),
                F.bitwise_not(F.col("best.at")).alias("keep_row"), "group_size"), "exact-winners")
    columns = ["row", "doc_id", "digest", "chars", "keep_id", "group_size", "kept"]
    large = (rows.join(F.broadcast(winners), "digest")
             .withColumn("kept", F.col("row") == F.col("keep_row")).select(*columns))
    same = Window.partitionBy("digest")
    best = same.orderBy(F.col("chars").desc(), F.col("doc_id").asc_nulls_last(), F.col("row"))
    small = (rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
             .withColumn("place", F.row_number().over(best))
             .withColumn("keep_id", F.first("doc_id").over(best))
             .withColumn("group_size", F.count(F.lit(1)).over(same))
             .withColumn("kept", F.col("place") == 1).select(*columns))
    return large.unionByName(small)


def exact_dedup(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows repeated as a whole one stays."""
    keys = (exact_groups(docs, **parameters).where(F.col("group_size") > 1).groupBy("doc_id", "digest", "chars")
            .agg(F.count(F.lit(1)).alias("copies"), F.max("kept").alias("kept")))
    return stay(docs, {"doc_id": F.col("doc_id"), "digest": F.sha2(normal_text(F.col("text")), 256),
                       "chars": F.length(F.coalesce(F.col("text"), F.lit("")))}, written(keys, "exact-keys"))
