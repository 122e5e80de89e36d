"""Connected components of a graph too large for one machine: alternating star operations.

``large star`` links every larger neighbour of a node to the least neighbour, ``small star``
every smaller one; alternating them turns each component into a star about its least
node. Both are an aggregate (combined map-side) and a join per step; no
neighbour list is ever gathered. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridestar.llm.space import written

MAX_ROUNDS = 60


def _to_least(pairs: DataFrame) -> DataFrame:
    """Of rows (a, b): b linked to the least of a's neighbours and a itself."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    return pairs.join(least, F.col("a") == F.col("n"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); the component is its least node."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "links")
    before = _state(now)
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: rows have a > b, so a's neighbours here are the smaller ones
        joined = _to_least(large)
        small = (joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(joined.select("a", F.col("m").alias("b"))).distinct())
        now = written(small, "links")
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no convergence in {MAX_ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
