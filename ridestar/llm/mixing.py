"""Mixing sources to target weights, in DataFrame operations only.

A source with share ``s`` of the words gets weight ``s^a / sum s^a``. The exponent ``a`` in
[0, 1] (0: all sources alike, 1: as they are) is found by bisection on a table of sources:
the least one that keeps every source within ``max_repeats`` epochs, or the one whose weights
have entropy ``target_entropy`` (nats). The budget in words defaults to the least one at which no
source falls under one whole epoch, so that nothing is dropped.

The weights are realised as block permutations. The documents of a source are dealt by a
hash of doc_id into blocks of about ``block_words`` words. A source takes all its blocks for each
whole epoch; for the remaining part of an epoch it takes blocks in the epoch's pseudo-random order
while they fit the budget, and of the block that no longer fits documents in their order
within the block. So prefix sums run over blocks, and over the documents of one block per source,
never over the documents of a whole source; a source holding a third of all rows is many blocks.

A null source is a source of its own. A null text counts as empty; a source without words keeps
each of its documents once. Rows that share a doc_id are taken or left together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridestar.llm.space import written

WORD = r"[^\x20\x09-\x0D]+"
BISECTIONS = 40
SEED = 11


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _number(*parts: Column) -> Column:
    """A number below 2^32 from a digest of the parts, the same in other engines."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def sources(docs: DataFrame, block_words: int) -> DataFrame:
    """source, words, docs, blocks."""
    return (docs.select("source", n_words(F.col("text")).alias("n")).groupBy("source")
            .agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("docs"))
            .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("words") / F.lit(block_words)).cast("long"))))


def exponent(table: DataFrame, max_repeats: float | None, target_entropy: float | None) -> float:
    """Bisects for the exponent; each step is one aggregate over the table of sources."""
    known = table.where(F.col("words") > 0)
    ends = known.agg(F.max("words").alias("most"), F.min("words").alias("least")).first()
    if ends["most"] is None:
        return 1.0
    share = F.col("words") / F.lit(float(ends["most"]))

    def enough(a: float) -> bool:
        """Whether the true exponent is at most ``a``."""
        if target_entropy is None:
            return (ends["most"] / ends["least"]) ** (1 - a) <= max_repeats
        w = F.pow(share, F.lit(a))
        z, wl = known.agg(F.sum(w), F.sum(w * F.log(share))).first()
        return math.log(z) - a * wl / z <= target_entropy

    low, high = 0.0, 1.0
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        low, high = (low, middle) if enough(middle) else (middle, high)
    return min(1.0, math.ceil(high * 1e6 - 1e-3) / 1e6)


def epochs(table: DataFrame, a: float, budget: float | None) -> DataFrame:
    """``table`` with weight, epochs (whole) and rest (words of the part of an epoch)."""
    first = table.agg(F.max("words").alias("most"), F.min(F.when(F.col("words") > 0, F.col("words"))).alias("least"))
    most, least = first.first()
    if not most:
        return (table.withColumn("weight", F.lit(0.0)).withColumn("epochs", F.lit(1).cast("long"))
                .withColumn("rest", F.lit(0).cast("long")))
    raw = F.pow(F.col("words") / F.lit(float(most)), F.lit(a))
    raw = F.when(F.col("words") > 0, raw).otherwise(F.lit(0.0))
    z = table.agg(F.sum(raw)).first()[0]
    # a source of t words and raw weight r takes r / z * budget words; by default the largest takes one epoch
    total = float(most) * z if budget is None else float(budget)
    real = raw / F.lit(z) * F.lit(total) / F.col("words")
    whole = F.floor(real + F.lit(1e-9)).cast("long")
    empty = F.col("words") == 0
    return (table.withColumn("weight", raw / F.lit(z))
            .withColumn("epochs", F.when(empty, F.lit(1)).otherwise(whole).cast("long"))
            .withColumn("rest", F.when(empty, F.lit(0)).otherwise(
                F.greatest(F.lit(0.0), F.round((real - whole) * F.col("words")))).cast("long")))


def _pieces(docs: DataFrame, max_repeats, target_entropy, budget, block_words, seed):
    """The plan of blocks and the documents taken from blocks that are cut, both written."""
    table = written(sources(docs, block_words), "mix-sources")
    plan = written(epochs(table, exponent(table, max_repeats, target_entropy), budget), "mix-weights")
    rows = (docs.select(F.col("doc_id"), F.col("source").alias("from"), n_words(F.col("text")).alias("n"))
            .join(plan.select(F.col("source").alias("of"), "blocks", "epochs", "rest"),
                  F.col("from").eqNullSafe(F.col("of")))
            .select("doc_id", "of", "n", "epochs", "rest", block(seed).alias("block")))
    rows = written(rows, "mix-rows")
    blocks = (rows.groupBy("of", "block").agg(F.sum("n").alias("words"), F.first("epochs").alias("epochs"),
                                              F.first("rest").alias("rest")))
    source = F.coalesce(F.col("of"), F.lit("null"))
    turn = Window.partitionBy("of").orderBy(
        _number(F.lit(str(seed)), F.lit("block"), F.col("epochs").cast("string"), source, F.col("block").cast("string")),
        "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = written(
        blocks.withColumn("before", F.coalesce(F.sum("words").over(turn), F.lit(0)))
        .withColumn("left", F.col("rest") - F.col("before"))
        .withColumn("part", F.when((F.col("words") <= F.col("left")) & (F.col("rest") > 0), F.lit("all"))
                    .when(F.col("left") > 0, F.lit("cut")).otherwise(F.lit("none")))
        .select("of", "block", "epochs", "left", "part"), "mix-blocks")
    within = Window.partitionBy("of", "block").orderBy("at", "id").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    cut = (rows.drop("epochs", "rest").join(
               blocks.where(F.col("part") == "cut").withColumnRenamed("of", "of2").withColumnRenamed("block", "block2"),
               F.col("of").eqNullSafe(F.col("of2")) & (F.col("block") == F.col("block2")))
           .withColumn("id", _id(F.col("doc_id")))
           .withColumn("at", _number(F.lit(str(seed)), F.lit("doc"), F.col("epochs").cast("string"), F.col("id"))))
    taken = written(cut.withColumn("upto", F.sum("n").over(within)).where(F.col("upto") <= F.col("left"))
                    .select("of", "block", "id").distinct(), "mix-cut")
    return plan, blocks, taken


def block(seed: int) -> Column:
    """The block of a row that has doc_id and blocks."""
    return F.pmod(_number(F.lit(str(seed)), _id(F.col("doc_id"))), F.col("blocks"))


def _mixed(docs: DataFrame, max_repeats: float | None, target_entropy: float | None, budget: float | None, block_words: int,
           seed: int) -> DataFrame:
    """``row``, a row of ``docs`` as a struct, and ``mix``, what the mixture makes of it: no name of ``docs`` can clash."""
    if (max_repeats is None) == (target_entropy is None):
        raise ValueError("give max_repeats or target_entropy")
    plan, blocks, taken = _pieces(docs, max_repeats, target_entropy, budget, block_words, seed)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col("doc_id"), F.col("source").alias("from"))
    rows = (rows.join(plan.select(F.col("source").alias("of"), "weight", "words", "blocks"),
                      F.col("from").eqNullSafe(F.col("of")))
            .withColumn("block", block(seed)).withColumn("id", _id(F.col("doc_id"))))
    by_block = blocks.select(F.col("of").alias("of2"), F.col("block").alias("block2"), "epochs", "part")
    rows = rows.join(by_block, F.col("of").eqNullSafe(F.col("of2")) & (F.col("block") == F.col("block2")))
    by_doc = taken.select(F.col("of").alias("of3"), F.col("block").alias("block3"), F.col("id").alias("id3"),
                          F.lit(True).alias("in_cut"))
    rows = rows.join(by_doc, F.col("of").eqNullSafe(F.col("of3")) & (F.col("block") == F.col("block3"))
                     & (F.col("id") == F.col("id3")), "left")
    more = F.when(F.col("part") == "all", 1).when(F.col("in_cut"), 1).otherwise(0)
    return rows.select("row", F.struct(
        "weight", F.col("words").alias("source_words"), "block", (F.col("epochs") + more).alias("copies")).alias("mix"))


def mixture(docs: DataFrame, max_repeats: float | None = 2.0, target_entropy: float | None = None,
            budget: float | None = None, block_words: int = 1 << 20, seed: int = SEED) -> DataFrame:
    """``docs`` with a struct column ``mix``: weight and words of the source, block, copies of the row (0: left out).

    One of ``max_repeats`` and ``target_entropy`` is given; the other is None. A column ``mix`` already there is an error.
    """
    if "mix" in {c.lower() for c in docs.columns}:
        raise ValueError("docs already has a column mix")
    return _mixed(docs, max_repeats, target_entropy, budget, block_words, seed).select("row.*", "mix")


def mix(docs: DataFrame, max_repeats: float | None = 2.0, target_entropy: float | None = None,
        budget: float | None = None, block_words: int = 1 << 20, seed: int = SEED) -> DataFrame:
    """The mixed rows themselves: each row of ``docs`` as many times as the mixture takes it, whatever its columns' names."""
    out = _mixed(docs, max_repeats, target_entropy, budget, block_words, seed)
    copies = F.array_repeat(F.lit(0), F.col("mix.copies").cast("int"))
    return out.select("row", F.explode(copies).alias("copy")).select("row.*")


def schedule(docs: DataFrame, seed: int = SEED, **parameters) -> DataFrame:
    """The mixed rows in training order: ``docs``' columns with ``epoch`` and ``place``; sort by both.

    An epoch's order permutes blocks, then documents within a block, afresh per epoch. Rows
    of the last part of an epoch have the number of whole epochs as theirs.
    """
    out = mixture(docs, seed=seed, **parameters).where(F.col("mix.copies") > 0)
    out = out.withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.col("mix.copies") - 1).cast("int"))))
    e, b = F.col("epoch").cast("string"), F.col("mix.block").cast("string")
    source = F.coalesce(F.col("source"), F.lit("null"))
    place = F.struct(_number(F.lit(str(seed)), F.lit("block"), e, source, b).alias("block"),
                     _number(F.lit(str(seed)), F.lit("doc"), e, _id(F.col("doc_id"))).alias("doc"))
    return out.withColumn("place", place).drop("mix")
