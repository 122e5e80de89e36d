"""The links of the n-gram join themselves: verified pairs of classes, and the class of every document.

Documents with equal shingle sets form a class, so copies are not expanded into pairs: a link between two texts is
the pair of their classes. The join of ``ngram_join`` leaves out pairs within a component it knows; here all classes are
matched with each other by the same adaptive multi-match prefixes, and every pair that passes is verified on whole sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridestar.llm import chunks as C
from ridestar.llm.ngram_join import _cross_pairs, _row_key, class_sets, hopeful, postings, profiles, shingle_levels, verified
from ridestar.llm.space import written


def near_links(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """(pairs, members) of ``docs`` (doc_id, text).

    ``pairs``: one, two (doc_ids of the classes' representatives: their least ids, nulls last), class_one, class_two; each
    linked pair of classes once. ``members``: doc_id, class, n_shingles and links, the number of other rows that the row is
    linked with, for every row; a row without words has class NULL and no links, one with copies is linked with each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    staged = C.stage(docs.select("doc_id", *_row_key(), "text"))
    rows = written(profiles(staged, shingle_levels(staged, k), k, num, den, kind), "link-profiles")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("rep"), "body", "id_key")
    classes = (rows.where("n > 0").groupBy("hi", "lo", "n")
               .agg(F.min(first).alias("first"), F.min("matches").alias("matches"), F.min("prefix").alias("prefix"),
                    F.count(F.lit(1)).alias("rows"))
               .select(F.col("hi").alias("c"), "hi", "lo", "n", "matches", "prefix", "rows", "first.rep", "first.body", "first.id_key"))
    classes = written(classes, "link-classes")
    posts = written(hopeful(postings(classes), classes, num, den), "link-postings")
    apart = docs.sparkSession.createDataFrame([], "node long, component long")   # every class is a part of its own
    pairs = written(_cross_pairs(posts, apart, num, den), "link-pairs")
    met = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = written(met.join(classes, F.col("id") == F.col("c")).select("id_key", "body"), "link-wanted")
    found = written(verified(pairs, written(class_sets(docs, wanted, k), "link-sets"), num, den), "links")

    def rep(side: str, name: str) -> DataFrame:
        return classes.select(F.col("c").alias(side), F.col("rep").alias(name))

    named = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(rep("a", "one"), "a").join(rep("b", "two"), "b")
    sizes = classes.select(F.col("c").alias("other"), "rows")
    both = found.select(F.col("a").alias("c"), F.col("b").alias("other")).union(found.select("b", "a"))
    near = both.join(sizes, "other").groupBy("c").agg(F.sum("rows").alias("near"))
    counted = classes.select("c", "hi", "lo", "n", "rows").join(near, "c", "left").select(
        F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), F.col("n").alias("n2"), F.col("c").alias("class"),
        (F.col("rows") - 1 + F.coalesce("near", F.lit(0))).alias("links"))
    same = (F.col("hi") == F.col("hi2")) & (F.col("lo") == F.col("lo2")) & (F.col("n") == F.col("n2"))
    members = rows.join(counted, same, "left").select(
        "doc_id", "class", F.col("n").alias("n_shingles"), F.coalesce("links", F.lit(0)).alias("links"))
    return named.select("one", "two", F.col("a").alias("class_one"), F.col("b").alias("class_two")), members
