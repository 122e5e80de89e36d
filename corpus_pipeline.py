"""The corpus pipeline: documents in, token digests of the training mixture out.

Each stage calls one operator of ``ridestar.llm``. It takes ``(spark, docs, sf_dir)`` and returns a
DataFrame; that is written as Parquet in the shared folder and reread as the next stage's
``docs``. All but the last return the columns of ``documents``; every stage works on all rows its
predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridestar.llm.bpe import token_digests
from ridestar.llm.exact_dedup import exact_dedup
from ridestar.llm.mixing import mix
from ridestar.llm.ngram_join import near_dedup
from ridestar.llm.quality import keep_good
from ridestar.llm.queries import MAX_REPEATS, vocabulary
from ridestar.llm.space import table, written
from ridestar.session import bound_batches


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    bound_batches(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text one stays."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard similarity 0.8 or more) one stays."""
    bound_batches(spark)
    return near_dedup(docs, k=5, num=80, den=100)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources repeat, up to ``MAX_REPEATS`` epochs; every document is there at least once."""
    return mix(docs, max_repeats=MAX_REPEATS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text of every row."""
    bound_batches(spark)
    return token_digests(docs, vocabulary())


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("source_mixing", mixture),
    ("bpe", tokens),
]

#: A trained classifier has no SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
