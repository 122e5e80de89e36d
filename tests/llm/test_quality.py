import numpy as np
import pyarrow as pa
import pytest
from fixtures import SCHEMA, SF, awkward, empty, prose

from pyspark.sql import functions as F
from ridestar.llm.quality import (THRESHOLD, WIDTH, estimate_prior, features, fit, held_out, keep_good, quality_scores, score,
                                  train)

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n=600):
    good = prose(n, 1, vocabulary=2000, low=20, high=80)
    docs, labels = [], []
    for i, text in enumerate(good):
        bad = i % 5 == 0
        text = " ".join(w.upper() + "!!" for w in text.split(" ")) if bad else text
        docs.append((i, text, "en", "s", 1))
        if i % 2:
            labels.append((i, int(not bad), 0))
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy_on_given_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert len(rows) > 500 and right >= 0.95
    good = [r.predicted for r in rows if r.quality == 1]
    assert sum(good) / len(good) >= 0.98


def test_scores_are_those_of_the_model_on_whole_texts(spark):
    docs, labels = corpus(spark)
    model = train(docs, labels)
    got = {r.doc_id: r.score for r in score(docs.repartition(7), model).collect()}
    for r in docs.collect():
        x = features(pa.array([r.text], pa.large_string())).astype(float)
        assert abs(got[r.doc_id] - model.scores(x)[0]) < 1e-9
    bad = [got[i] for i in got if i % 5 == 0]
    good = [got[i] for i in got if i % 5]
    assert np.mean(np.array(good) >= THRESHOLD) > 0.8 and np.mean(np.array(bad) >= THRESHOLD) < 0.05
    assert np.median(bad) < 0.3 < 0.7 < np.median(good)


def test_held_out_and_negative_labels_are_not_read(spark):
    docs, labels = corpus(spark)
    want = sorted(map(tuple, quality_scores(docs, labels).collect()))
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(tuple, quality_scores(docs, flipped).collect())) == want
    # a label of 0 is as good as none
    unsaid = labels.where("doc_id % 4 <> 1").withColumn("quality", F.when(F.col("quality") == 1, 1))
    said = labels.where("doc_id % 4 <> 1")
    assert sorted(map(tuple, quality_scores(docs, unsaid).collect())) == sorted(map(tuple, quality_scores(docs, said).collect()))
    extra = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y"))
    assert sorted(map(tuple, quality_scores(extra, labels).collect())) == want


def test_the_non_negative_risk_finds_positives_without_negatives():
    rng = np.random.default_rng(0)
    p = rng.normal(size=(800, 4)) + [2, 0, 0, 0]
    n = rng.normal(size=(400, 4)) - [2, 0, 0, 0]
    u = np.concatenate([rng.normal(size=(600, 4)) + [2, 0, 0, 0], n])
    prior = estimate_prior(np.hstack([p, np.ones((800, 1))]), np.hstack([u, np.ones((1000, 1))]))
    assert 0.5 < prior < 0.75
    model = fit(p, u)
    assert (model.scores(n) < 0.5).mean() > 0.93 and (model.scores(p) > 0.5).mean() > 0.93
    assert abs(model.prior - prior) < 0.15


def test_few_or_no_labels(spark):
    docs, labels = corpus(spark, 40)
    none = labels.where("false")
    assert quality_scores(docs, none).where("score between 0 and 1").count() == 40
    both = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (5, None, 0)], LABELS)
    assert quality_scores(docs, both).count() == 40


def test_all_rows_stay_if_nothing_was_fitted(spark):
    docs, labels = corpus(spark, 40)
    assert sorted(keep_good(docs, labels.where("false")).collect()) == sorted(docs.collect())
    every = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")   # only rows of the held-out fold are without a label in use
    learnt = docs.where(~held_out(F.col("doc_id")))
    assert keep_good(learnt, every).count() == learnt.count()


def test_bound_on_rows(spark):
    docs, labels = corpus(spark)
    model = train(docs, labels, max_rows=50)
    assert model.weights.shape == (WIDTH,)


def test_awkward_rows_and_kept_columns(spark):
    _, labels = corpus(spark, 40)
    df = awkward(spark, "1 as score;2 as part;3 as id;4 as x")
    got = quality_scores(df, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= THRESHOLD) for r in rows)
    kept = keep_good(df, labels)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.predicted for r in rows)
    assert quality_scores(empty(spark), labels).count() == 0 and keep_good(empty(spark), labels).count() == 0


@pytest.mark.parametrize("texts", [[], [""], ["", "a"], ["\n\n"], ["é" * 5, "x " * 3]])
def test_features_of_odd_texts(texts):
    x = features(pa.array(texts, pa.large_string()))
    assert x.shape == (len(texts), WIDTH) and np.isfinite(x).all()


def test_given_documents_at_the_smallest_size(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    assert quality_scores(docs, labels).count() == docs.count()
