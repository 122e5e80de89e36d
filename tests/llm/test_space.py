import random

from pyspark.sql import functions as F
from ridestar.llm import space


def test_decisions_on_keys(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(400)]), rng.choice("abc"), i % 3) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __key_at int").repartition(4)
    counts = {}
    for d, t, _ in rows:
        counts[d, t] = counts.get((d, t), 0) + 1
    decided = {k: rng.random() < 0.5 for k in counts if rng.random() < 0.6}
    keys = spark.createDataFrame([(d, t, counts[d, t], kept) for (d, t), kept in decided.items()],
                                 "doc_id long, text string, copies long, kept boolean")
    out = space.stay(docs, {"doc_id": F.col("doc_id"), "text": F.col("text")}, keys)
    assert out.columns == docs.columns
    want = []
    for k in counts:
        own = sorted(r for r in rows if r[:2] == k) if k[0] is not None else sorted((r for r in rows if r[:2] == k), key=lambda r: r[1:])
        if k not in decided:
            want += own
        elif decided[k]:
            want += own[:1]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_rows_without_a_decision_are_not_shuffled(spark, tmp_dir):
    spark.range(5000).selectExpr("id doc_id", "repeat('x', 50) text").write.parquet(f"{tmp_dir}/docs")
    docs = spark.read.parquet(f"{tmp_dir}/docs")
    keys = space.written(spark.range(3).selectExpr("id doc_id", "1L copies", "false kept"), "keys")
    out = space.stay(docs, {"doc_id": F.col("doc_id")}, keys)
    assert out.count() == 4997 and space.stay(docs, {"doc_id": F.col("doc_id")}, keys.where("false")).count() == 5000
    left = out._jdf.queryExecution().optimizedPlan().toString().split("Union")[1]
    assert "Join LeftOuter" in left and "rightHint=(strategy=broadcast)" in left
