"""Selection equals the percentile aggregate on any distribution, with few values left to count."""

import pytest

from pyspark.sql import functions as F
from ridestar.operators.median import exact_percentile, select_rank

CASES = {
    "uniform": "rand(3)",
    "spread": "pow(10.0, 600 * rand(4) - 300)",
    "hot": "case when id % 3 = 0 then 42.0 else 100 * rand(5) end",
    "few": "cast(id % 7 as double)",
    "one": "3.5D",
    "signs": "randn(6)",
}


@pytest.mark.parametrize("kind", CASES)
@pytest.mark.parametrize("q", [0.5, 0.93])
def test_equals_the_aggregate(spark, tmp_dir, kind, q):
    spark.range(40_001).selectExpr(f"case when id % 11 = 0 then null else {CASES[kind]} end as x").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    want = df.agg(F.percentile("x", F.lit(q))).first()[0]
    assert exact_percentile(df, F.col("x"), q, few=50, accuracy=200) == pytest.approx(want, rel=1e-12)


def test_small_and_empty_inputs(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (None,)], "x double")
    assert exact_percentile(df, F.col("x"), 0.5) == 2.5 and exact_percentile(df, F.col("x"), 0.0) == 1.0
    assert exact_percentile(df.where("false"), F.col("x"), 0.5) is None
    with pytest.raises(ValueError):
        select_rank(df.where("x is not null").toDF("v"), 2)
