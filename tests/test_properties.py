"""Property tests: pre-aggregated star join = join then aggregate; dedup = per-key max; parse paths agree."""

import json

from helpers import bronze, staging_rows, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from ridestar.operators.star import Dim, Measure, star_aggregate
from ridestar.plans import staging

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

facts = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3", None]), st.sampled_from(["c1", "c2"]),
                           st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False).map(lambda x: round(x, 2)))),
                 min_size=0, max_size=40)
dims = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k4"]), st.sampled_from(["g1", "g2"])), min_size=0, max_size=6)


@SETTINGS
@given(facts, dims)
def test_star_aggregate_matches_naive(spark, fact_rows, dim_rows):
    fact = spark.createDataFrame(fact_rows, "fk string, ck string, x double")
    dim = spark.createDataFrame(dim_rows, "pk string, grp string")       # duplicate keys fan out
    got = star_aggregate(fact, [Dim(dim, "fk", "pk", {"grp": "grp"})], ["grp"],
                         [Measure("n", "count", F.col("x")), Measure("pos", "count_if", F.col("x") > 0),
                          Measure("s", "sum", F.col("x")), Measure("mx", "max", F.col("x")),
                          Measure("mean", "avg", F.col("x"))])
    naive = fact.join(dim, fact.fk == dim.pk).groupBy("grp").agg(
        F.count("x").alias("n"), F.count_if(F.col("x") > 0).alias("pos"), F.sum("x").alias("s"),
        F.max("x").alias("mx"), F.avg("x").alias("mean"))

    def norm(df):
        return sorted((r.grp, r.n, r.pos, None if r.s is None else round(r.s, 6), r.mx,
                       None if r.mean is None else round(r.mean, 6)) for r in df.collect())

    assert norm(got) == norm(naive)


events = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3), st.integers(0, 2),
                            st.integers(0, 1000)), min_size=1, max_size=30, unique_by=lambda t: (t[2], t[3]))


@SETTINGS
@given(events)
def test_dedup_is_max_of_total_order(spark, evs):
    b = bronze(spark, [(json.dumps({"id": i, "price": o}), p, o, ts(m)) for i, m, p, o in evs])
    got = {r.trip_id: (r.kafka_partition, r.kafka_offset) for r in staging.stg_events(b).collect()}
    want = {}
    for i, m, p, o in evs:
        if i not in want or (m, p, o) > want[i][0]:
            want[i] = ((m, p, o), (p, o))
    assert got == {k: v[1] for k, v in want.items()}


text = st.text(alphabet=st.sampled_from(list("ab {}[]x1.")), max_size=6)
payloads = st.fixed_dictionaries({
    "id": st.text(alphabet="abc123", min_size=1, max_size=4),
    "price": st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
    "hour": st.one_of(st.none(), st.integers(-5, 30)),
    "source": st.one_of(st.none(), text),
    "surge_multiplier": st.one_of(st.none(), st.floats(0, 5, allow_nan=False)),
})


@SETTINGS
@given(st.lists(payloads, min_size=1, max_size=12))
def test_fast_path_equals_exact_path(spark, rows):
    """Every payload parsed normally and with a trailing '{' text field (forces the exact path)."""
    plain = [json.dumps(r) for r in rows]
    forced = [json.dumps(dict(r, timezone="{")) for r in rows]
    b = bronze(spark, [(v, 0, i, ts()) for i, v in enumerate(plain + forced)])
    out = sorted(staging.parse_events(b).collect(), key=lambda r: r.kafka_offset)
    n = len(rows)
    for a, e in zip(out[:n], out[n:]):
        assert (a.trip_id, a.price, a.trip_hour, a.source_neighborhood, a.surge_multiplier) == \
               (e.trip_id, e.price, e.trip_hour, e.source_neighborhood, e.surge_multiplier)
        assert e.timezone == "{"
