"""Staging parse: JSON strictness, safe casts, quarantine reasons, dedup order."""

from helpers import bronze, ts

from ridestar.plans import staging
from ridestar.streaming.bronze_job import split_valid

CASES = [
    # value, expected reason, trip_id, price, visibility_1
    ('{"id":"a","price":12.5,"distance":1.1,"surge_multiplier":1.0,"visibility.1":9.5}', None, "a", 12.5, 9.5),
    ("{bad", "malformed_json", None, None, None),
    ('{"price":5}', "missing_id", None, 5.0, None),
    ('{"id":null}', "missing_id", None, None, None),
    ('{"id":"b","price":"abc"}', None, "b", None, None),
    ('{"id":"c","price":"12.5"}', None, "c", 12.5, None),
    ('{"id":"d","price":NaN}', "malformed_json", None, None, None),
    ("{'id':'d2','price':1}", "malformed_json", None, None, None),
    ('{"id":"e","source":{"x":1}}', None, "e", None, None),
    ('{"id":"f","price":"3d"}', None, "f", None, None),
    ("5", "missing_id", None, None, None),
    ("", "malformed_json", None, None, None),
    ('{"id":"g","price":1.5}   ', None, "g", 1.5, None),
]


def test_payload_cases(spark):
    b = bronze(spark, [(v, 0, i, ts()) for i, (v, *_rest) in enumerate(CASES)])
    out = {r["kafka_offset"]: r for r in staging.parse_events(b, with_reason=True).collect()}
    for i, (value, reason, tid, price, vis1) in enumerate(CASES):
        r = out[i]
        assert r["reject_reason"] == reason, value
        assert r["trip_id"] == tid, value
        assert r["price"] == price, value
        assert r["visibility_1"] == vis1, value
    assert out[8]["source_neighborhood"] is None  # object in a text field


def test_integer_fields(spark):
    b = bronze(spark, [('{"id":"h","hour":9,"day":"9","month":9.0}', 0, 0, ts()),
                       ('{"id":"i","hour":true,"day":" 7 ","month":"x"}', 0, 1, ts())])
    rows = {r.trip_id: r for r in staging.parse_events(b).collect()}
    # 9.0 is an integral JSON number: both parse paths read it as 9
    assert (rows["h"].trip_hour, rows["h"].trip_day, rows["h"].trip_month) == (9, 9, 9)
    assert (rows["i"].trip_hour, rows["i"].trip_day, rows["i"].trip_month) == (None, 7, None)


def test_fast_and_exact_paths_agree(spark):
    """A text field starting with '{' forces the exact path; values must equal the fast path's."""
    plain = '{"id":"j","price":7.25,"source":"Back Bay","hour":3}'
    forced = '{"id":"j","price":7.25,"source":"Back Bay","hour":3,"destination":"{x"}'
    b = bronze(spark, [(plain, 0, 0, ts()), (forced, 0, 1, ts())])
    rows = sorted(staging.parse_events(b).collect(), key=lambda r: r.kafka_offset)
    assert rows[0].price == rows[1].price == 7.25
    assert rows[0].source_neighborhood == rows[1].source_neighborhood == "Back Bay"
    assert rows[1].destination_neighborhood == "{x"


def test_latest_wins_with_total_order(spark):
    b = bronze(spark, [
        ('{"id":"a","price":12.5}', 0, 1, ts(0)),
        ('{"id":"a","price":13.0}', 0, 2, ts(5)),     # later timestamp wins
        ('{"id":"b","price":1.0}', 0, 7, ts(0)),
        ('{"id":"b","price":2.0}', 1, 3, ts(0)),      # same timestamp, higher partition wins
        ('{"id":"c","price":1.0}', 2, 3, ts(0)),
        ('{"id":"c","price":3.0}', 2, 4, ts(0)),      # same timestamp and partition, higher offset wins
        ('{"price":9}', 0, 9, ts(9)),                  # no id: dropped
    ])
    got = {r.trip_id: r.price for r in staging.stg_events(b).collect()}
    assert got == {"a": 13.0, "b": 2.0, "c": 3.0}


def test_dedup_idempotent(spark):
    b = bronze(spark, [('{"id":"a","price":%d}' % i, i % 2, i, ts(i % 3)) for i in range(20)])
    once = staging.stg_events(b)
    from ridestar.operators.dedup import dedup_latest

    twice = dedup_latest(once, ["trip_id"], staging.DEDUP_ORDER)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_split_is_a_partition_of_input(spark):
    vals = [c[0] for c in CASES]
    b = bronze(spark, [(v, 0, i, ts()) for i, v in enumerate(vals)])
    good, bad = split_valid(b)
    g = {r.kafka_offset for r in good.collect()}
    d = {r.offset for r in bad.collect()}
    assert g.isdisjoint(d)
    assert g | d == set(range(len(vals)))
