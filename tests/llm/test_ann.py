import math

import numpy as np
import pytest
from fixtures import SF

from ridestar.llm.ann import Graph, _sample, balanced_centroids, search, valid_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"
EVERY_20TH = "vec_id % 20 = 0"


def brute(rows, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i, v in zip(ids, x):
        if i % 20 == 0:
            s = np.array([math.fsum(r) for r in (x * v).tolist()])
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df, **kw):
    out = {}
    for r in sorted(search(df, EVERY_20TH, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want]
    return sum(hits) / len(hits)


def frame(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(x)], SCHEMA)


def rows_of(df):
    return [(r.vec_id, r.embedding) for r in df.collect()]


def test_small_tables_are_exact(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert found(df) == brute(rows_of(df))


@pytest.mark.parametrize("kind", ["clusters", "uniform", "norms", "hot"])
def test_recall_over_many_lists(spark, kind):
    rng = np.random.default_rng(1)
    n, w = 3000, 16
    x = rng.normal(size=(n, w))
    if kind in ("clusters", "norms"):
        x = rng.normal(size=(40, w))[rng.integers(40, size=n)] + 0.3 * x
    if kind != "norms":
        x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "hot":
        x[: n // 3] = x[0] + 0.001 * rng.normal(size=(n // 3, w))
    df = frame(spark, x.astype(np.float32)).repartition(6)
    got, want = found(df, list_rows=100), brute(rows_of(df))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    exact = {q: dict(v) for q, v in brute(rows_of(df), 3000).items()}
    assert all(exact[q][i] == s for q, v in got.items() for i, s in v)


def test_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(2)
    x = np.repeat(rng.integers(-2, 3, size=(30, 4)), 40, axis=0) + 0.0
    x[(x == 0).all(1)] = 1.0
    df = frame(spark, x)
    assert found(df) == brute(rows_of(df))
    got = found(df, list_rows=50, recall=1.0)
    assert all(v == sorted(v, key=lambda e: (-e[1], e[0])) for v in got.values())


def test_vectors_that_take_no_part(spark):
    good = [(i, [float(i % 7 + 1), 1.0], 0) for i in range(0, 60)]
    bad = [(100, None, 0), (120, [0.0, 0.0], 0), (140, [1.0, None], 0), (160, [float("nan"), 1.0], 0),
           (180, [float("inf"), 1.0], 0), (None, [1.0, 1.0], 0), (200, [], 0)]
    df = spark.createDataFrame(good + bad + good[:3], SCHEMA)
    clean = spark.createDataFrame(good, SCHEMA)
    assert valid_vectors(df).count() == 63
    assert found(df) == brute(rows_of(clean))


def test_each_length_is_searched_among_its_own(spark):
    rng = np.random.default_rng(8)
    wide, flat = rng.normal(size=(90, 5)), rng.normal(size=(60, 3))
    rows = [(2 * i, [float(c) for c in v], 0) for i, v in enumerate(wide)]
    few = [(2 * i + 20, [float(c) for c in v], 0) for i, v in enumerate(flat)] + [(1000, [1.0], 0)]
    want = {**brute([(i, v) for i, v, _ in rows])}
    # an id that both lengths ask for is answered for each of them
    got = sorted(map(tuple, search(spark.createDataFrame(rows + few, SCHEMA).repartition(3), EVERY_20TH).collect()))
    other = brute([(i, v) for i, v, _ in few[:-1]])
    flat_rows = [(q, r, i, s) for w in (want, other) for q, near in w.items() for r, (i, s) in enumerate(near, 1)]
    # SCHEMA holds floats: scores of the given doubles agree to their precision
    assert [x[:3] for x in got] == [x[:3] for x in sorted(flat_rows)]
    assert np.allclose([x[3] for x in got], [x[3] for x in sorted(flat_rows)], rtol=1e-5)


def test_the_sample_does_not_follow_the_layout_of_the_table(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(400, 8)) * 0.1 + 3 * rng.normal(size=8) for _ in range(10)])
    df = frame(spark, x.astype(np.float32))
    rows = valid_vectors(df)
    one, two = ({r.vec_id for r in _sample(d, 4000, 500, 1).collect()} for d in (rows.coalesce(1), rows.repartition(7)))
    assert one == two and len(one) == 500
    assert min(sum(i // 400 == c for i in one) for c in range(10)) > 20      # a table sorted by cluster: all are there
    got, want = found(df.coalesce(1), list_rows=100), brute(rows_of(df))
    assert recall(got, want) >= 0.9


def test_few_and_no_rows(spark):
    assert search(spark.createDataFrame([], SCHEMA), EVERY_20TH).count() == 0
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (20, [0.0, 1.0], 0)], SCHEMA)
    assert found(df) == {0: [(1, 0.5), (20, 0.0)], 20: [(1, 0.5), (0, 0.0)]}
    assert found(df.limit(1)) == {}


def test_graph_search_finds_what_a_scan_finds():
    rng = np.random.default_rng(4)
    c = np.concatenate([rng.normal(size=(60, 5)), rng.normal(size=(60, 5)) + 50])
    g = Graph(c)
    hits = total = 0
    for x in rng.normal(size=(100, 5)) + rng.integers(0, 2, size=(100, 1)) * 50:
        d = np.sqrt(((c - x)**2).sum(1))
        want = set(np.flatnonzero(d <= 1.3 * d.min()).tolist())
        hits += len(want & set(g.search(x, 1.3, 1)[0].tolist()))
        total += len(want)
        assert len(g.search(x, 1.0, 120)[0]) == 120
    assert hits >= 0.97 * total


def test_centroids_are_balanced():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(1500, 4)) * 0.2, rng.normal(size=(500, 4)) + 3])
    c = balanced_centroids(x, 20)
    size = np.bincount(np.argmin(((x[:, None] - c[None])**2).sum(2), axis=1), minlength=20)
    assert size.max() < 6 * len(x) / 20
