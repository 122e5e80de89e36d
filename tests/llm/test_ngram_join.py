import random
import re

import pytest
from fixtures import SF, SCHEMA, awkward, documents, empty, prose

from ridestar.llm.components import components
from ridestar.llm.ngram_join import near_dedup, near_groups


def sets_of(text, k):
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w)
             for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def expected(rows, k, num, den):
    sets = [sets_of(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {(a, b) for m in where.values() for a in m for b in m if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
            parent[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        if doc_id is not None and (least.get(r) is None or doc_id < least[r]):
            least[r] = doc_id
        least.setdefault(r, None)
    return sorted([(d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))], key=str)


def found(df, k, num, den):
    return sorted([tuple(r) for r in near_groups(df, k, num, den).select("doc_id", "n_shingles", "component_id").collect()],
                  key=str)


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def near_copies(seed):
    rng = random.Random(seed)
    out = prose(60, seed, high=150)
    for base in prose(6, seed + 1, vocabulary=3000, low=100, high=160):
        out += [edited(rng, base, rng.choice((0, 0, 1, 1, 2, 3, 5, 8))) for _ in range(rng.choice((2, 5, 40)))]
    chain = prose(1, seed + 2, vocabulary=3000, low=120, high=130)[0]
    for _ in range(12):   # a chain: neighbours link, its ends do not
        chain = edited(rng, chain, 1)
        out.append(chain)
    out += ["common line of boiler plate text here " * 3 + t for t in prose(40, seed + 3, low=3, high=12)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100), (2, 50, 100)])
def test_components_equal_brute_force(spark, k, num, den):
    df = documents(spark, near_copies(k)).repartition(5)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(df, k, num, den) == expected(rows, k, num, den)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert found(df, 3, 90, 100) == expected(rows, 3, 90, 100)


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(df, 3, 90, 100) == expected(rows, 3, 90, 100)
    short = documents(spark, ["a", "A", "a b", "a B", "b a", "a b c", "", None, "a b c d"])
    rows = [(r.doc_id, r.text) for r in short.collect()]
    assert found(short, 3, 90, 100) == expected(rows, 3, 90, 100)


def test_dedup_keeps_one_row_of_each_component(spark):
    df = documents(spark, near_copies(9)).selectExpr("*", "1 as body", "2 as n", "3 as kept")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = {c for _, n, c in expected(rows, 5, 80, 100)}
    out = near_dedup(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(want)
    got = [r.doc_id for r in near_dedup(awkward(spark)).collect()]
    assert sorted(got, key=str) == sorted([-5, 3, 4, 5, 6, None, 9, 10, 12], key=str)


def test_repeated_rows_and_null_ids(spark):
    same = "one two three four five six seven eight"
    df = spark.createDataFrame([(5, same, "en", "s", 1)] * 4 + [(None, same, "en", "s", 1), (7, same + " ", "en", "s", 1),
                                                               (None, None, "en", "s", 1), (8, "", "en", "s", 1)], SCHEMA)
    assert sorted([(r.doc_id, r.text) for r in near_dedup(df).collect()], key=str) == sorted(
        [(5, same), (None, None), (8, "")], key=str)


def test_empty_table(spark):
    assert near_groups(empty(spark)).count() == 0
    assert near_dedup(empty(spark)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200, 260)]
    star = [(1, i) for i in range(2, 60)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert got == {**{i: 200 for i in range(200, 261)}, **{i: 1 for i in range(1, 60)}}


def test_chunks_and_batches_are_bounded_in_bytes(spark):
    import pyarrow as pa

    from ridestar.llm import chunks as C
    from ridestar.session import bound_batches

    docs = spark.range(40).selectExpr("id doc_id", "repeat('word ', 100000) text").coalesce(1)
    sizes = [C.opened(pa.scalar(bytes(r.body))).get_total_buffer_size() for r in C.stage(docs, 1 << 20).collect()]
    assert len(sizes) >= 20 and max(sizes) < 3 << 20

    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["rows"])

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        bound_batches(spark)
        seen = [r.rows for r in docs.mapInArrow(count, "rows long").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert sum(seen) == 40 and max(seen) <= 10
