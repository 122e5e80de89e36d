import hashlib
import re
from collections import defaultdict

from fixtures import awkward, documents, empty

from pyspark.sql import functions as F
from ridestar.llm.exact_dedup import exact_dedup, exact_groups, frequent_digests, narrow_rows


def expected(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        normal = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[normal].append((-len(text or ""), doc_id is None, doc_id or 0, i, doc_id))
    out = []
    for normal, members in groups.items():
        members.sort()
        sha = hashlib.sha256(normal.encode()).hexdigest()
        out += [(m[4], members[0][4], len(members), k == 0, sha) for k, m in enumerate(members)]
    return sorted(out, key=str)


def found(df, **kw):
    got = exact_groups(df, **kw).select("doc_id", "keep_id", "group_size", "kept", "digest")
    return sorted([tuple(r) for r in got.collect()], key=str)


def test_groups_match_brute_force(spark):
    df = awkward(spark)
    assert found(df) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_hot_groups_take_the_broadcast_path_with_the_same_result(spark):
    texts = ["hot text " + " " * (i % 7) for i in range(400)] + [f"t{i % 150} x" for i in range(450)] + [None] * 200
    df = documents(spark, texts).repartition(6)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    hot = frequent_digests(narrow_rows(df), 2, 64).collect()
    assert {hashlib.sha256(b"hottext").hexdigest(), hashlib.sha256(b"").hexdigest()} == {r.digest for r in hot}
    want = expected(rows)
    assert found(df, hot_digests=2, counters=64) == want
    assert found(df, hot_digests=1024, counters=1024) == want


def test_dedup_keeps_all_columns_and_one_of_repeated_rows(spark):
    df = awkward(spark, "1 as row;2 as digest;3 as kept;array(1) as chars")
    out = exact_dedup(df)
    assert out.columns == df.columns
    got = sorted([(r.doc_id, r.text) for r in out.collect()], key=str)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    keep = [e for e in expected(rows) if e[3]]
    assert len(got) == len(keep)
    assert sorted([str(g[0]) for g in got]) == sorted([str(k[0]) for k in keep])
    assert sum(1 for g in got if g[0] == 6) == 1


def test_a_hot_repeated_row_collapses(spark):
    df = documents(spark, ["a b", "c"]).unionByName(documents(spark, ["same"] * 1).crossJoin(
        spark.range(300).select(F.lit(0).alias("z"))).drop("z"))
    assert exact_dedup(df).count() == 3


def test_empty_table(spark):
    assert exact_groups(empty(spark)).count() == 0
    assert exact_dedup(empty(spark)).count() == 0
