import hashlib
import random
import zlib

import pytest

from ridestar.llm.queries import op12_conversation_repair
from ridestar.llm.repair import cheapest, damaged, faults_of, repair_conversations, repaired, sha256

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}


def best_edits(rows):
    """(cost, audit, repaired rows) by a table over rows and last role, row by row."""
    seen, faults = set(), []
    for row in rows:
        body = row[1].strip(" \t\n\x0b\f\r")
        faults.append("b" if not body else "d" if row in seen else "-" if body[-1] in ".!?" else "t")
        seen.add(row)

    def with_inserts(best):
        best = dict(best)
        for _ in range(3):
            for last, (cost, audit, out) in list(best.items()):
                for r in NEXT[last]:
                    if r in NAME and (r not in best or (cost + 2, audit + "I") < best[r][:2]):
                        best[r] = cost + 2, audit + "I", (*out, f"{NAME[r]}:")
        return best

    best = with_inserts({"": (0, "", ())})
    for (role, text), fault in zip(rows, faults):
        new = {}

        def put(last, way):
            if last not in new or way[:2] < new[last][:2]:
                new[last] = way

        for last, (cost, audit, out) in best.items():
            put(last, (cost + 3, audit + "D", out))
            if fault in "bd":
                continue
            more = fault == "t"
            for r in NEXT[last]:
                if role[:1] == r:
                    put(r, (cost + more, audit + "K", (*out, f"{role}:{text}")))
                if r in NAME:
                    put(r, (cost + 2 + more, audit + "R", (*out, f"{NAME[r]}:{text}")))
        best = with_inserts(new)
    return faults, min(best[x] for x in ("", "a") if x in best)


def expected(conversations):
    """conv_id -> result of conversations (turn, role, text) without nulls in role and text."""
    out = {}
    for conv, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
        turns = [t for t, _, _ in rows if t is not None]
        faults, (cost, audit, text) = best_edits([r[1:] for r in rows])
        heads = [r[1][:1] for r in rows]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"),
                     faults.count("t"), sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:])), int(cost), audit,
                     hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def found(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def some(n, longest=9, seed=0):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "User", "", "s", "user", "assistant"]
    texts = ["a.", "b", "", "c!", "d?", " \n", "e ", "é.", "f?\n"]
    return [[(rng.choice([None, rng.randint(0, 12)]), rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(0, longest))]
            for _ in range(n)]


def test_search_matches_the_table_and_audits_replay():
    for rows in some(1500):
        rows = [r[1:] for r in rows]
        faults, (cost, audit, text) = best_edits(rows)
        assert faults_of(rows, set()) == faults
        assert cheapest([r[:1] for r, _ in rows], faults) == (cost, audit), rows
        assert repaired(audit, rows) == list(text)


def test_known_repairs():
    def of(*rows):
        faults = faults_of(list(rows), set())
        return cheapest([r[:1] for r, _ in rows], faults)

    assert of() == (0, "")
    assert of(("system", "s.")) == (3, "D")
    assert of(("user", "a.")) == (2, "KI")
    assert of(("assistant", "a.")) == (2, "IK")
    assert of(("user", "a."), ("user", "b.")) == (2, "KR")
    assert of(("user", "a."), ("user", "a."), ("assistant", "b.")) == (3, "KDK")
    assert of(("user", "a"), ("assistant", "b.")) == (1, "KK")


@pytest.mark.parametrize("block", [2, 5, 512])
def test_conversations_in_one_and_in_many_blocks(spark, block):
    conversations = {i: rows for i, rows in enumerate(some(40, 25, seed=block)) if rows}
    conversations[None] = [(1, "user", "x."), (1, "assistant", "y."), (None, "system", "z.")]
    rows = [(conv, *r) for conv, own in conversations.items() for r in own]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 as part", "2 as seq", "true as there", "'' as audit")
    assert found(repair_conversations(df, block=block)) == expected(conversations)


def test_one_conversation_with_most_rows(spark):
    rng = random.Random(2)
    rows = [(t, rng.choice(["user", "assistant", "system"]), f"{rng.randint(0, 900)}{rng.choice(['.', ''])}") for t in range(4000)]
    rows += [(t, "user", "Hot line.") for t in range(4000, 4400)]
    few = {i: [(0, "user", "a."), (1, "assistant", "b.")] for i in range(50)}
    every = [(77, *r) for r in rows] + [(c, *r) for c, own in few.items() for r in own]
    df = spark.createDataFrame(every, SCHEMA).repartition(6)
    assert found(repair_conversations(df, block=100)) == expected({**few, 77: rows})


def test_damage_and_conversations_that_lose_all_rows(spark):
    rows = [(c, t, r, x) for c in range(60) for t, (r, x) in enumerate([("system", "Be brief."), (None, "Hm. Well!"), ("assistant", None)])]
    rows += [(None, None, "user", "q?"), (None, 4, "assistant", "a.")]
    df = spark.createDataFrame(rows, SCHEMA)
    left = {c: [] for c in [*range(60), None]}
    for c, t, r, x in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        r, x, turned = " " if r is None else r, " " if x is None else x, zlib.crc32(name.encode()) % 20
        x = "" if turned == 1 else x.translate({ord(k): None for k in ".!?"}) if turned == 2 else x
        left[c] += [(t, "user" if turned == 4 else r, x)] * {0: 0, 3: 2}.get(turned, 1)
    bad, there = damaged(df)
    assert found(repair_conversations(bad, there)) == expected(left)
    lost = df.limit(0).unionByName(df.where("conv_id = 5")).selectExpr("*", "false as here")
    got = found(repair_conversations(lost, lost["here"]))
    assert got == {5: (0, 0, 0, 0, 0, 0, "", sha256([]))}


def test_empty_and_long(spark):
    assert repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    text = "word " * 600_000
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text + "."), (1, 2, "user", text)], SCHEMA)
    assert found(repair_conversations(df)) == expected({1: [(0, "user", text), (1, "assistant", text + "."), (2, "user", text)]})


def test_query_has_a_row_per_conversation(spark):
    out = op12_conversation_repair(spark, "/root/testdata/sf0.001")
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id").distinct().count()
