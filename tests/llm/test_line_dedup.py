import random
from collections import defaultdict

import numpy as np
import pytest
from fixtures import awkward, documents, empty

from ridestar.llm.line_dedup import NO_ID, Cuckoo, LineIndex
from ridestar.session import scratch_path
from ridestar.sources.snapshots import Snapshots

WHITE = " \t\n\x0b\x0c\r"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def expected(rows):
    def key(line):
        return line.strip(WHITE).translate(LOW)

    owner = defaultdict(lambda: NO_ID)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                owner[key(line)] = min(owner[key(line)], NO_ID if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or owner[key(x)] >= (NO_ID if doc is None else doc)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(index):
    return sorted([tuple(r) for r in index.cleaned().collect()], key=str)


def index_of(spark):
    return LineIndex(spark, scratch_path(spark, "lines"))


def lines(n, seed=0):
    rng = random.Random(seed)
    pool = [f"Line number {i} of the Pool" for i in range(60)] + ["short", "", " ", "nine char", "  The license line.\t", "é" * 9, "é" * 10]
    return ["\n".join(rng.choice(pool) + rng.choice(["", " ", "\r"]) for _ in range(rng.randint(1, 8))) for _ in range(n)]


def test_matches_brute_force_on_awkward_rows(spark):
    df = awkward(spark, "text as line;1 as chunk;2 as bin;3 as ids")
    index = index_of(spark)
    index.insert(df)
    assert found(index) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_increments_and_deletions_are_reversible(spark):
    texts = lines(90)
    df = documents(spark, texts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    index = index_of(spark)
    index.insert(df.where("doc_id > 60").repartition(3))
    first = found(index)
    index.insert(df.where("doc_id <= 60").repartition(3))          # smaller ids take lines over
    assert found(index) == expected(rows)
    index.delete(df.where("doc_id <= 60 or doc_id = 1000").select("doc_id"))
    assert found(index) == first == expected([r for r in rows if r[0] > 60])
    index.insert(df.where("doc_id <= 60"))
    assert found(index) == expected(rows)
    index.delete(df.select("doc_id"))
    assert found(index) == []
    index.insert(df)
    assert found(index) == expected(rows)


def test_repeated_and_null_ids(spark):
    rows = [(7, "a line of text\nanother line"), (7, "a line of text"), (None, "a line of text\nonly null has it"),
            (None, "only null has it"), (9, "another line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = index_of(spark)
    index.insert(df)
    assert found(index) == expected(rows)
    index.delete(spark.createDataFrame([(None,), (7,), (7,)], "doc_id long"))
    assert found(index) == [(9, 1, 0, "another line")]


def test_empty_tables(spark):
    index = index_of(spark)
    assert found(index) == []
    index.delete(spark.createDataFrame([(1,)], "doc_id long"))
    index.insert(empty(spark))
    assert found(index) == []
    index.insert(documents(spark, ["one line of text"]))
    index.delete(spark.createDataFrame([], "doc_id long"))
    assert found(index) == [(1, 1, 0, "one line of text")]


def test_a_long_text_of_one_hot_line(spark):
    texts = ["the same line\n" * 300_000 + "end of the long text", "the same line", "other line here\nthe same line"]
    index = index_of(spark)
    index.insert(documents(spark, texts))
    assert found(index) == expected(list(enumerate(texts, 1)))


def test_a_change_that_dies_before_its_commit_changes_nothing(spark, monkeypatch):
    texts = lines(20, seed=3)
    index = index_of(spark)
    index.insert(documents(spark, texts))
    before = found(index)
    monkeypatch.setattr(Snapshots, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    for change in (lambda: index.insert(documents(spark, texts, first=-50)),
                   lambda: index.delete(spark.createDataFrame([(3,)], "doc_id long"))):
        with pytest.raises(OSError):
            change()
    monkeypatch.undo()
    assert found(index) == before
    index.delete(spark.createDataFrame([(3,)], "doc_id long"))
    assert found(index) == expected([(i, t) for i, t in enumerate(texts, 1) if i != 3])


def test_the_filter_never_misses_and_forgets_only_dead_keys():
    rng = np.random.default_rng(5)
    # keys of one shard begin with the same bits
    keys = rng.integers(0, 1 << 40, 60_000).astype(np.uint64) | np.uint64(0xABC << 52)
    cuckoo = Cuckoo()
    for part in np.array_split(keys, 7):
        cuckoo.insert(part[~cuckoo.contains(part)])
    assert cuckoo.contains(keys).all() and len(cuckoo.tables) > 1
    other = rng.integers(0, 1 << 40, 60_000).astype(np.uint64) | np.uint64(0xABC << 52)
    assert cuckoo.contains(other).mean() < 0.003
    live, dead = keys[20_000:], keys[:20_000]
    cuckoo.delete(dead, live)
    assert cuckoo.contains(live).all() and cuckoo.contains(dead).mean() < 0.003
    cuckoo.insert(dead[~cuckoo.contains(dead)])
    assert cuckoo.contains(keys).all()


def test_keys_of_one_place_share_an_entry():
    cuckoo = Cuckoo([np.zeros((1, 4), dtype=np.uint16)])
    keys = np.arange(1, 200_000, dtype=np.uint64)
    mark, _, _ = cuckoo.places(cuckoo.tables[0], keys)
    twins = keys[mark == mark[0]][:2]
    assert len(twins) == 2
    cuckoo.insert(twins[:1])
    assert cuckoo.contains(twins).all()          # the second is a false positive, never entered
    cuckoo.delete(twins[:1], twins[1:])
    assert cuckoo.contains(twins).all()          # and keeps the entry alive
    cuckoo.delete(twins, keys[:0])
    assert not cuckoo.contains(twins).any()
