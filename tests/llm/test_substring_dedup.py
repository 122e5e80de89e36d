import hashlib
import random
import re

import pytest
from fixtures import SCHEMA, SF, awkward, documents, empty, prose

from ridestar.llm.substring_dedup import COVER, PERIOD, remove_repeats, removed_digests


def expected(rows, window=20):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (doc_id, _), w in zip(rows, words):
        for s in range(len(w) - window + 1):
            key, at = tuple(w[s:s + window]), (doc_id is None, doc_id or 0, s)
            if key not in first or at < first[key]:
                first[key] = at
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if (doc_id is None, doc_id or 0, s) > first[tuple(w[s:s + window])]:
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, **kw):
    return sorted([tuple(r) for r in removed_digests(df, **kw).collect()], key=str)


def check(df, **kw):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = expected(rows, **kw)
    assert found(df, **kw) == want
    return want


def test_cover_reaches_every_pair_of_residues():
    for i in range(PERIOD):
        for j in range(PERIOD):
            assert any((i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER for d in range(PERIOD))


@pytest.mark.parametrize("window", [13, 20, 33])
def test_passages_at_all_alignments(spark, window):
    rng = random.Random(window)
    passages = [p.split(" ") for p in prose(4, 3, vocabulary=5000, low=window, high=60)]
    texts = []
    for i in range(150):
        w = rng.choices("abcdefghijklmnop", k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randint(0, 3)
            at = rng.randint(0, len(w))
            w[at:at] = p[a:len(p) - rng.randint(0, 3)]
        texts.append(rng.choice((" ", "\n", "  ")).join(w))
    texts += ["x " * 100, "x y " * 60, texts[5], texts[5]]
    want = check(documents(spark, texts).repartition(7), window=window)
    assert sum(n for _, _, n, _ in want) > 500


def test_given_documents(spark):
    want = check(spark.read.parquet(f"{SF}/documents.parquet"))
    assert sum(n for _, _, n, _ in want) > 0


def test_awkward_rows(spark):
    check(awkward(spark, "1 as chunk;2 as body"))


def test_order_is_by_doc_id_not_by_place(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(9, text), (None, text), (3, "z " + text), (9, text)]
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA).repartition(3)
    assert {(d, n) for d, _, n, _ in check(df)} == {(3, 0), (9, 25), (None, 25)}


def test_texts_that_stay(spark):
    text = " ".join(f"w{i}" for i in range(25))
    df = documents(spark, [text, "a  b " + text + "\nc"])
    got = {r.doc_id: (r.text, r.n_removed) for r in remove_repeats(df).collect()}
    assert got == {1: (text, 0), 2: ("a b c", 25)}


def test_empty_table(spark):
    assert removed_digests(empty(spark)).count() == 0
