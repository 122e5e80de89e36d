import random
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import awkward, documents, empty, prose

from ridestar.llm.collocations import collocations, sorted_parts

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def expected(rows, least, contained=80, top=2000):
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            f.update(tuple(words[i:i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p[i:i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                  if 100 * a >= contained * f[p[i:i + k]]}
        ranked = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def found(df, **kw):
    return sorted(tuple(r) for r in collocations(df, **kw).collect())


def check(df, least, **kw):
    want = expected([(r.text, r.lang) for r in df.select("text", "lang").collect()], least, **kw)
    assert found(df, least=least, **kw) == want
    return want


def test_matches_brute_force_over_languages(spark):
    texts = [t.replace(" a", ". a").replace(" bc", ", BC") for t in prose(300, vocabulary=40)]
    df = documents(spark, texts).selectExpr("text", "case when doc_id % 3 = 0 then 'fr' when doc_id % 7 = 0 then null else lang end as lang",
                                            "1 as w1", "2 as a", "'x' as word", "3 as chunk").repartition(5)
    assert len({r[0] for r in check(df, 5)}) == 3
    check(df, 30)
    check(df, 5, top=7)
    check(df, 3, contained=50)


def test_awkward_rows(spark):
    assert check(awkward(spark), 2)
    assert check(awkward(spark), 30)       # one long text of a repeated word


def test_a_hot_pair_and_a_hot_triple_are_spread_and_added_up(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(x for _ in range(40) for x in (["hot", "pair"] if rng.random() < 0.6 else ["hot", "hot", "hot"]) + [rng.choice(words)])
             for _ in range(60)]
    want = check(documents(spark, texts).repartition(6), 4)
    assert any(p == "hot pair" for _, _, p, *_ in want)


def test_pieces_and_separators(spark):
    texts = ["One two\tthree.Four five\x0bone TWO,three x   one  two", "one two;one two:one two!one two?one two\none two\rone two\x0cone two"] * 3
    assert [r[2] for r in check(documents(spark, texts), 3)]


def test_a_long_text(spark):
    rng = random.Random(6)
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta.", "eps"]) for _ in range(700_000))
    check(documents(spark, [text, "alpha beta"]), 30)


def test_empty_tables(spark):
    assert found(empty(spark)) == []
    assert found(documents(spark, ["", None, " . "])) == []


@pytest.mark.parametrize("least,spread", [(1, False), (3, False), (4, True)])
def test_equal_parts_are_counts(least, spread):
    rng = np.random.default_rng(least)
    words = rng.integers(1, 6, (4, 3000)).astype(np.uint32)
    for d in range(2, 4):
        words[d:, rng.random(3000) < 0.1] = 0
    weight = rng.integers(1, 4, 3000)
    flags = ((words[0] == 1) & (words[1] == 1)).astype(np.uint8) if spread else np.zeros(3000, dtype=np.uint8)
    want = Counter()
    for i in range(3000):
        for d in range(2, 5):
            if words[d - 1, i]:
                want[tuple(words[:d, i])] += weight[i]
    got = {tuple(words[:d, i]): t for m, d, total in sorted_parts(words, weight, flags, least) for i, t in zip(m, total)}
    assert got == {p: a for p, a in want.items() if a >= least or (spread and p == (1, 1))}
