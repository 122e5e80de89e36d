from collections import Counter

import pytest
from fixtures import awkward, documents, empty
from test_ngram_join import near_copies, sets_of

from ridestar.llm.ngram_links import near_links


def check(df, k, num, den):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    sets = Counter(s for _, t in rows if (s := sets_of(t, k)))
    least = {}
    for doc, text in rows:
        s = sets_of(text, k)
        known = least.get(s, ())
        least[s] = min([*known, (doc is None, doc or 0)])[:2] if not known else min(known, (doc is None, doc or 0))
    name = {s: None if u else d for s, (u, d) in least.items()}
    distinct = list(sets)
    linked = Counter()
    want = []
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            common = len(a & b)
            if den * common >= num * (len(a) + len(b) - common):
                want.append(frozenset([str(name[a]), str(name[b])]))
                linked[a] += sets[b]
                linked[b] += sets[a]
    pairs, members = near_links(df, k, num, den)
    got = pairs.collect()
    assert Counter(frozenset([str(p.one), str(p.two)]) for p in got) == Counter(want)
    of = members.collect()
    assert Counter((m.doc_id, m.n_shingles, m.links) for m in of) == Counter(
        (d, len(s), linked[s] + sets[s] - 1 if s else 0) for d, s in ((d, sets_of(t, k)) for d, t in rows))
    by_class = {m["class"]: m.n_shingles for m in of if m["class"] is not None}
    assert len(by_class) == len(distinct) and all(p.class_one in by_class and p.class_two in by_class for p in got)
    return len(got)


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100)])
def test_links_equal_brute_force(spark, k, num, den):
    assert check(documents(spark, near_copies(k)).repartition(5), k, num, den) > 20


def test_awkward_and_empty(spark):
    check(awkward(spark), 3, 90, 100)
    pairs, members = near_links(empty(spark))
    assert pairs.count() == 0 and members.count() == 0
