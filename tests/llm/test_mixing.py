import hashlib
import math
import os
import re
import sys
from collections import Counter, defaultdict

import pytest
from fixtures import SCHEMA, SF, awkward, documents, empty, prose

from pyspark.sql import functions as F
from ridestar.llm.mixing import epochs, exponent, mix, mixture, schedule, sources


def number(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected(rows, repeats, block_words, budget=None, seed=11):
    """copies by doc_id and source, by the definition."""
    total = defaultdict(int)
    for _, text, source in rows:
        total[source] += words(text)
    known = [t for t in total.values() if t]
    low, high = 0.0, 1.0
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (low, middle) if (max(known) / min(known)) ** (1 - middle) <= repeats else (middle, high)
    a = min(1.0, math.ceil(high * 1e6 - 1e-3) / 1e6)
    raw = {s: (t / max(known)) ** a if t else 0.0 for s, t in total.items()}
    z = sum(raw.values())
    size = max(known) * z if budget is None else budget
    out = Counter()
    for s, t in total.items():
        mine = [(d, words(x)) for d, x, of in rows if of == s]
        if not t:
            out.update({(d, s): 1 for d, _ in mine})
            continue
        real = raw[s] / z * size / t
        whole = math.floor(real + 1e-9)
        rest = max(0, round((real - whole) * t))
        blocks = defaultdict(list)
        n = max(1, math.ceil(t / block_words))
        name = "null" if s is None else s
        for d, w in mine:
            blocks[number(seed, "null" if d is None else d) % n].append((d, w))
        left = rest
        for b in sorted(blocks, key=lambda b: (number(seed, "block", whole, name, b), b)):
            here = sum(w for _, w in blocks[b])
            taken = set()
            if here <= left and rest > 0:
                taken = {d for d, _ in blocks[b]}
            elif left > 0:
                by = defaultdict(int)
                for d, w in blocks[b]:
                    i = "null" if d is None else str(d)
                    by[number(seed, "doc", whole, i), i, d] += w
                upto = 0
                for (_, _, d), w in sorted(by.items(), key=lambda e: e[0][:2]):
                    upto += w
                    if upto <= left:
                        taken.add(d)
            left -= here
            for d, _ in blocks[b]:
                out[d, s] = whole + (d in taken)
    return out


def corpus(spark, n=400):
    texts = prose(n, 3, low=1, high=60)
    shares = ["big"] * 30 + ["mid"] * 8 + ["small"] * 2 + [None]
    rows = [(i, texts[i], "en", shares[i * 7 % len(shares)], 1) for i in range(n)]
    rows += [(1000, "", "en", "void", 0), (1001, None, "en", "void", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("repeats,block_words,budget", [(2.0, 1 << 20, None), (1.5, 200, None), (3.0, 500, 4000), (1.0, 300, None)])
def test_copies_equal_the_definition(spark, repeats, block_words, budget):
    df = corpus(spark)
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    got = {(r.doc_id, r.source): r.mix.copies for r in
           mixture(df, max_repeats=repeats, block_words=block_words, budget=budget).collect()}
    assert got == dict(expected(rows, repeats, block_words, budget))


def test_repetition_limit_and_nothing_dropped(spark):
    df = corpus(spark)
    out = mix(df, max_repeats=2.0)
    assert out.columns == df.columns
    copies = Counter(r.doc_id for r in out.collect())
    assert set(copies) == {r.doc_id for r in df.collect()} and max(copies.values()) <= 2


def test_target_entropy(spark):
    table = sources(corpus(spark), 1 << 20)
    for target in (1.2, 1.3):
        a = exponent(table, None, target)
        w = [r.weight for r in epochs(table, a, None).collect() if r.weight > 0]
        assert abs(-sum(x * math.log(x) for x in w) - target) < 1e-4
    with pytest.raises(ValueError):
        mixture(corpus(spark), max_repeats=2.0, target_entropy=1.0)


def test_weights_meet_the_budget(spark):
    df = corpus(spark)
    out = mixture(df, max_repeats=1.5, block_words=100, budget=20000).withColumn("n", F.regexp_count("text", F.lit(r"\S+")))
    by = out.where("text is not null").groupBy("source").agg(
        F.sum(F.col("n") * F.col("mix.copies")).alias("got"), F.first("mix.weight").alias("w"), F.max("n").alias("most"))
    for r in by.where("source <> 'void'").collect():
        assert r.w * 20000 - 2 * r.most <= r.got <= r.w * 20000 + 1


def test_schedule_is_a_permutation_by_epoch(spark):
    df = corpus(spark)
    rows = schedule(df, max_repeats=3.0, block_words=300).orderBy("epoch", "place").collect()
    copies = {(r.doc_id): r.mix.copies for r in mixture(df, max_repeats=3.0, block_words=300).collect()}
    assert Counter(r.doc_id for r in rows) == Counter({d: c for d, c in copies.items() if c})
    first, second = ([r.doc_id for r in rows if r.epoch == e and r.source == "small"] for e in (0, 1))
    assert len(first) > 3 and set(second) <= set(first) and first[:len(second)] != second


def test_awkward_and_empty(spark):
    df = awkward(spark, "1 as block;2 as epochs;3 as words;4 as id;5 as part")
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    want = expected(rows, 2.0, 1 << 20)
    got = sorted([(r.doc_id, r.source, r.mix.copies) for r in mixture(df, max_repeats=2.0).collect()], key=str)
    assert got == sorted([(d, s, want[d, s]) for d, _, s in rows], key=str)
    assert mix(empty(spark)).count() == 0
    blank = df.where("text is null")
    assert mix(blank).count() == blank.count()


def test_queries_equal_their_sql(spark):
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))
    from oracle_check import canon, duck

    from ridestar.llm import queries as L

    for name, sql in L.ORACLE.items():
        df = L.QUERIES[name](spark, SF)
        result = duck(SF).execute(sql)
        assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in result.description], result.fetchall()), name


def test_no_python_in_native_plans(spark):
    from ridestar.llm import queries as L

    for name in ("op8_source_mixing", "op9_exact_dedup"):
        text = L.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", text)


def test_columns_named_as_the_mixture_names_its_own(spark):
    df = documents(spark, ["a b c", "d e", "f"]).selectExpr("*", "1 as mix", "2 as row", "3 as copies", "4 as of", "5 as block", "6 as copy")
    out = mix(df)
    assert out.columns == df.columns and sorted(out.distinct().collect()) == sorted(df.collect())
