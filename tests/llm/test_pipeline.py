import hashlib
from collections import Counter

import public_tokenizers as P
from fixtures import SF, awkward, empty
from test_exact_dedup import expected as exact_expected
from test_mixing import expected as mix_expected
from test_ngram_join import expected as near_expected
from tokenizers import Tokenizer

import corpus_pipeline
from ridestar.llm.quality import THRESHOLD, score, train
from ridestar.llm.space import table


def test_stages_equal_their_brute_force_versions(spark):
    """Each stage by its definition, on all rows its predecessor kept."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    scores = {r.doc_id: r.score for r in score(docs, train(docs, labels)).collect()}
    rows = [r for r in rows if scores[r[0]] >= THRESHOLD]
    kept = {e[0] for e in exact_expected([(d, t) for d, t, _ in rows]) if e[3]}
    rows = [r for r in rows if r[0] in kept]
    kept = {c for _, _, c in near_expected([(d, t) for d, t, _ in rows], 5, 80, 100)}
    rows = [r for r in rows if r[0] in kept]
    copies = mix_expected(rows, 2.0, 1 << 20)
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for d, text, source in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += copies[d, source]
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want


def test_stages_keep_the_columns_and_take_awkward_tables(spark):
    for df in (awkward(spark, "1 as body;2 as c;3 as n;4 as block;5 as digest"), empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns, name
            df = spark.createDataFrame(out.collect(), df.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, df, SF).count() == df.count()


def test_the_last_queries_are_registered():
    import __spark_entry__ as E

    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()
