"""Registered queries of this package: one per operator, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestar.llm.ann import search
from ridestar.llm.bpe import token_digests
from ridestar.llm.collocations import collocations
from ridestar.llm.exact_dedup import exact_groups
from ridestar.llm.language_model import lm_scores
from ridestar.llm.line_dedup import LineIndex
from ridestar.llm.mixing import mixture, n_words
from ridestar.llm.ngram_join import near_groups
from ridestar.llm.quality import quality_scores
from ridestar.llm.repair import damaged, repair_conversations
from ridestar.llm.secrets import digest_columns, secret_spans
from ridestar.llm.space import table
from ridestar.llm.substring_dedup import removed_digests
from ridestar.llm.token_files import read_token_records, write_token_records
from ridestar.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def enter(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return enter


@query("op9_exact_dedup", r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS body,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
        FROM documents)
    SELECT doc_id,
           first_value(doc_id) OVER (PARTITION BY normal ORDER BY length(body) DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY normal) AS group_size,
           row_number() OVER (PARTITION BY normal ORDER BY length(body) DESC, doc_id) = 1 AS kept,
           sha256(normal) AS text_sha256
    FROM d""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept",
        F.col("digest").alias("text_sha256"))


#: Production parameters of the token queries.
END_ID = 2


@query("op1_token_records")
def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-records")
    write_token_records(table(spark, sf_dir, "documents"), folder, vocabulary(), END_ID)
    return read_token_records(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), vocabulary())


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(secret_spans(table(spark, sf_dir, "documents")))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Every source within two epochs; the largest takes one.
MAX_REPEATS = 2.0


@query("op8_source_mixing", r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, coalesce(doc_id::VARCHAR, 'null') AS id,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n
        FROM documents),
    s AS (
        SELECT source, sum(n)::BIGINT AS words, greatest(1, ceil(sum(n) / 1048576.0))::BIGINT AS blocks
        FROM d GROUP BY source),
    ends AS (SELECT max(words)::DOUBLE AS most, min(words) FILTER (words > 0)::DOUBLE AS least FROM s),
    halving AS (
        SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
        UNION ALL
        SELECT step + 1,
               CASE WHEN pow(most / least, 1 - (low + high) / 2) <= 2 THEN low ELSE (low + high) / 2 END,
               CASE WHEN pow(most / least, 1 - (low + high) / 2) <= 2 THEN (low + high) / 2 ELSE high END
        FROM halving, ends WHERE step < 40),
    a AS (SELECT least(1.0, ceil(high * 1e6 - 1e-3) / 1e6) AS a FROM halving WHERE step = 40),
    w AS (
        SELECT source, words, blocks, CASE WHEN words > 0 THEN pow(words / most, a) ELSE 0 END AS raw, most
        FROM s, ends, a),
    z AS (SELECT sum(raw) AS z FROM w),
    p AS (
        SELECT source, words, blocks, raw / z AS weight,
               CASE WHEN words = 0 THEN 1.0 ELSE raw / z * (most * z) / words END AS exact
        FROM w, z),
    e AS (
        SELECT *, floor(exact + 1e-9)::BIGINT AS epochs,
               CASE WHEN words = 0 THEN 0 ELSE greatest(0, round((exact - floor(exact + 1e-9)) * words))::BIGINT END AS rest
        FROM p),
    r AS (
        SELECT d.doc_id, d.id, d.source, d.n, e.weight, e.words AS source_words, e.epochs, e.rest,
               ('0x' || substr(md5('11|' || d.id), 1, 8))::BIGINT % e.blocks AS block
        FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
    b AS (
        SELECT source, block, any_value(epochs) AS epochs, any_value(rest) AS rest, sum(n)::BIGINT AS size,
               ('0x' || substr(md5('11|block|' || any_value(epochs) || '|' || coalesce(source, 'null') || '|' || block), 1, 8))::BIGINT AS turn
        FROM r GROUP BY source, block),
    c AS (
        SELECT *, rest - coalesce(sum(size) OVER (PARTITION BY source ORDER BY turn, block
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains
        FROM b),
    q AS (
        SELECT r.*, c.remains, c.size,
               sum(r.n) OVER (PARTITION BY r.source, r.block
                              ORDER BY ('0x' || substr(md5('11|doc|' || r.epochs || '|' || r.id), 1, 8))::BIGINT, r.id
                              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM r JOIN c ON r.source IS NOT DISTINCT FROM c.source AND r.block = c.block)
    SELECT doc_id, source, n AS n_words, source_words, block, round(weight, 9) AS weight,
           epochs + CASE WHEN rest > 0 AND size <= remains THEN 1
                         WHEN remains > 0 AND upto <= remains THEN 1 ELSE 0 END AS copies
    FROM q""")
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixture(docs, max_repeats=MAX_REPEATS).select(
        "doc_id", "source", n_words(F.col("text")).alias("n_words"), "mix.source_words", "mix.block",
        F.round("mix.weight", 9).alias("weight"), "mix.copies")


@query("op6_ngram_join")
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), k=3, num=90, den=100).select(
        "doc_id", "n_shingles", "component_id")


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_digests(table(spark, sf_dir, "documents"))


@query("op2_language_model")
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


@query("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op11_line_dedup", r"""
    WITH d AS (
        SELECT row_number() OVER () AS nr, coalesce(doc_id, 9223372036854775807) AS id, doc_id,
               string_split(coalesce(text, ''), chr(10)) AS lines
        FROM documents),
    l AS (SELECT nr, id, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
    k AS (
        SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM l),
    o AS (SELECT key, min(id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
    j AS (SELECT k.*, coalesce(o.owner < k.id, FALSE) AS lost FROM k LEFT JOIN o USING (key))
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '')) AS kept_sha256
    FROM j GROUP BY nr""")
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = LineIndex(spark, scratch_path(spark, "line-index"))
    index.insert(table(spark, sf_dir, "documents"))
    return index.cleaned().select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _repair_sql() -> str:
    """The edit lattice row by row: for each last role (0: none, s, u, a) the least (cost and audit, repaired rows)."""
    never = "{'k': '~', 'o': NULL::VARCHAR}"

    def plus(x: str, cost: str, edit: str, row: str | None = None) -> str:
        out = f"{x}.o" if row is None else f"concat_ws(chr(10), {x}.o, {row})"
        return (f"CASE WHEN {x}.k = '~' THEN {never} ELSE {{'k': lpad((left({x}.k, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || "
                f"substr({x}.k, 13) || '{edit}', 'o': {out}}} END")

    def stay(cost: str, edit: str, befores: str, row: str, when: str = "TRUE") -> str:
        ways = ", ".join(plus(f"t.{x}", cost, edit, row) for x in befores.split())
        return f"CASE WHEN r.stays AND {when} THEN least({ways}, {never}) ELSE {never} END"

    keep, user, helper = "r.role || ':' || r.text", "'user:' || r.text", "'assistant:' || r.text"
    return f"""
    WITH RECURSIVE c AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id
        FROM conversations),
    x AS (
        SELECT *, xor(list_reduce(
                   list_transform(range(8 * length(id)), lambda i: ((ascii(id[i // 8 + 1]) >> (i % 8)::INT) % 2)::UBIGINT),
                   lambda a, b: xor(a >> 1, CASE WHEN xor(a, b) % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END),
                   4294967295::UBIGINT), 4294967295::UBIGINT) % 20 AS turned
        FROM c),
    d AS (
        SELECT conv_id, turn, CASE WHEN turned = 4 THEN 'user' ELSE role END AS role,
               CASE turned WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE turned WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM x),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                 row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS time FROM d),
    e AS (SELECT *, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body FROM o),
    f AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN time > 1 THEN 'duplicate'
                         WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault FROM e),
    r AS (
        SELECT *, left(role, 1) AS head, fault NOT IN ('blank', 'duplicate') AS stays, (fault = 'truncated')::BIGINT AS more,
               coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au'),
                        FALSE) AS illegal
        FROM f),
    every AS (SELECT DISTINCT conv_id FROM conversations),
    t AS (
        SELECT conv_id, 0::BIGINT AS i, {{'k': '000000000000', 'o': NULL::VARCHAR}} AS e0, {never} AS es,
               {{'k': '000000000002I', 'o': 'user:'}} AS eu, {{'k': '000000000004II', 'o': 'user:' || chr(10) || 'assistant:'}} AS ea
        FROM every
        UNION ALL
        SELECT conv_id, i, n0 AS e0, ns AS es, u AS eu, least(na, {plus("u", "2", "I", "'assistant:'")}) AS ea
        FROM (SELECT *, least(nu, {plus("n0", "2", "I", "'user:'")}, {plus("ns", "2", "I", "'user:'")},
                              {plus("na", "2", "I", "'user:'")}) AS u
              FROM (SELECT t.conv_id, r.i, {plus("t.e0", "3", "D")} AS n0,
                           least({plus("t.es", "3", "D")}, {stay("r.more", "K", "e0", keep, "r.head = 's'")}) AS ns,
                           least({plus("t.eu", "3", "D")}, {stay("r.more", "K", "e0 es ea", keep, "r.head = 'u'")},
                                 {stay("r.more + 2", "R", "e0 es ea", user)}) AS nu,
                           least({plus("t.ea", "3", "D")}, {stay("r.more", "K", "eu", keep, "r.head = 'a'")},
                                 {stay("r.more + 2", "R", "eu", helper)}) AS na
                    FROM t JOIN r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.i + 1))),
    last AS (SELECT conv_id, least(e0, ea) AS e FROM t QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
        FROM r GROUP BY conv_id)
    SELECT last.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, left(e.k, 12)::BIGINT AS cost,
           substr(e.k, 13) AS audit, sha256(coalesce(e.o, '')) AS repaired_sha256
    FROM last LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM last.conv_id"""


@query("op12_conversation_repair", _repair_sql())
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, there = damaged(table(spark, sf_dir, "conversations"))
    return repair_conversations(rows, there)


@query("op13_collocations", r"""
    WITH p AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(
                   coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
    f AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
        FROM s, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
    n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND a >= 30),
    cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
    scores AS (
        SELECT cuts.lang, cuts.phrase, cuts.a, cut, x.a AS l, y.a AS r,
               (2000000::HUGEINT * cuts.a // (x.a + y.a))::BIGINT AS score
        FROM cuts
        JOIN f AS x ON x.lang = cuts.lang AND x.phrase = array_to_string(words[1:cut], ' ')
        JOIN f AS y ON y.lang = cuts.lang AND y.phrase = array_to_string(words[cut + 1:], ' ')),
    best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    inner_places AS (
        SELECT lang, words, a, k, unnest(range(1, k)) AS i FROM c WHERE k > 2),
    inside AS (
        SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(a) AS longer
        FROM inner_places, (SELECT unnest([2, 3]) AS m) WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
    kept AS (
        SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase)
        WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
