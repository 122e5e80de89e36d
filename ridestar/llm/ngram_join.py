"""Jaccard similarity join over word n-gram sets with adaptive multi-match prefixes.

Sets. A document's set holds the hashes of its distinct k-word shingles (fewer words: the whole
sequence as one; no words: empty, linked with nothing). Documents with equal sets form a class; one
class stands for all its copies from then on.

Order. Shingles are ordered rare first by their counts over all texts, which chunks of texts ask of hash bins
(any common order gives right results; the counts only make prefixes selective). A shingle found once is in no other set:
it takes its rank in the prefix and goes no further.

Prefixes. Two sets that link share at least ``l`` shingles among their first
``n - ceil(t * n) + l`` ones. Each class picks its own ``l`` (1 to ``MAX_MATCHES``): a longer prefix costs
longer posting lists, but asks for more shared shingles before a pair is verified; both costs are
estimated from the counts. A pair uses the ``l`` of its larger set.

Rounds. First each posting list proposes a star: its members against the least edited one. Verified
links are contracted to components, so a large group of near copies is one node. Then pairs
from different components that share a shingle are counted; a pair is verified if it has ``l`` matches
and its sizes and last shared ranks still allow enough overlap. Pairs inside a component need no look:
they cannot change it. Verified on whole sets, no pair is lost between components. Sets travel to pairs of blocks of
classes, once each, however many pairs two blocks have.

Null texts are empty. Ties and repeated rows share a class. All joins are on hashed keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridestar.llm import bins as B
from ridestar.llm import chunks as C
from ridestar.llm.components import components
from ridestar.llm.space import stay, written
from ridestar.llm.words import LANES, U64, giving_back, mix, pieces, text_column, windows, words_of

MAX_MATCHES = 4
KEY_BITS = 40
STEPS = 6
BITS = 1 << 25
BLOCK = 64
#: Bytes of text of a chunk: a task's arrays are some 30 times as large.
CHUNK_BYTES = 1 << 20
PREFIX = np.dtype([("t", "<u8"), ("r", "<u4")])
POSTING = np.dtype([("t", "<u8"), ("c", "<i8"), ("r", "<u4")])


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of a run of texts (repeats included) and the text of each, in order."""
    w = words_of(column, fold=True)
    h, count = w.hashes(), w.counts()
    out, at = windows(h, w.first, k)
    doc = np.searchsorted(w.first, at, side="right") - 1
    extra_h, extra_d = [], []
    for m in range(1, k):
        few = np.flatnonzero(count == m)
        if len(few):
            s = w.first[few]
            total = sum(h[s + i] * LANES[0, i] for i in range(m))
            extra_h.append(mix(total + U64(m)))
            extra_d.append(few)
    if extra_h:
        out = np.concatenate([out, *extra_h])
        doc = np.concatenate([doc, *extra_d])
        order = np.argsort(doc, kind="stable")
        out, doc = out[order], doc[order]
    return out, doc


def shingle_levels(staged: DataFrame, k: int) -> DataFrame:
    """(chunk, bin, data): for each distinct shingle of a chunk in that bin, in order, the level of its count over all texts.

    A chunk sends ``KEY_BITS`` bits of each shingle and its count there; the bins, ranges of the hash, add up the counts. Levels
    are ``STEPS`` per doubling; a shingle found once has level 0.
    """
    n = B.bin_count(staged.sparkSession)
    kinds = [np.uint32, np.uint8, np.uint8]

    def deal(batches):
        for batch in batches:
            for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                h, times = np.unique(shingles(C.opened(body).column(3), k)[0], return_counts=True)
                key = h & U64((1 << KEY_BITS) - 1)
                rows = list(C.records(chunk, B.bin_of(h, n), n, [
                    key.astype(np.uint32), (key >> U64(32)).astype(np.uint8), np.minimum(times, 255).astype(np.uint8)]))
                if rows:
                    yield C.batch_of(rows)

    def meet(batches):
        for b, sent in C.by_bin(batches):
            low, high, count = zip(*(C.split(d, kinds) for _, d in sent))
            key = np.concatenate(high).astype(np.uint64)
            key <<= U64(32)
            key |= np.concatenate(low)
            order = np.argsort(key)
            key = key[order]
            heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            times = np.diff(np.append(heads, len(key)))
            del key   # few arrays of a bin's size at a time
            total = np.add.reduceat(np.concatenate(count)[order], heads, dtype=np.int64)
            of_key = np.minimum(255, np.log2(total) * STEPS).astype(np.uint8)
            level = np.empty(len(order), dtype=np.uint8)
            level[order] = np.repeat(of_key, times)
            ends = np.cumsum([len(x) for x in low])
            yield C.batch_of([(c, b, level[z - len(x):z].tobytes()) for (c, _), x, z in zip(sent, low, ends)])

    return staged.mapInArrow(giving_back(deal), C.PIECE).repartitionById(n, "bin").mapInArrow(giving_back(meet), C.PIECE)


#: How many other places a shingle of each level is expected in.
COSTS = np.exp2(np.arange(256) / STEPS) - 1


def ordered_keys(h: np.ndarray, level: np.ndarray) -> np.ndarray:
    """64-bit keys: rare shingles small; a key identifies its shingle."""
    return (level.astype(np.uint64) << U64(56)) | (h >> U64(8))


def least_overlap(n, num: int, den: int):
    """ceil(t * n) for t = num / den."""
    return (num * n + den - 1) // den


def choose_matches(costs: np.ndarray, n: int, base: int) -> int:
    """The number of matches to ask for: argmin of list cost plus verification cost."""
    verify = 1 + n / 16
    total = np.cumsum(costs[:base + MAX_MATCHES - 1])
    best, least = 1, None
    for m in range(1, MAX_MATCHES + 1):
        length = base + m - 1
        if length > len(total):
            break
        c = total[length - 1] * (1 + verify / m)
        if least is None or c < least:
            best, least = m, c
    return best


def profiles(staged: DataFrame, levels: DataFrame, k: int, num: int, den: int, kind: str) -> DataFrame:
    """doc_id, id_key and body (hashes of id and text), n, hi, lo (fingerprint of the set), matches, prefix per row.

    ``prefix``: (key, rank) of the prefix shingles that occur more than once, packed; no other set has the rest.
    """

    def describe(batches):
        for batch in batches:
            for body, found in zip(batch.column(1), batch.column(2)):
                rows = C.opened(body)
                h, doc = shingles(rows.column(3), k)
                distinct, back = np.unique(h, return_inverse=True)
                got = C.answers(found, np.uint8)
                level = np.concatenate([got[b] for b in sorted(got)]) if got else np.zeros(0, dtype=np.uint8)
                key = ordered_keys(distinct, level)[back]
                by = np.lexsort((key, doc))
                h, key, doc = h[by], key[by], doc[by]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
                h, key, doc = h[new], key[new], doc[new]
                first = np.searchsorted(doc, np.arange(rows.num_rows + 1))
                n = np.diff(first)
                hi, lo = _fingerprints(h, first)
                rank = (key >> U64(56)).astype(np.int64)
                cost = COSTS[rank]
                matches, prefix = [], []
                for d in range(rows.num_rows):
                    a, size = first[d], int(n[d])
                    base = size - least_overlap(size, num, den) + 1 if size else 0
                    stop = min(size, base + MAX_MATCHES - 1)
                    matches.append(choose_matches(cost[a:a + stop], size, base) if size else 0)
                    shared = np.flatnonzero(rank[a:a + stop])
                    own = np.empty(len(shared), dtype=PREFIX)
                    own["t"], own["r"] = key[a:a + stop][shared], shared
                    prefix.append(own.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:3], pa.array(n, pa.int64()), pa.array(hi.view(np.int64)),
                     pa.array(lo.view(np.int64)), pa.array(matches, pa.int32()), pa.array(prefix, pa.binary())],
                    names=["doc_id", "id_key", "body", "n", "hi", "lo", "matches", "prefix"])

    asked = C.gathered(levels, "found")
    return (staged.join(asked, F.col("chunk") == F.col("found_chunk"), "left").select("chunk", "body", "found").mapInArrow(
        giving_back(describe), f"doc_id {kind}, id_key long, body long, n long, hi long, lo long, matches int, prefix binary"))


def _fingerprints(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set of shingles."""
    return tuple(_sums(mix(h ^ U64(s)), first) for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def postings(classes: DataFrame) -> DataFrame:
    """Rows (t, c, r, head, head_r) of prefix shingles that two classes or more have; head: least rank, then id."""
    n = B.bin_count(classes.sparkSession)

    def deal(batches):
        for batch in batches:
            keys = [np.frombuffer(v.as_buffer(), dtype=PREFIX) for v in batch.column(1)]
            size = np.array([len(x) for x in keys], dtype=np.int64)
            records = np.zeros(int(size.sum()), dtype=POSTING)
            if len(records):
                both = np.concatenate(keys)
                records["t"], records["r"] = both["t"], both["r"]
                records["c"] = np.repeat(batch.column(0).to_numpy(), size)
                yield B.packed(records, B.bin_of(mix(records["t"].copy()), n), n)

    def meet(batches):
        got = B.unpacked(batches, POSTING)
        got = got[np.lexsort((got["c"], got["r"], got["t"]))]
        t = got["t"]
        new = np.ones(len(t), dtype=bool)
        new[1:] = t[1:] != t[:-1]
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(t)))
        many = np.repeat(size > 1, size)
        head = np.repeat(starts, size)
        yield from B.rows(["t", "c", "r", "head", "head_r"], [
            t[many].view(np.int64), got["c"][many], got["r"][many].astype(np.int32), got["c"][head][many],
            got["r"][head][many].astype(np.int32)])

    return (B.dealt(classes.select("c", "prefix").mapInArrow(giving_back(deal), B.SCHEMA), n)
            .mapInArrow(giving_back(meet), "t long, c long, r int, head long, head_r int"))


def _row_key() -> list[Column]:
    """Two 64-bit hashes that name a row: of its id and of its text."""
    return [F.xxhash64(F.lit(1), "doc_id").alias("id_key"), F.xxhash64("text").alias("body")]


def _bitmap(keys: Column, rows: DataFrame) -> np.ndarray:
    """``BITS`` bits, set at a hash of each key: a filter of fixed size that never misses a key."""
    at = F.pmod(keys, F.lit(BITS))
    parts = (rows.select(at.alias("at"))
             .groupBy(F.shiftright("at", 15).alias("part"))
             .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(32767))).alias("bits")))
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for r in parts.collect():   # at most BITS / 32768 rows of 4 KB
        out[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def class_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(c, items): the sorted hashes of each wanted class (id_key, body), from its representative's text.

    Texts are not shuffled: tasks skip rows that a bitmap of the wanted keys rules out, and only sets travel. A few classes not
    asked for may be among them, and a representative row that is repeated gives its set once per task.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(_bitmap(F.xxhash64("id_key", "body"), wanted))

    def compute(batches):
        given = set()
        for batch in batches:
            at = batch.column(2).to_numpy()
            use = np.flatnonzero(bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            batch = batch.take(pa.array(use))
            column = text_column(batch.column(3))
            for i, j in pieces(column, CHUNK_BYTES):
                h, doc = shingles(column[i:j], k)
                by = np.lexsort((h, doc))
                h, doc = h[by], doc[by]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
                h, doc = h[new], doc[new]
                first = np.searchsorted(doc, np.arange(j - i + 1))
                sets = {}
                for c, a, b in zip(_fingerprints(h, first)[0].view(np.int64).tolist(), first[:-1], first[1:]):
                    if c not in given:
                        sets[c] = h[a:b].tobytes()
                given.update(sets)
                yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), pa.array(list(sets.values()), pa.binary())],
                                                 names=["c", "items"])

    keyed = docs.select(*_row_key(), "text")
    keyed = keyed.select("id_key", "body", F.pmod(F.xxhash64("id_key", "body"), F.lit(BITS)).alias("at"), "text")
    return keyed.mapInArrow(giving_back(compute), "c long, items binary")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets link.

    Sets travel to pairs of blocks, not to pairs: classes that one class is paired with most stand in a block of at
    most about ``BLOCK`` classes with it, pairs go to the pair of their blocks, and each of the two blocks sends a set once.
    """
    sides = pairs.select(F.col("a").alias("c"), F.col("b").alias("hub")).union(pairs.select("b", F.col("b")))
    hubs = sides.groupBy("c").agg(F.min("hub").alias("hub"))
    load = hubs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("parts"))
    blocks = written(hubs.join(load, "hub").select("c", F.xxhash64("hub", F.pmod(F.xxhash64("c"), F.col("parts"))).alias("block")),
                     "near-blocks")

    def block_of(side: str) -> DataFrame:
        return blocks.select(F.col("c").alias(side), F.col("block").alias(f"block_{side}"))

    dealt = written(pairs.join(block_of("a"), "a").join(block_of("b"), "b"), "near-dealt")
    both = dealt.select(F.col("block_a").alias("one"), F.col("block_b").alias("two")).distinct()
    ends = both.select("one", "two", F.col("one").alias("block")).union(both.where("one <> two").select("one", "two", "two"))
    sent = ends.join(blocks, "block").join(sets, "c").select("one", "two", "c", "items")

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        at = {c: i for i, c in enumerate(right.column("c").to_pylist())}
        items = [np.frombuffer(v.as_buffer(), dtype="<u8") for v in right.column("items").combine_chunks()]
        a, b = left.column("a").to_pylist(), left.column("b").to_pylist()
        keep = np.zeros(len(a), dtype=bool)
        for i, (c, d) in enumerate(zip(a, b)):
            x, y = items[at[c]], items[at[d]]
            if len(x) > len(y):
                x, y = y, x
            place = np.minimum(np.searchsorted(y, x), len(y) - 1)
            common = int(np.count_nonzero(y[place] == x))
            keep[i] = den * common >= num * (len(x) + len(y) - common)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}).filter(pa.array(keep))

    return dealt.groupBy("block_a", "block_b").cogroup(sent.groupBy("one", "two")).applyInArrow(check, "a long, b long")


def _enough(k: str, ra: str, rb: str, na: str, nb: str, num: int, den: int) -> Column:
    """Whether two sets may link that share ``k`` shingles up to ranks ``ra`` and ``rb``: the rest bounds their overlap."""
    most = F.col(k) + F.least(F.col(na) - F.col(ra) - 1, F.col(nb) - F.col(rb) - 1)
    return most * (den + num) >= (F.col(na) + F.col(nb)) * num


def _star_pairs(posts: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """For each class its best list head, as (a: class, b: head), if the lists they meet in leave hope of a link.

    Only a proposal for the first round: what it leaves out is left to the second.
    """
    size = classes.select(F.col("c").alias("id"), F.col("n").alias("size"))
    pairs = (posts.where("c <> head").groupBy("c", "head")
             .agg(F.count(F.lit(1)).alias("k"), F.max("r").alias("rc"), F.max("head_r").alias("rh"))
             .join(size, F.col("c") == F.col("id")).withColumnRenamed("size", "nc").drop("id")
             .join(size, F.col("head") == F.col("id")).withColumnRenamed("size", "nh").drop("id")
             .where((F.least("nc", "nh") * den >= F.greatest("nc", "nh") * num)
                    & _enough("k", "rc", "rh", "nc", "nh", num, den)))
    best = F.max(F.struct(F.col("k"), (-F.col("head")).alias("b"))).alias("best")
    return pairs.groupBy("c").agg(best).select(F.col("c").alias("a"), (-F.col("best.b")).alias("b"))


def hopeful(posts: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Postings that a link can rest on, with n, matches and ``m``, the number of the class's postings of lower rank.

    A shingle of lower rank than a shared prefix shingle is shared only if it is in both prefixes, so the ``r - m``
    ones that no other class has in its prefix are lost to every partner found here. Where that leaves less than the
    least overlap the posting goes: of linked classes all shared prefix shingles stay.
    """
    info = classes.select(F.col("c").alias("id"), "n", "matches")
    place = Window.partitionBy("c").orderBy("r")
    need = F.floor((F.col("n") * num + (den - 1)) / den).cast("long")
    return (posts.withColumn("m", F.row_number().over(place) - 1).join(info, F.col("c") == F.col("id")).drop("id")
            .where(F.col("n") - (F.col("r") - F.col("m")) >= need))


def _cross_pairs(posts: DataFrame, parts: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of classes of different components that pass the multi-match, size and rank filters."""
    part = parts.select(F.col("node").alias("node"), "component")
    rows = (posts.select("t", "c", "r", "m", "n", "matches")
            .join(part, F.col("c") == F.col("node"), "left")
            .withColumn("part", F.coalesce("component", "c")).drop("node", "component"))
    mixed = (rows.groupBy("t").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
             .select(F.col("t").alias("token")))
    rows = written(rows.join(mixed, F.col("t") == F.col("token")).drop("token"), "near-mixed")
    x, y = rows.alias("x"), rows.alias("y")
    larger = (F.col("x.n") > F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.c") > F.col("y.c")))

    def within(side: str) -> Column:
        n = F.col(f"{side}.n")
        need = F.floor((n * num + (den - 1)) / den).cast("long")
        return F.col(f"{side}.r") < n - need + F.col("x.matches")

    # shared shingles up to this one: at most the fewer postings below it on either side, and itself
    most = 1 + F.least("x.m", "y.m") + F.least(F.col("x.n") - F.col("x.r") - 1, F.col("y.n") - F.col("y.r") - 1)
    shared = (x.join(y, (F.col("x.t") == F.col("y.t")) & (F.col("x.part") != F.col("y.part")) & larger
                     & (F.col("y.n") * den >= F.col("x.n") * num) & within("x") & within("y")
                     & (most * (den + num) >= (F.col("x.n") + F.col("y.n")) * num))
              .groupBy(F.col("x.c").alias("a"), F.col("y.c").alias("b"))
              .agg(F.count(F.lit(1)).alias("k"), F.max("x.r").alias("ra"), F.max("y.r").alias("rb"),
                   F.first("x.n").alias("na"), F.first("y.n").alias("nb"), F.first("x.matches").alias("want")))
    return shared.where((F.col("k") >= F.col("want")) & _enough("k", "ra", "rb", "na", "nb", num, den)).select("a", "b")


def near_classes(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, components): rows of ``docs`` with their class, classes, and (node, component) of linked classes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    staged = C.stage(docs.select("doc_id", *_row_key(), "text"), CHUNK_BYTES)
    rows = written(profiles(staged, shingle_levels(staged, k), k, num, den, kind), "near-profiles")
    full = rows.where("n > 0")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("rep"), F.col("body").alias("body"),
                     F.col("id_key").alias("id_key"))
    reps = full.groupBy("hi", "lo", "n").agg(F.min(first).alias("first"), F.min("matches").alias("matches"),
                                             F.min("prefix").alias("prefix"))
    # a class goes by the first half of its fingerprint, so that whoever has its set knows its name
    classes = written(reps.select(F.col("hi").alias("c"), "hi", "lo", "n", "matches", "prefix",
                                  "first.rep", "first.body", "first.id_key"), "near-classes")
    posts = written(hopeful(postings(classes), classes, num, den), "near-postings")

    def links(pairs: DataFrame) -> DataFrame:
        """The pairs that link, verified on whole sets."""
        pairs = written(pairs, "near-pairs")
        met = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        wanted = met.join(classes, F.col("id") == F.col("c")).select("id_key", "body")
        sets = written(class_sets(docs, written(wanted, "near-wanted"), k), "near-sets")
        return written(verified(pairs, sets, num, den), "near-links")

    parts = components(links(_star_pairs(posts, classes, num, den)))
    more = links(_cross_pairs(posts, parts, num, den))
    # links of the second round join components of the first
    nodes = parts.select(F.col("node").alias("id"), "component")
    lifted = (more.join(nodes, F.col("a") == F.col("id"), "left").withColumn("a", F.coalesce("component", "a")).select("a", "b")
              .join(nodes, F.col("b") == F.col("id"), "left").withColumn("b", F.coalesce("component", "b")).select("a", "b"))
    last = components(lifted)
    joined = (parts.join(last.select(F.col("node").alias("id"), F.col("component").alias("root")),
                         F.col("component") == F.col("id"), "left")
              .select("node", F.coalesce("root", "component").alias("component"))
              .unionByName(last.join(parts.select(F.col("node").alias("id")), F.col("node") == F.col("id"), "left_anti")))
    return rows, classes, written(joined, "near-components")


def near_groups(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, body, n_shingles, component_id (least doc_id of the component; null ids last),
    first_body (body of the component's first row)."""
    rows, classes, parts = near_classes(docs, k, num, den)
    placed = (classes.select("c", "hi", "lo", "n", "rep", "body")
              .join(parts, F.col("c") == F.col("node"), "left").withColumn("part", F.coalesce("component", "c")))
    first = F.struct(F.col("rep").isNull().alias("unknown"), F.col("rep"), F.col("body"))
    heads = placed.groupBy("part").agg(F.min(first).alias("first"))
    found = (placed.select("hi", "lo", "n", "part").join(heads, "part")
             .select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), F.col("n").alias("n2"),
                     F.col("first.rep").alias("component"), F.col("first.body").alias("first_body")))
    alone = F.col("n") == 0
    return (rows.select("doc_id", "body", "n", "hi", "lo")
            .join(found, (F.col("hi") == F.col("hi2")) & (F.col("lo") == F.col("lo2")) & (F.col("n") == F.col("n2")), "left")
            .select("doc_id", "body", F.col("n").alias("n_shingles"),
                    F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
                    F.when(alone, F.col("body")).otherwise(F.col("first_body")).alias("first_body")))


def near_dedup(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: the first row of each component, and rows without words."""
    groups = near_groups(docs, k, num, den).where("n_shingles > 0")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("body") == F.col("first_body"))
    keys = groups.groupBy("doc_id", "body").agg(F.count(F.lit(1)).alias("copies"), F.max(kept).alias("kept"))
    return stay(docs, {"doc_id": F.col("doc_id"), "body": F.xxhash64("text")},
                written(keys.where(~F.col("kept") | (F.col("copies") > 1)), "near-keys"))
