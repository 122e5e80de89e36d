"""Phrase collocations: counts from a multikey three-way quicksort of suffix pointers.

Words. Texts (A-Z lowered; null: empty) are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
``[^\\x20\\x09]+``. Everything is per language (null: ``und``). Chunks of texts ask the bins for the count of their
distinct words, in one exchange that also counts and names them; a word with ``least`` occurrences gets a
number.

Suffixes. A suffix pointer stands at each word and sees up to ``LONGEST`` words of its piece, as far as they are
frequent (no phrase with a rare word can be frequent). Pointers with the same words in a chunk are one with a weight. They
are routed globally by their two leading words, so all occurrences of a phrase meet in one bin. A pair of hot words
(both in a large share of all positions) is routed by three words, a hot triple by four; the
shares of such a pair or triple are then added up over the bins.

Counts. A bin sorts its pointers by three-way partitions on one word at a time: the part equal to the pivot shares one
word more, and its weight is the count of that phrase; the lesser and greater parts are partitioned again at the same
depth. Parts with less than ``least`` occurrences are abandoned. All parts of one generation are partitioned by the same
array operations.

Scores, containment and ranks are joins of the counted phrases with each other; the arithmetic is in decimals of 38
digits. Words are told apart by 64-bit hashes. Ties in the order are broken by count and phrase, so the result is the
same in every run; repeated rows count as often as they are there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridestar.llm import bins as B
from ridestar.llm import chunks as C
from ridestar.llm.space import written
from ridestar.llm.words import LANES, U64, Words, bounds, mix, text_column

LONGEST = 4
LEAST = 30
CONTAINED = 80
TOP = 2000
#: A word is hot if a bin's even share of all positions holds it less than this many times.
HOT_SHARES = 4

#: The characters of [.,;:!?\x0A-\x0D], which end a piece.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in PIECE_ENDS]] = True
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[_ENDS] = 0x20

WORD_ROWS = "hash long, count long, lang string, word string"
NAMES = "array<struct<id: long, lang: string, word: string, n: long>>"
IDS = ["w1", "w2", "w3", "w4"]
#: Words 1 to 4 (0: none), weight, and flags: 1 if the leading pair is hot, 2 if the leading triple is.
SUFFIX = [np.uint32, np.uint32, np.uint32, np.uint32, np.uint32, np.uint8]


class Pieces:
    """Words of a chunk (rows of text, lang): their hashes by language, and which word goes on with the piece of the last."""

    def __init__(self, rows: pa.RecordBatch):
        data, offsets = bounds(text_column(rows.column(0)))
        self.words = Words(_BLANK[data], offsets, fold=True)
        doc = self.words.doc_of_word()
        piece = np.cumsum(_ENDS[data], dtype=np.int64)[self.words.starts]
        self.goes_on = np.zeros(len(doc), dtype=bool)
        self.goes_on[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
        langs = text_column(rows.column(1)).dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = np.asarray(langs.indices)[doc]
        lanes = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs]
        self.lanes = np.array(lanes, dtype=np.uint64)
        self.hashes = mix(self.words.hashes() ^ self.lanes[self.lang]) if len(doc) else np.zeros(0, dtype=np.uint64)

    def word(self, i: int) -> str:
        return self.words.data[self.words.starts[i]:self.words.ends[i]].tobytes().decode()


def _message(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def number_words(staged: DataFrame, least: int, bins: int) -> DataFrame:
    """Counts the words of ``staged`` and numbers the frequent ones.

    Rows (chunk, bin, data): for each distinct word of the chunk in that bin its number (0: rare) and the binary
    logarithm of its count; and rows with ``names``, the frequent words themselves and, as the empty word, each
    language's number of words.
    """

    def deal(batches):
        for batch in batches:
            for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                p = Pieces(C.opened(body))
                key, first, count = np.unique(p.hashes, return_index=True, return_counts=True)
                lang = p.lang[first]
                words = [p.word(i) for i in first]
                which = B.bin_of(key, bins)
                # each language's number of words, as the count of an empty word
                size = np.bincount(p.lang, minlength=len(p.langs))
                total = mix(p.lanes)
                ends = np.searchsorted(which, np.arange(bins + 1))
                total_bin = B.bin_of(total, bins)
                for b in sorted({*np.flatnonzero(np.diff(ends)).tolist(), *total_bin.tolist()}):
                    i, j = ends[b], ends[b + 1]
                    more = np.flatnonzero(total_bin == b)
                    rows = pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([key[i:j], total[more]]).view(np.int64)),
                        pa.array(np.concatenate([count[i:j], size[more]]).astype(np.int64)),
                        pa.array([p.langs[k] for k in [*lang[i:j], *more]], pa.string()),
                        pa.array([*words[i:j], *[""] * len(more)], pa.string())], names=["hash", "count", "lang", "word"])
                    yield C.batch_of([(chunk, int(b), _message(rows))])

    def count(batches):
        for b, sent in C.by_bin(batches):
            rows = [pa.ipc.open_stream(d).read_next_batch() for _, d in sent]
            key, first, back = np.unique(np.concatenate([np.asarray(r.column(0)) for r in rows]),
                                         return_index=True, return_inverse=True)
            total = np.zeros(len(key), dtype=np.int64)
            np.add.at(total, back, np.concatenate([np.asarray(r.column(1)) for r in rows]))
            word = pa.chunked_array([r.column(3) for r in rows]).take(pa.array(first))
            lang = pa.chunked_array([r.column(2) for r in rows]).take(pa.array(first))
            is_total = np.asarray(pa.compute.equal(word, "").combine_chunks().to_numpy(zero_copy_only=False))
            number = np.zeros(len(key), dtype=np.int64)
            frequent = np.flatnonzero((total >= least) & ~is_total)
            number[frequent] = np.arange(len(frequent)) * bins + b + 1
            if len(frequent) and number[frequent[-1]] >= 1 << 32:
                raise OverflowError("more than 2^32 frequent words")
            size = np.log2(np.maximum(total, 1)).astype(np.uint8)
            at = 0
            for (chunk, _), r in zip(sent, rows):
                own = back[at:at + r.num_rows]
                at += r.num_rows
                own = own[~is_total[own]]
                yield _with_names([(chunk, b, number[own].astype(np.uint32).tobytes() + size[own].tobytes())], None)
            named = np.flatnonzero((number > 0) | is_total)
            names = pa.StructArray.from_arrays(
                [pa.array(number[named]), lang.take(pa.array(named)).combine_chunks(), word.take(pa.array(named)).combine_chunks(),
                 pa.array(total[named])], names=["id", "lang", "word", "n"])
            yield _with_names([(-1, b, b"")], names)

    def _with_names(rows, names):
        base = C.batch_of(rows)
        kind = pa.list_(pa.struct([("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))
        column = pa.nulls(len(rows), kind) if names is None else \
            pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names.cast(kind.value_type))
        return pa.RecordBatch.from_arrays([*base.columns, column], names=["chunk", "bin", "data", "names"])

    sent = staged.mapInArrow(deal, C.PIECE).repartitionById(bins, "bin")
    return written(sent.mapInArrow(count, f"{C.PIECE}, names {NAMES}"), "word-numbers")


def suffixes(p: Pieces, number: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct suffixes (rows of ``LONGEST`` numbers) of two words and more, their weights and flags."""
    n = len(number)
    seen = [number]
    on = p.goes_on & (number > 0)
    going = np.ones(n, dtype=bool)
    for d in range(1, LONGEST):
        step = np.zeros(n, dtype=bool)
        step[:max(n - d + 1, 0)] = on[d - 1:]
        going = going & step
        follow = np.zeros(n, dtype=number.dtype)
        follow[:max(n - d, 0)] = number[d:]
        follow[~going] = 0
        going = going & (follow > 0)
        seen.append(follow)
    at = np.flatnonzero((seen[0] > 0) & (seen[1] > 0))
    columns = [s[at] for s in seen]
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(at), dtype=bool)
    if len(at):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(at)))
    at = at[order][first]
    words = np.stack([c[first] for c in columns]) if len(at) else np.zeros((LONGEST, 0), dtype=np.uint32)
    third = np.zeros(len(at), dtype=bool)
    pair = hot[at] & hot[np.minimum(at + 1, n - 1)]
    third[words[2] > 0] = hot[np.minimum(at + 2, n - 1)][words[2] > 0]
    return words, weight, pair.astype(np.uint8) | ((pair & third).astype(np.uint8) << 1)


def route(words: np.ndarray, flags: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each suffix: by two leading words, by three after a hot pair, by four after a hot triple."""
    wide = words.astype(np.uint64)
    key = wide[0] * LANES[0, 0] + wide[1] * LANES[0, 1]
    key = key + np.where(flags & 1, wide[2], U64(0)) * LANES[0, 2]
    key = key + np.where(flags & 2, wide[3], U64(0)) * LANES[0, 3]
    return B.bin_of(mix(key), bins)


def sorted_parts(words: np.ndarray, weight: np.ndarray, flags: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Multikey three-way quicksort of suffix pointers: (a member of each equal part, depth, weight) by generations.

    A part is given if it has ``least`` occurrences, or if its phrase is spread over bins (flags).
    """
    pointer = np.arange(words.shape[1])
    first = np.zeros(1, dtype=np.int64)
    depth = np.zeros(1, dtype=np.int64)
    while len(pointer):
        size = np.diff(np.append(first, len(pointer)))
        part = np.repeat(np.arange(len(first)), size)
        symbol = words[depth[part], pointer]
        middle = np.sort(np.stack([symbol[first], symbol[first + size // 2], symbol[first + size - 1]]), axis=0)[1]
        pivot = middle[part]
        side = (symbol >= pivot).astype(np.int8) + (symbol > pivot)
        counts = np.bincount(part * 3 + side, minlength=3 * len(first))
        starts = np.cumsum(counts) - counts
        moved = np.empty_like(pointer)
        for s in range(3):
            own = counts[s::3]
            moved[np.repeat(starts[s::3] - (np.cumsum(own) - own), own) + np.arange(own.sum())] = pointer[side == s]
        used = np.flatnonzero(counts)
        first, pointer, size = starts[used], moved, counts[used]
        equal = used % 3 == 1
        depth = depth[used // 3] + equal
        total = np.add.reduceat(weight[pointer], first)
        flag = np.bitwise_or.reduceat(flags[pointer], first)
        spread = ((depth < 2) & (flag & 1 > 0)) | ((depth < 3) & (flag & 2 > 0))
        for d in range(2, LONGEST + 1):
            share = (flag & 1 > 0) if d == 2 else (flag & 2 > 0) if d == 3 else np.zeros(len(flag), dtype=bool)
            out = np.flatnonzero(equal & (depth == d) & ((total >= least) | share))
            if len(out):
                yield pointer[first[out]], d, total[out]
        keep = (depth < LONGEST) & ((total >= least) | spread)
        stays = np.repeat(keep, size)
        # members of an equal part whose suffix ends here have no further word
        end = np.repeat(equal, size)
        here = np.flatnonzero(end & stays)
        stays[here] = words[np.repeat(depth, size)[here], pointer[here]] > 0
        part = np.repeat(np.arange(len(size)), size)[stays]
        pointer = pointer[stays]
        left = np.bincount(part, minlength=len(size))
        kept = np.flatnonzero(left)
        depth = depth[kept]
        first = np.cumsum(left[kept]) - left[kept]


def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(phrases, names): w1 to w4 (word numbers, 0: none), a; and id, lang, word, n (the empty word: the language's words)."""
    bins = B.bin_count(docs.sparkSession)
    staged = C.stage(docs.select(F.col("text").cast("string").alias("text"),
                                 F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")))
    numbered = number_words(staged, least, bins)
    names = numbered.where("chunk < 0").select(F.explode("names").alias("w")).select("w.*")
    total = names.where("word = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot_size = int(np.log2(max(total // (HOT_SHARES * bins), least)))

    def deal(batches):
        for batch in batches:
            for chunk, body, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                p = Pieces(C.opened(body))
                key, back = np.unique(p.hashes, return_inverse=True)
                if not len(key):
                    continue
                got = C.answers(found, np.uint8)
                parts = [C.split(got[b], [np.uint32, np.uint8]) for b in sorted(got)]
                number, size = (np.concatenate(x) for x in zip(*parts))
                words, weight, flags = suffixes(p, number[back], (size > hot_size)[back])
                which = route(words, flags, bins)
                order = np.argsort(which, kind="stable")
                columns = [*(w[order] for w in words), weight[order].astype(np.uint32), flags[order]]
                rows = list(C.records(chunk, which[order], bins, columns))
                if rows:
                    yield C.batch_of(rows)

    def count(batches):
        for _, sent in C.by_bin(batches):
            parts = list(zip(*(C.split(d, SUFFIX) for _, d in sent)))
            words = np.stack([np.concatenate(c) for c in parts[:LONGEST]])
            weight = np.concatenate(parts[4]).astype(np.int64)
            for member, depth, total in sorted_parts(words, weight, np.concatenate(parts[5]), least):
                columns = [words[d][member].astype(np.int64) if d < depth else np.zeros(len(member), dtype=np.int64)
                           for d in range(LONGEST)]
                yield from B.rows([*IDS, "a"], [*columns, total])

    asked = C.gathered(numbered.where("chunk >= 0").select("chunk", "bin", "data"), "found")
    sent = (staged.join(asked, F.col("chunk") == F.col("found_chunk"), "left").select("chunk", "body", "found")
            .mapInArrow(deal, C.PIECE).repartitionById(bins, "bin"))
    shares = sent.mapInArrow(count, ", ".join(f"{c} long" for c in [*IDS, "a"]))
    phrases = shares.groupBy(*IDS).agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return written(phrases, "phrases"), written(names, "words")


def _wide(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def _key(numbers: list[Column], name: str) -> Column:
    """Word numbers as one key, filled up with 0."""
    full = [*numbers, *[F.lit(0).cast("long")] * (LONGEST - len(numbers))]
    return F.struct(*[c.alias(i) for c, i in zip(full, IDS)]).alias(name)


def collocations(docs: DataFrame, least: int = LEAST, contained: int = CONTAINED, top: int | None = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to 4 words of each language, at least ``least`` times there.

    ``a``: occurrences; the score is floor(2000000 a / (l + r)) of the least-scoring cut into a first part (``l``
    occurrences) and a rest (``r``); ties to the earliest cut. Phrases inside a longer one with ``contained`` percent
    of their count or more are left out. ``top``: so many of each language (None: all). An empty table gives no rows.
    """
    phrases, names = phrase_counts(docs, least)
    w = [F.col(c) for c in IDS]
    length = sum((c > 0).cast("int") for c in w)
    unigrams = names.where("id > 0").select(_key([F.col("id")], "key"), F.col("n").alias("f"))
    known = phrases.select(_key(w, "key"), F.col("a").alias("f")).unionByName(unigrams)

    def parts(n: int) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("k"), _key(w[:k], "head"), _key(w[k:n], "rest")) for k in range(1, n)])

    cuts = phrases.select("*", F.explode(F.when(length == 2, parts(2)).when(length == 3, parts(3)).otherwise(parts(4))).alias("cut"))
    heads = known.select(F.col("key").alias("head"), F.col("f").alias("l"))
    rests = known.select(F.col("key").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.select(*IDS, "a", "cut.k", "cut.head", "cut.rest").join(heads, "head").join(rests, "rest")
    score = F.expr("cast(2000000 as decimal(38,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = (cuts.withColumn("score", score.cast("long")).groupBy(*IDS, "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("least")))

    def inside(n: int) -> Column:
        return F.array(*[_key(w[i:i + k], "sub") for k in range(2, n) for i in range(n - k + 1)])

    longer = (phrases.where(length > 2).select("a", F.explode(F.when(length == 3, inside(3)).otherwise(inside(4))).alias("sub"))
              .groupBy("sub").agg(F.max("a").alias("longer")))
    scored = scored.withColumn("key", _key(w, "key")).join(longer, F.col("key") == F.col("sub"), "left").where(
        F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * contained)).drop("key", "sub", "longer")

    words = names.where("id > 0")
    for i, c in enumerate(IDS):
        own = words.select(F.col("id").alias(c), F.col("word").alias(f"t{i}"), *([F.col("lang")] if i == 0 else []))
        scored = scored.join(own, c, "inner" if i < 2 else "left")
    sizes = names.where("word = ''").select(F.col("lang").alias("of"), "n")
    out = (scored.select("lang", F.concat_ws(" ", *[f"t{i}" for i in range(LONGEST)]).alias("phrase"), "a",
                         "least.l", "least.r", "least.score")
           .join(sizes, F.col("lang") == F.col("of")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    out = out.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
