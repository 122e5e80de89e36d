"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Counts. Every n-gram (orders 1 to ``order``) of the training texts is counted; tokens are words with A-Z
lowered, then one end token per document, which is also the context of the next first word.

Filter. A count ``c`` is quantised to level ``1 + floor(log_b c)``; an n-gram of level ``q`` is entered ``q``
times, as (n-gram, 1) to (n-gram, q). A look-up probes (n-gram, 1), (n-gram, 2), ... until one
is missing; the last one found gives the count, as the middle of its level. Counts
are never under their level, and an error of ``d`` levels has the ``d``-th power of the filter's
false-positive rate. The filter is made of one segment per hash bin, each of ``ENTRY_BITS`` per entry
whatever the size of the corpus, so that rate does not rise with it. The segments are written to the shared
folder and broadcast in groups of neighbouring bins of at most ``max_bytes`` each (one segment at least: the
number of bins is to be sized to the data). Chunks are scored with the last group; each group before it is a pass
over the chunks, which notes the levels of their distinct n-grams in its range, a byte each.

Score. p1(w) = (c(w) + 1) / (N + V + 1) and, for each higher order,
p(w | h) = (c(h w) + mu * p(w | shorter h)) / (c(h) + mu), with all counts from the filter and c(h w)
at most c(h).

The add-one base score needs exact counts: each chunk of texts asks the bins for its distinct words'
counts, in one exchange that also counts them. Words are told apart by 64-bit hashes. A null text is
empty (one end token). A null id is a training row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestar.llm import bins as B
from ridestar.llm import chunks as C
from ridestar.llm.space import written
from ridestar.llm.words import LANES, U64, mix, words_of

FOLDS, HELD_OUT = 7, 2
BASE = 1.5
MU = 4.0
ENTRY_BITS, PROBES = 12, 4
MAX_BYTES = 256 << 20
KEY_BITS = 40
END = U64(0xD6E8FEB86659FD93)
COMPACT = 4_000_000
#: Least count of each level.
LEVELS = np.array(sorted({int(np.ceil(BASE**q)) for q in range(106)}), dtype=np.int64)
_MIDDLE = np.concatenate([[0.0], (LEVELS[:-1] + LEVELS[1:] - 1) / 2, [float(LEVELS[-1])]])


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, counts, side="right")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


@dataclass
class Tokens:
    """Token hashes of a chunk: the words of each document, then an end."""

    hashes: np.ndarray
    doc: np.ndarray      # document of each token
    count: np.ndarray    # tokens of each document

    @staticmethod
    def of(texts: pa.Array) -> Tokens:
        w = words_of(texts, fold=True)
        count = w.counts() + 1
        ends = np.cumsum(count) - 1
        h = np.empty(int(count.sum()), dtype=np.uint64)
        is_end = np.zeros(len(h), dtype=bool)
        is_end[ends] = True
        h[is_end] = END
        h[~is_end] = w.hashes()
        return Tokens(h, np.repeat(np.arange(len(count)), count), count)

    def _before(self, back: int) -> np.ndarray:
        """The token ``back`` places earlier; before a document's start that is the end token."""
        start = np.cumsum(self.count) - self.count
        place = np.arange(len(self.hashes)) - np.repeat(start, self.count)
        return np.where(place >= back, np.roll(self.hashes, back), END)

    def grams(self, order: int, skip: int = 0) -> list[np.ndarray]:
        """Hashes of the n-grams (orders 1 to ``order``) that end ``skip`` tokens before each token."""
        out, total = [], np.zeros(len(self.hashes), dtype=np.uint64)
        for n in range(1, order + 1):
            total = total + self._before(skip + n - 1) * LANES[3, n - 1]
            out.append(mix(total + U64(n)))
        return out

    def contexts(self, order: int) -> list[np.ndarray]:
        """Hashes of the contexts of n-grams of orders 2 to ``order``."""
        return self.grams(order - 1, skip=1)


def keys_of(grams: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and ``KEY_BITS``-bit key of n-gram hashes."""
    return B.bin_of(grams, bins), grams & U64((1 << KEY_BITS) - 1)


# ------------------------------------------------------------------ the filter

def _probes(which: np.ndarray, key: np.ndarray, level, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit block within the segment, and the bits to find in it."""
    h = mix(key ^ (which.astype(np.uint64) << U64(KEY_BITS)) ^ mix(np.asarray(level, dtype=np.uint64) * LANES[3, 40]))
    block = ((h >> U64(32)) * sizes >> U64(32)).astype(np.int64)
    bits = np.zeros(len(h), dtype=np.uint64)
    for p in range(PROBES):
        bits |= U64(1) << ((h >> U64(6 * p)) & U64(63))
    return block, bits


def segment(which: int, keys: np.ndarray, counts: np.ndarray, max_blocks: int | None = None) -> np.ndarray:
    """The filter segment of one bin's n-grams, sized by its entries (a bound raises the rate of false positives)."""
    levels = level_of(counts)
    entries = int(levels.sum())
    size = max(1, -(-entries * ENTRY_BITS // 64))
    if max_blocks is not None:
        size = min(size, max_blocks)
    out = np.zeros(size, dtype=np.uint64)
    sizes = np.uint64(size)
    alive = np.arange(len(keys))
    level = 0
    while len(alive):
        level += 1
        block, bits = _probes(np.full(len(alive), which), keys[alive], np.full(len(alive), level), sizes)
        order = np.argsort(block, kind="stable")
        block, bits = block[order], bits[order]
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        out[block[first]] |= np.bitwise_or.reduceat(bits, first)
        alive = alive[levels[alive] > level]
    return out


class Filter:
    """Counts of n-grams of bins ``first`` to ``last`` (exclusive; all unless given) from membership probes."""

    def __init__(self, segments: dict[int, bytes], bins: int, first: int = 0, last: int | None = None):
        self.first, self.last = first, bins if last is None else last
        parts = [np.frombuffer(segments.get(b, b""), dtype=np.uint64) for b in range(self.first, self.last)]
        self.sizes = np.array([max(1, len(p)) for p in parts], dtype=np.uint64)
        self.blocks = np.concatenate([p if len(p) else np.zeros(1, dtype=np.uint64) for p in parts])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        self.bins = bins

    def of(self, grams: np.ndarray) -> np.ndarray:
        """Which n-gram hashes are of this filter's bins."""
        which = B.bin_of(grams, self.bins)
        return (which >= self.first) & (which < self.last)

    def levels(self, distinct: np.ndarray) -> np.ndarray:
        """Level of each n-gram hash, all of this filter's bins (0: surely not there)."""
        which, key = keys_of(distinct, self.bins)
        found = np.zeros(len(distinct), dtype=np.uint8)
        alive = np.arange(len(distinct))
        level = 0
        while len(alive) and level < len(LEVELS):
            level += 1
            w = which[alive]
            at = w - self.first
            block, bits = _probes(w, key[alive], np.full(len(alive), level), self.sizes[at])
            alive = alive[self.blocks[self.starts[at] + block] & bits == bits]
            found[alive] = level
        return found

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Estimated count of each n-gram hash (0: surely not there)."""
        distinct, back = np.unique(grams, return_inverse=True)
        return _MIDDLE[self.levels(distinct)][back]


def _combined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    keys = np.concatenate([k for k, _ in parts]) if parts else np.zeros(0, dtype=np.uint64)
    counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def filter_segments(staged: DataFrame, order: int, bins: int) -> DataFrame:
    """Counts the n-grams of the training rows of ``staged`` (doc_id, text, held) and enters them: (bin, data)."""
    kinds = [np.uint32, np.uint8, np.uint16]

    def send(parts):
        gram, count = _combined(parts)
        which, key = keys_of(gram, bins)   # bins are ranges of the hash: sorted
        while len(key):
            part = np.minimum(count, 0xFFFF)
            yield C.batch_of(list(C.records(0, which, bins, [key.astype(np.uint32), (key >> U64(32)).astype(np.uint8),
                                                             part.astype(np.uint16)])))
            count = count - part
            more = count > 0
            which, key, count = which[more], key[more], count[more]

    def deal(batches):
        parts, held = [], 0
        for batch in batches:
            for body in batch.column(1):
                rows = C.opened(body)
                train = np.flatnonzero(~rows.column(2).to_numpy(zero_copy_only=False))
                t = Tokens.of(rows.column(1).take(pa.array(train)))
                grams = np.sort(np.concatenate(t.grams(order)))
                parts.append(_combined([(grams, np.ones(len(grams), dtype=np.int64))]))
                held += len(parts[-1][0])
                if held > COMPACT:
                    parts = [_combined(parts)]
                    held = len(parts[0][0])
                    if held > COMPACT // 2:
                        yield from send(parts)
                        parts, held = [], 0
        yield from send(parts)

    def enter(batches):
        for b, sent in C.by_bin(batches):
            low, high, count = (np.concatenate(p) for p in zip(*(C.split(d, kinds) for _, d in sent)))
            key, total = _combined([((high.astype(np.uint64) << U64(32)) | low, count.astype(np.int64))])
            yield C.batch_of([(0, b, segment(b, key, total).tobytes())])

    sent = staged.mapInArrow(deal, C.PIECE).repartitionById(bins, "bin")
    return written(sent.mapInArrow(enter, C.PIECE).select("bin", "data"), "filter")


def groups_of(sizes: dict[int, int], bins: int, max_bytes: int) -> list[tuple[int, int]]:
    """Runs of bins (first, last exclusive) that cover all bins; segments of a run have ``max_bytes`` together, or it is one bin."""
    out, first, held = [], 0, 0
    for b in range(bins):
        size = sizes.get(b, 0)
        if b > first and held + size > max_bytes:
            out.append((first, b))
            first, held = b, 0
        held += size
    return [*out, (first, bins)]


def load_filter(segments: DataFrame, bins: int, first: int, last: int) -> Filter:
    rows = segments.where((F.col("bin") >= first) & (F.col("bin") < last)).toArrow()
    return Filter(dict(zip(rows.column("bin").to_pylist(), (d.as_buffer() for d in rows.column("data")))), bins, first, last)


# ------------------------------------------------------------------ exact word counts

def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as one byte each; those of 255 and more follow as 64-bit integers."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def unpack_counts(data, n: int, at: int = 0) -> np.ndarray:
    out = np.frombuffer(data, dtype=np.uint8, count=n, offset=at).astype(np.int64)
    large = np.flatnonzero(out == 255)
    out[large] = np.frombuffer(data, dtype=np.int64, count=len(large), offset=at + n)
    return out


def _distinct_words(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(t.hashes, return_inverse=True)


def word_counts(staged: DataFrame, bins: int) -> DataFrame:
    """For each chunk and bin the exact training counts of the chunk's distinct tokens, aligned with their sorted hashes;
    and a row (-1, bin, (N, V)) per bin."""

    def ask(batches):
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = C.opened(body)
                t = Tokens.of(rows.column(1))
                h, back = _distinct_words(t)
                train = ~rows.column(2).to_numpy(zero_copy_only=False)
                n = np.bincount(back[train[t.doc]], minlength=len(h))
                ends = np.searchsorted(B.bin_of(h, bins), np.arange(bins + 1))   # bins are ranges of the hash: sorted
                yield C.batch_of([(name, b, np.uint32(z - a).tobytes() + h[a:z].tobytes() + pack_counts(n[a:z]))
                                  for b, (a, z) in enumerate(zip(ends[:-1], ends[1:])) if z > a])

    def answer(batches):
        for b, sent in C.by_bin(batches):
            parts = []
            for _, d in sent:
                n = int(np.frombuffer(d, dtype=np.uint32, count=1)[0])
                parts.append((np.frombuffer(d, dtype=np.uint64, count=n, offset=4), unpack_counts(d, n, 4 + 8 * n)))
            h, total = _combined(parts)
            out = [(c, b, pack_counts(total[np.searchsorted(h, k)])) for (c, _), (k, _) in zip(sent, parts)]
            summary = np.array([total.sum(), np.count_nonzero(total)], dtype=np.int64)
            yield C.batch_of([*out, (-1, b, summary.tobytes())])

    return staged.mapInArrow(ask, C.PIECE).repartitionById(bins, "bin").mapInArrow(answer, C.PIECE)


def grams_asked(t: Tokens, h: np.ndarray, order: int) -> list[np.ndarray]:
    """The n-gram hashes a chunk looks up: its distinct tokens ``h``, the end token, then per order from 2 contexts (from 3) and n-grams."""
    out = [mix(h * LANES[3, 0] + U64(1)), mix(END.reshape(1) * LANES[3, 0] + U64(1))]
    for k in range(2, order + 1):
        if k > 2:
            out.append(t.contexts(k)[-1])
        out.append(t.grams(k)[-1])
    return out


def probe(staged: DataFrame, model: Broadcast, order: int, name: int) -> DataFrame:
    """For each chunk the levels of its distinct n-grams in the filter's bins, by hash, as an answer of bin ``name``."""

    def ask(batches):
        lm = model.value
        for batch in batches:
            for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = Tokens.of(C.opened(body).column(1))
                grams = [g[lm.of(g)] for g in grams_asked(t, np.unique(t.hashes), order)]
                yield C.batch_of([(chunk, name, lm.levels(np.unique(np.concatenate(grams))).tobytes())])

    return written(staged.mapInArrow(ask, C.PIECE), "levels")


def gram_counts(lm: Filter, asked: list[np.ndarray], before: np.ndarray) -> list[np.ndarray]:
    """Counts of the n-grams of each array; ``before`` has the levels of the distinct ones in bins under the filter's."""
    if lm.first == 0:
        return [lm.counts(g) for g in asked]
    distinct, back = np.unique(np.concatenate(asked), return_inverse=True)
    counts = _MIDDLE[np.concatenate([before, lm.levels(distinct[len(before):])])][back]   # bins are ranges of the hash
    return np.split(counts, np.cumsum([len(g) for g in asked])[:-1])


def token_probabilities(found: list[np.ndarray], back: np.ndarray, order: int, mu: float, n: int, v: int) -> np.ndarray:
    """The model's probability of each token, given those before it; ``found`` has the counts of ``grams_asked``."""
    words, end, *found = found
    last = words[back]   # of the token itself, looked up once per distinct word
    p = (last + 1) / (n + v + 1)
    if order > 1:   # the word before; at a document's start that is an end token, as the one before it in the chunk
        before = np.empty_like(last)
        before[1:] = last[:-1]
        before[:1] = end
    for k in range(2, order + 1):
        if k > 2:
            before, *found = found
        here, *found = found
        p = (np.minimum(here, before) + mu * p) / (before + mu)
    return p


SCORES = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def lm_scores(docs: DataFrame, order: int = 2, mu: float = MU, max_bytes: int = MAX_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    spark = docs.sparkSession
    bins = B.bin_count(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    staged = C.stage(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held")))
    replies = written(word_counts(staged, bins), "word-counts")
    summary = [np.frombuffer(r["data"], dtype=np.int64) for r in replies.where("chunk = -1").select("data").collect()]
    n, v = (int(x) for x in np.sum(summary, axis=0)) if summary else (0, 0)
    segments = filter_segments(staged, order, bins)
    sizes = {r["bin"]: r["n"] for r in segments.select("bin", F.octet_length("data").alias("n")).collect()}
    *earlier, last = groups_of(sizes, bins, max_bytes)
    replies = replies.where("chunk >= 0")
    for g, (a, z) in enumerate(earlier):
        part = spark.sparkContext.broadcast(load_filter(segments, bins, a, z))
        replies = replies.unionByName(probe(staged, part, order, bins + g))
        part.destroy()
    model = spark.sparkContext.broadcast(load_filter(segments, bins, *last))
    counts = C.gathered(replies, "counts")
    asked = staged.join(counts, F.col("chunk") == F.col("counts_chunk"), "left").select("chunk", "body", "counts")

    def score(batches):
        lm = model.value
        for batch in batches:
            for body, reply in zip(batch.column(1), batch.column(2)):
                rows = C.opened(body)
                t = Tokens.of(rows.column(1))
                h, back = _distinct_words(t)
                got = C.answers(reply, np.uint8)
                sent = np.bincount(B.bin_of(h, bins), minlength=bins)
                c = np.concatenate([unpack_counts(got[b], sent[b]) for b in sorted(got) if b < bins])[back]
                before = np.concatenate([np.zeros(0, dtype=np.uint8), *(got[b] for b in sorted(got) if b >= bins)])
                found = gram_counts(lm, grams_asked(t, h, order), before)
                docs_here = len(t.count)
                base = np.bincount(t.doc, np.log10((c + 1.0) / (n + 1 * (v + 1))), minlength=docs_here)
                known = np.bincount(t.doc, c > 0, minlength=docs_here).astype(np.int64)
                total = np.bincount(t.doc, np.log10(token_probabilities(found, back, order, mu, n, v)), minlength=docs_here)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(2), pa.array(t.count, pa.int64()), pa.array(known),
                     pa.array(np.full(docs_here, n, dtype=np.int64)), pa.array(base), pa.array(total)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return asked.mapInArrow(score, f"doc_id {kind}, {SCORES}")
