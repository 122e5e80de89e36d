"""Substring duplicates: words covered by a window whose word sequence also starts earlier.

Difference cover. Word positions ``p`` of a document with ``p mod 13`` in {0, 1, 3, 9} carry an anchor: a
hash of the 8 words from there. Any two residues have a common shift under 13 that takes both into the
cover, so two equal windows of 20 words share an anchor at the same shift within both, whatever
their alignment. A window can therefore only repeat if it holds an anchor that occurs twice in the
corpus.

1. The texts are staged as chunks (compressed runs of documents) in the shared folder.
2. Each chunk deals its distinct anchors to bins; a bin answers with those seen twice.
3. Each chunk extends its repeated anchors to the windows around them, and deals their
   distinct 96-bit hashes, with the least (doc_id, start) in the chunk; a bin finds the least of all and
   answers with a bit per window hash.
4. Each chunk removes words under windows that are not the first of their kind.

A window's order is (doc_id, start); a null doc_id is last. Rows with one doc_id are one document as far
as order goes, so the same row given twice is not its own duplicate. What a bin gets from a chunk
is bounded by the chunk, and a passage in every document is one record per chunk, so hot passages do not
skew bins. A null text has no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridestar.llm import bins as B
from ridestar.llm import chunks as C
from ridestar.llm.space import written
from ridestar.llm.words import LANES, U64, Words, mix, words_of

#: A perfect difference set modulo 13: every difference of residues occurs.
PERIOD, COVER = 13, (0, 1, 3, 9)
LAST = np.iinfo(np.int64).max
WINDOW = 20


@dataclass
class Chunk:
    """A chunk's documents, words and anchors."""

    ids: pa.Array
    order: np.ndarray
    words: Words
    hashes: np.ndarray
    anchor_at: np.ndarray
    anchors: np.ndarray

    @staticmethod
    def of(body: pa.Scalar, window: int) -> Chunk:
        batch = C.opened(body)
        words = words_of(batch.column(1))
        h = words.hashes()
        width = window - PERIOD + 1
        place = np.arange(len(words)) - np.repeat(words.first[:-1], words.counts())
        left = np.repeat(words.first[1:], words.counts()) - np.arange(len(words))
        at = np.flatnonzero(np.isin(place % PERIOD, COVER) & (left >= width))
        ids = batch.column(0)
        order = ids.fill_null(LAST).to_numpy(zero_copy_only=False)
        return Chunk(ids, order, words, h, at, _window(h, at, width, 0))

    def windows_near(self, repeated: np.ndarray, window: int) -> np.ndarray:
        """Starts of windows that hold one of the anchors marked ``repeated``."""
        n = len(self.words)
        mark = np.zeros(n + 1, dtype=np.int32)
        at = self.anchor_at[repeated]
        owner = np.searchsorted(self.words.first, at, side="right") - 1
        low = np.maximum(at - (PERIOD - 1), self.words.first[owner])
        high = np.minimum(at, self.words.first[owner + 1] - window)
        use = high >= low
        np.add.at(mark, low[use], 1)
        np.add.at(mark, high[use] + 1, -1)
        return np.flatnonzero(np.cumsum(mark[:-1]) > 0)


def _window(h: np.ndarray, at: np.ndarray, width: int, lane: int) -> np.ndarray:
    total = np.zeros(len(at), dtype=np.uint64)
    for i in range(width):
        total += h[at + i] * LANES[lane, i % 64] * U64(2 * (i // 64) + 1)
    return mix(total + U64(width))


def _anchor_keys(chunk: Chunk, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and 32 bits of each anchor: within a bin the rest of the hash tells anchors apart well enough, for a
    collision only adds a window to be looked at."""
    return B.bin_of(chunk.anchors, bins), (chunk.anchors & U64(0xFFFFFFFF)).astype(np.uint32)


def deal_anchors(staged: DataFrame, bins: int, window: int) -> DataFrame:
    def deal(batches):
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunk = Chunk.of(body, window)
                which, key = _anchor_keys(chunk, bins)
                both = np.sort((which.astype(np.uint64) << U64(32)) | key)
                # an anchor that a chunk holds twice or more goes out twice
                third = np.zeros(len(both), dtype=bool)
                third[2:] = both[2:] == both[:-2]
                both = both[~third]
                yield C.batch_of(list(C.records(name, (both >> U64(32)).astype(np.int32), bins, [both.astype(np.uint32)])))

    return staged.mapInArrow(deal, C.PIECE)


def repeated_anchors(dealt: DataFrame, bins: int) -> DataFrame:
    """For each chunk and bin the chunk's anchors that occur twice in the corpus, sorted."""

    def meet(batches):
        for b, rows in C.by_bin(batches):
            mine = [(c, np.frombuffer(d, dtype=np.uint32)) for c, d in rows]
            every = np.sort(np.concatenate([keys for _, keys in mine]))
            twice = np.unique(every[1:][every[1:] == every[:-1]])
            if len(twice) == 0:
                continue
            out = []
            for c, keys in mine:
                at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
                found = np.unique(keys[twice[at] == keys])
                if len(found):
                    out.append((c, b, found.tobytes()))
            yield C.batch_of(out)

    return dealt.repartitionById(bins, "bin").mapInArrow(meet, C.PIECE)


@dataclass
class Candidates:
    """A chunk's candidate windows: those that hold a repeated anchor."""

    starts: np.ndarray      # word index in the chunk of each window
    kind: np.ndarray        # index of each window's distinct hash
    which: np.ndarray       # of each distinct hash: its bin (sorted)
    hash1: np.ndarray
    hash2: np.ndarray
    doc: np.ndarray         # of each distinct hash: the least (doc_id, start) in the chunk
    start: np.ndarray
    is_least: np.ndarray    # of each window: whether it is at that place

    @staticmethod
    def of(chunk: Chunk, answers: dict[int, np.ndarray], bins: int, window: int) -> Candidates:
        which, key = _anchor_keys(chunk, bins)
        repeated = np.zeros(len(key), dtype=bool)
        order = np.argsort(which, kind="stable")
        ends = np.searchsorted(which[order], np.arange(bins + 1))
        for b, known in answers.items():
            mine = order[ends[b]:ends[b + 1]]
            at = np.minimum(np.searchsorted(known, key[mine]), len(known) - 1)
            repeated[mine] = known[at] == key[mine]
        starts = chunk.windows_near(repeated, window)
        h1, h2 = (_window(chunk.hashes, starts, window, lane) for lane in (1, 2))
        h2 = (h2 >> U64(32)).astype(np.uint32)
        bin_ = B.bin_of(h1, bins)
        owner = np.searchsorted(chunk.words.first, starts, side="right") - 1
        doc, place = chunk.order[owner], starts - chunk.words.first[owner]
        # h1 sorts by bin first, as bins are ranges of it
        by = np.lexsort((place, doc, h2, h1))
        new = np.ones(len(by), dtype=bool)
        new[1:] = (h1[by][1:] != h1[by][:-1]) | (h2[by][1:] != h2[by][:-1])
        kind = np.empty(len(by), dtype=np.int64)
        kind[by] = np.cumsum(new) - 1
        least = by[new]
        d, s = doc[least], place[least]
        return Candidates(starts, kind, bin_[least], h1[least], h2[least], d, s.astype(np.uint32),
                          (doc == d[kind]) & (place == s[kind]) if len(by) else np.zeros(0, dtype=bool))


def deal_windows(chunks: DataFrame, bins: int, window: int) -> DataFrame:
    """Distinct candidate windows of (chunk, body, anchors) rows, with the least place of each."""

    def deal(batches):
        for batch in batches:
            for name, body, known in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                c = Candidates.of(Chunk.of(body, window), C.answers(known, np.uint32), bins, window)
                yield C.batch_of(list(C.records(name, c.which, bins, [c.hash1, c.hash2, c.doc, c.start])))

    return chunks.mapInArrow(deal, C.PIECE)


def first_windows(dealt: DataFrame, bins: int) -> DataFrame:
    """For each chunk and bin a bit per window hash it sent: whether the chunk has its first window."""

    def meet(batches):
        for b, mine in C.by_bin(batches):
            parts = [C.split(data, [np.uint64, np.uint32, np.int64, np.uint32]) for _, data in mine]
            h1, h2, doc, start = (np.concatenate(p) for p in zip(*parts))
            by = np.lexsort((start, doc, h2, h1))
            new = np.ones(len(by), dtype=bool)
            new[1:] = (h1[by][1:] != h1[by][:-1]) | (h2[by][1:] != h2[by][:-1])
            group = np.cumsum(new) - 1
            least = by[new][group]   # in order of ``by``
            is_first = np.zeros(len(by), dtype=bool)
            is_first[by] = (doc[by] == doc[least]) & (start[by] == start[least])
            out, at = [], 0
            for (c, _), part in zip(mine, parts):
                out.append((c, b, np.packbits(is_first[at:at + len(part[0])]).tobytes()))
                at += len(part[0])
            yield C.batch_of(out)

    return dealt.repartitionById(bins, "bin").mapInArrow(meet, C.PIECE)


def cover_removed(chunks: DataFrame, bins: int, window: int, out, schema: str) -> DataFrame:
    """Rows that ``out`` (chunk, removed mask over its words) makes of (chunk, body, anchors, firsts) rows."""

    def apply(batches):
        for batch in batches:
            for body, known, bits in zip(*(batch.column(k) for k in (1, 2, 3))):
                chunk = Chunk.of(body, window)
                c = Candidates.of(chunk, C.answers(known, np.uint32), bins, window)
                has_first = np.zeros(len(c.which), dtype=bool)
                ends = np.searchsorted(c.which, np.arange(bins + 1))
                for b, packed in C.answers(bits, np.uint8).items():
                    a, z = ends[b], ends[b + 1]
                    has_first[a:z] = np.unpackbits(packed)[:z - a]
                stays = has_first[c.kind] & c.is_least
                mark = np.zeros(len(chunk.words) + 1, dtype=np.int32)
                gone = c.starts[~stays]
                np.add.at(mark, gone, 1)
                np.add.at(mark, gone + window, -1)
                yield out(chunk, np.cumsum(mark[:-1]) > 0)

    return chunks.mapInArrow(apply, schema)


def _deduplicated(docs: DataFrame, window: int, out, schema: str) -> DataFrame:
    if window < PERIOD:
        raise ValueError(f"a window has {PERIOD} words or more")
    bins = B.bin_count(docs.sparkSession)
    staged = C.stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    anchors = C.gathered(written(repeated_anchors(deal_anchors(staged, bins, window), bins), "anchors"), "anchors")
    with_anchors = staged.join(anchors, F.col("chunk") == F.col("anchors_chunk"), "left")
    firsts = written(first_windows(deal_windows(with_anchors.select("chunk", "body", "anchors"), bins, window), bins), "firsts")
    ready = with_anchors.join(C.gathered(firsts, "firsts"), F.col("chunk") == F.col("firsts_chunk"), "left")
    return cover_removed(ready.select("chunk", "body", "anchors", "firsts"), bins, window, out, schema)


def _kept(chunk: Chunk, removed: np.ndarray) -> Iterator[bytes]:
    """Each document's kept words joined by single spaces."""
    w = chunk.words
    data = w.data.tobytes()
    starts, ends = w.starts, w.ends
    for a, b in zip(w.first[:-1], w.first[1:]):
        keep = np.flatnonzero(~removed[a:b]) + a
        yield b" ".join([data[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist())])


def _counts(chunk: Chunk, removed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before = np.zeros(len(removed) + 1, dtype=np.int64)
    np.cumsum(removed, out=before[1:])
    return chunk.words.counts(), before[chunk.words.first[1:]] - before[chunk.words.first[:-1]]


def removed_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``."""

    def out(chunk, removed):
        n, gone = _counts(chunk, removed)
        sha = [hashlib.sha256(k).hexdigest() for k in _kept(chunk, removed)]
        return pa.RecordBatch.from_arrays([chunk.ids, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                                          names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _deduplicated(docs, window, out, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text (kept words joined by single spaces), n_removed for every row of ``docs``."""

    def out(chunk, removed):
        _, gone = _counts(chunk, removed)
        text = [k.decode("utf-8", "replace") for k in _kept(chunk, removed)]
        return pa.RecordBatch.from_arrays([chunk.ids, pa.array(text, pa.string()), pa.array(gone, pa.int64())],
                                          names=["doc_id", "text", "n_removed"])

    return _deduplicated(docs, window, out, "doc_id long, text string, n_removed long")
