"""Reversible line dedup: sharded cuckoo filters before exact reference counts.

A text is split at ``\\n`` (null or empty: one empty line). A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both
ends, A-Z lowered. A key of at least ``SHORTEST`` code points held by several documents belongs to the smallest
doc_id that holds it (null: the largest); it loses its lines in all others. Rows with one doc_id are one document.

Index. Documents are staged in chunks. A chunk sends each shard (a range of the key's hash) one record per distinct
key: the key, how many of its rows hold it and their smallest doc_id. These records are the exact reference counts; a shard
appends them to its log. Its cuckoo filter holds the fingerprints of all live keys. A record whose key the filter does
not know is surely new and goes to the log unread; one that it may know is noted as shared. So an insertion reads
the filters and never the log, and a key that is everywhere is one record per chunk.

Deletion. The chunks of deleted documents are retracted and what is left of them is staged again. A key whose last
reference goes leaves the filter, unless a live key has the same fingerprint in the same buckets: the log tells
exactly. After an insertion is deleted every result is as before.

Reading. Only log records of shared keys can lose lines. Their least owner goes back to the chunks, which drop lines.
Every change is a new version, committed by one rename; a crash before that leaves the last version as it was.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestar.llm import bins as B
from ridestar.llm import chunks as C
from ridestar.llm.words import LANES, U64, bounds, mix, pieces, text_column
from ridestar.sources.snapshots import Snapshots

SHORTEST = 10
#: Fixed value: the characters of [\x20\x09-\x0D].
WHITE = b" \t\n\x0b\x0c\r"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
NO_ID = np.iinfo(np.int64).max

#: A record: the key's 128-bit hash, rows of the chunk that hold it, their smallest doc_id.
RECORD = [np.uint64, np.uint64, np.uint32, np.int64]
STATE, OLD, GONE, NEW = range(4)
ROWS = f"{C.PIECE}, kind int"


# ------------------------------------------------------------------ the filter

class Cuckoo:
    """Fingerprints of 64-bit hashes in buckets of four; tables of growing size are added as it fills.

    A fingerprint and its pair of buckets are a place; keys of one place share its entry.
    """

    SLOTS, LOAD, KICKS = 4, 0.8, 300

    def __init__(self, tables: list[np.ndarray] | None = None):
        self.tables = tables or []

    def places(self, table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of each key."""
        mixed = mix(keys)   # a shard's keys begin with the same bits
        mark = (mixed >> U64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (mixed & U64(len(table) - 1)).astype(np.int64)
        return mark, first, self.other(table, mark, first)

    @staticmethod
    def other(table: np.ndarray, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(mark.astype(np.uint64) * LANES[1, 0]) & U64(len(table) - 1)).astype(np.int64)

    def _in(self, table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(table, keys)
        return (table[one] == mark[:, None]).any(axis=1) | (table[two] == mark[:, None]).any(axis=1)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """False: surely not inserted."""
        return reduce(np.logical_or, [self._in(t, keys) for t in self.tables], np.zeros(len(keys), dtype=bool))

    def insert(self, keys: np.ndarray) -> None:
        """Enters keys that the filter does not contain."""
        while len(keys):
            room = sum(int((t == 0).sum()) - int((1 - self.LOAD) * t.size) for t in self.tables[-1:])
            if room < len(keys):
                have = max((len(t) for t in self.tables), default=0)
                size = 1 << int(np.ceil(np.log2(max(len(keys) / (self.SLOTS * self.LOAD), 2 * have, 2))))
                self.tables.append(np.zeros((size, self.SLOTS), dtype=np.uint16))
            keys = keys[self._left_over(self.tables[-1], keys)]
            if len(keys):   # a full pair of buckets: the next table has others
                self.tables.append(np.zeros((2 * len(self.tables[-1]), self.SLOTS), dtype=np.uint16))

    def _left_over(self, table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Enters keys into one table; the indices of those that found no room (the entries they drove out are back)."""
        mark, bucket, two = self.places(table, keys)
        _, first = np.unique(np.minimum(bucket, two).astype(np.uint64) << U64(16) | mark, return_index=True)
        before, mark, bucket = table.copy(), mark[first], bucket[first]
        rng = np.random.Generator(np.random.PCG64(len(keys)))
        for _ in range(self.KICKS):
            for _ in range(2):
                for slot in range(self.SLOTS):
                    if not len(mark):
                        return first[:0]
                    free = np.flatnonzero(table[bucket, slot] == 0)
                    _, pick = np.unique(bucket[free], return_index=True)
                    chosen = free[pick]
                    table[bucket[chosen], slot] = mark[chosen]
                    mark, bucket = np.delete(mark, chosen), np.delete(bucket, chosen)
                bucket = self.other(table, mark, bucket)
            _, chosen = np.unique(bucket, return_index=True)
            slot = rng.integers(0, self.SLOTS, len(chosen))
            mark[chosen], table[bucket[chosen], slot] = table[bucket[chosen], slot], mark[chosen].copy()
            bucket[chosen] = self.other(table, mark[chosen], bucket[chosen])
        table[:] = before
        return first

    def delete(self, dead: np.ndarray, live: np.ndarray) -> None:
        """Takes out the entries of ``dead`` keys at whose place no ``live`` key is."""
        for table in self.tables:
            mark, one, two = self.places(table, dead)
            place = np.minimum(one, two).astype(np.uint64) << U64(16) | mark
            its, a, b = self.places(table, live)
            held = np.minimum(a, b).astype(np.uint64) << U64(16) | its
            _, first = np.unique(place, return_index=True)
            first = first[~np.isin(place[first], held)]
            for bucket in (one[first], two[first]):
                for slot in range(self.SLOTS):
                    hit = table[bucket, slot] == mark[first]
                    table[bucket[hit], slot] = 0

    def size(self) -> int:
        return sum(int((t != 0).sum()) for t in self.tables)


def _packed(cuckoo: Cuckoo, shared: np.ndarray) -> bytes:
    head = np.array([len(cuckoo.tables), *(len(t) for t in cuckoo.tables), len(shared)], dtype=np.int64)
    return b"".join([head.tobytes(), *(t.tobytes() for t in cuckoo.tables), shared.tobytes()])


def _unpacked(data) -> tuple[Cuckoo, np.ndarray]:
    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    sizes = np.frombuffer(data, dtype=np.int64, count=n + 1, offset=8)
    at, tables = 8 * (n + 2), []
    for m in sizes[:-1].tolist():
        tables.append(np.frombuffer(data, dtype=np.uint16, count=m * Cuckoo.SLOTS, offset=at).reshape(m, Cuckoo.SLOTS).copy())
        at += 2 * m * Cuckoo.SLOTS
    return Cuckoo(tables), np.frombuffer(data, dtype=KEY, count=int(sizes[-1]), offset=at)


KEY = np.dtype([("hi", np.uint64), ("lo", np.uint64)])


def _keys(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    out = np.empty(len(hi), dtype=KEY)
    out["hi"], out["lo"] = hi, lo
    return out


# ------------------------------------------------------------------ lines of a chunk

class Lines:
    """The lines of a chunk (rows of doc_id, text) and the keys of those that can be lost."""

    def __init__(self, rows: pa.RecordBatch):
        ids = rows.column(0)
        self.ids = ids
        self.order = np.where(np.asarray(ids.is_null()), NO_ID, np.asarray(ids.fill_null(NO_ID)))
        data, offsets = bounds(rows.column(1))
        self.lines, digests, doc, at = [], [], [], []
        for i in range(len(offsets) - 1):
            text = data[offsets[i]:offsets[i + 1]].tobytes()
            lines = text.split(b"\n")
            for k, line in enumerate(text.translate(_LOWER).split(b"\n")):
                key = line.strip(WHITE)
                if len(key) >= SHORTEST and (len(key) >= 4 * SHORTEST or len(key.decode()) >= SHORTEST):
                    digests.append(xxhash.xxh3_128_digest(key))
                    doc.append(i)
                    at.append(k)
            self.lines.append(lines)
        both = np.frombuffer(b"".join(digests), dtype=">u8").astype(np.uint64).reshape(-1, 2)
        self.keys = _keys(both[:, 0], both[:, 1])
        self.doc, self.at = np.array(doc, dtype=np.int64), np.array(at, dtype=np.int64)

    def records(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Columns of ``RECORD`` for the distinct keys in order, and each line's number among them."""
        keys, back = np.unique(self.keys, return_inverse=True)
        owner = np.full(len(keys), NO_ID, dtype=np.int64)
        np.minimum.at(owner, back, self.order[self.doc])
        rows = np.unique(back.astype(np.int64) * len(self.lines) + self.doc) // max(len(self.lines), 1)
        refs = np.bincount(rows, minlength=len(keys)).astype(np.uint32)
        return [keys["hi"], keys["lo"], refs, owner], back


def _opened(body: pa.Scalar) -> Lines:
    return Lines(C.opened(body))


# ------------------------------------------------------------------ the index

class LineIndex:
    """An index of documents at ``base``, a folder of its own in the shared file system."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.store = spark, Snapshots(spark, base)

    def insert(self, docs: DataFrame) -> None:
        """Adds the rows (doc_id, text) of ``docs``."""
        self._change(docs, None)

    def delete(self, ids: DataFrame) -> None:
        """Takes out all rows with the doc_ids of ``ids`` (a column doc_id); ids that are not there are ignored."""
        number, state = self.store.current()
        if not number:
            return
        ids = ids.select(F.col("doc_id").cast("long").alias("gone_id")).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("gone_id"))
        members = self._chunks(state).select("chunk", F.explode("ids").alias("doc_id"))
        folder = self.store.new_folder("gone")
        members.join(ids, same).select("chunk").distinct().write.parquet(self.store.at(folder))
        gone = self.spark.read.parquet(self.store.at(folder))
        rest = (self._chunks(state).join(gone, "chunk", "left_semi").mapInArrow(_documents, "doc_id long, text string")
                .join(ids, same, "left_anti"))
        self._change(rest, folder)

    def cleaned(self) -> DataFrame:
        """doc_id, n_lines, n_dropped, text: a row per row inserted and not deleted, ``text`` what is left of it."""
        _, state = self.store.current()
        if not state:
            return self.spark.createDataFrame([], "doc_id long, n_lines long, n_dropped long, text string")
        asked = (self._state(state).unionByName(self._log(state, OLD))
                 .repartitionById(state["bins"], "bin").mapInArrow(_owners, C.PIECE))
        return (self._chunks(state).join(C.gathered(asked, "found"), F.col("chunk") == F.col("found_chunk"), "left")
                .select("chunk", "body", "found").mapInArrow(_without(state["bins"]), "doc_id long, n_lines long, n_dropped long, text string"))

    # the parts of a version

    def _folders(self, state: dict, name: str) -> DataFrame:
        return self.spark.read.parquet(*[self.store.at(f"{b}/{name}") for b in state["batches"]])

    def _live(self, state: dict, rows: DataFrame) -> DataFrame:
        if not state["gone"]:
            return rows
        gone = self.spark.read.parquet(*[self.store.at(f) for f in state["gone"]])
        return rows.join(gone, "chunk", "left_anti")

    def _chunks(self, state: dict) -> DataFrame:
        return self._live(state, self._folders(state, "chunks"))

    def _log(self, state: dict, kind: int) -> DataFrame:
        rows = self._folders(state, "shards").where(F.col("kind") == NEW).select("chunk", "bin", "data")
        return self._live(state, rows).select("chunk", "bin", "data", F.lit(kind).alias("kind"))

    def _state(self, state: dict) -> DataFrame:
        rows = self.spark.read.parquet(self.store.at(f"{state['batches'][-1]}/shards"))
        return rows.where(F.col("kind") == STATE)

    def _change(self, docs: DataFrame, gone: str | None) -> None:
        """A version with ``docs`` added and the chunks of the folder ``gone`` retracted."""
        number, state = self.store.current()
        bins = state.get("bins") or B.bin_count(self.spark)
        batch = self.store.new_folder("batch")
        place = self.store.at(f"{batch}/chunks")
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        docs.mapInArrow(_staged(number + 1), "chunk long, body binary, ids array<long>").write.parquet(place)
        rows = (self.spark.read.parquet(place).select("chunk", "body").mapInArrow(_dealt(bins), C.PIECE)
                .select("*", F.lit(NEW).alias("kind")))
        if state:
            rows = rows.unionByName(self._state(state))
        if gone:
            # a shard reads its exact counts: the retracted ones, and those that stay
            left = self.spark.read.parquet(self.store.at(gone))
            log = self._log(state, OLD)
            rows = rows.unionByName(log.join(left, "chunk", "left_anti").select("chunk", "bin", "data", "kind"))
            rows = rows.unionByName(log.join(left, "chunk", "left_semi")
                                    .select("chunk", "bin", "data", F.lit(GONE).alias("kind")))
        (rows.repartitionById(bins, "bin").mapInArrow(_updated, ROWS).write.parquet(self.store.at(f"{batch}/shards")))
        self.store.commit(number + 1, {"bins": bins, "batches": [*state.get("batches", []), batch],
                                       "gone": [*state.get("gone", []), *([gone] if gone else [])]})


# ------------------------------------------------------------------ the tasks

def _staged(batch: int):
    """Chunks of rows (doc_id, text), numbered by batch, task and order."""

    def run(batches):
        n = (batch << 40) + (TaskContext.get().partitionId() << 18)
        for b in batches:
            texts = text_column(b.column(1))
            rows = pa.RecordBatch.from_arrays([b.column(0), texts], names=["doc_id", "text"])
            for i, j in pieces(texts):
                body = C._body(rows.slice(i, j - i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int64()), pa.array([body], pa.binary()),
                     pa.array([rows.column(0).slice(i, j - i).to_pylist()], pa.list_(pa.int64()))], names=["chunk", "body", "ids"])
                n += 1

    return run


def _documents(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for body in batch.column(1):
            rows = C.opened(body)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1).cast(pa.string())], names=["doc_id", "text"])


def _dealt(bins: int):
    def run(batches):
        for batch in batches:
            for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                columns, _ = _opened(body).records()
                rows = list(C.records(chunk, B.bin_of(columns[0], bins), bins, columns))
                if rows:
                    yield C.batch_of(rows)

    return run


def _by_bin(batches) -> Iterator[tuple[int, dict[int, list[tuple[int, object]]]]]:
    """(bin, kind -> [(chunk, data)]) of a task's rows."""
    rows = [(c, b, d.as_buffer(), k) for x in batches for c, b, d, k in
            zip(x.column(0).to_pylist(), x.column(1).to_pylist(), x.column(2), x.column(3).to_pylist())]
    for b in sorted({r[1] for r in rows}):
        yield b, {kind: [(c, d) for c, of, d, k in rows if of == b and k == kind] for kind in range(4)}


def _all_keys(sent: list[tuple[int, object]]) -> np.ndarray:
    parts = [_keys(*C.split(d, RECORD)[:2]) for _, d in sent]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=KEY)


def _updated(batches) -> Iterator[pa.RecordBatch]:
    """A shard's new log records, and its filter and shared keys after the change."""
    for b, rows in _by_bin(batches):
        cuckoo, shared = _unpacked(rows[STATE][0][1]) if rows[STATE] else (Cuckoo(), np.zeros(0, dtype=KEY))
        if rows[GONE]:
            live = _all_keys(rows[OLD] + rows[NEW])
            gone = _all_keys(rows[GONE])
            dead = gone[~np.isin(gone, live)]
            cuckoo.delete(dead["hi"], live["hi"])
            shared = shared[~np.isin(shared, dead)]
        found = [shared]
        for _, data in rows[NEW]:
            keys = _keys(*C.split(data, RECORD)[:2])
            known = cuckoo.contains(keys["hi"])
            cuckoo.insert(keys["hi"][~known])
            found.append(keys[known])
        shared = np.unique(np.concatenate(found))
        for kind, out in ((STATE, [(-1, b, _packed(cuckoo, shared))]), (NEW, [(c, b, d.to_pybytes()) for c, d in rows[NEW]])):
            if out:
                batch = C.batch_of(out)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([kind] * len(out), pa.int32())],
                                                 names=["chunk", "bin", "data", "kind"])


#: An answer: the number of a record among those sent, and its key's owner.
ANSWER = np.dtype([("at", np.uint32), ("owner", np.int64)])


def _owners(batches) -> Iterator[pa.RecordBatch]:
    """To each chunk, the owners of its shared keys that another document holds first."""
    for b, rows in _by_bin(batches):
        _, shared = _unpacked(rows[STATE][0][1])
        owner = np.full(len(shared), NO_ID, dtype=np.int64)
        hits = []
        for chunk, data in rows[OLD]:
            hi, lo, _, least = C.split(data, RECORD)
            keys = _keys(hi, lo)
            at = np.flatnonzero(np.isin(keys, shared))
            slot = np.searchsorted(shared, keys[at])
            np.minimum.at(owner, slot, least[at])
            hits.append((chunk, at, slot))
        out = []
        for chunk, at, slot in hits:
            if len(at):
                answer = np.empty(len(at), dtype=ANSWER)
                answer["at"], answer["owner"] = at, owner[slot]
                out.append((chunk, b, answer.tobytes()))
        if out:
            yield C.batch_of(out)


def _without(bins: int):
    """The documents of chunks without the lines that other documents own."""

    def run(batches):
        for batch in batches:
            for body, found in zip(batch.column(1), batch.column(2)):
                lines = _opened(body)
                (hi, _, _, owner), back = lines.records()
                # a chunk's records for a bin are a run of its keys in order; answers name places in that run
                first = np.searchsorted(B.bin_of(hi, bins), np.arange(bins))
                for b, answer in C.answers(found, ANSWER).items():
                    owner[first[b] + answer["at"]] = answer["owner"]
                lost = owner[back] < lines.order[lines.doc]
                dropped = [set() for _ in lines.lines]
                for doc, at in zip(lines.doc[lost].tolist(), lines.at[lost].tolist()):
                    dropped[doc].add(at)
                kept = [b"\n".join([x for k, x in enumerate(text) if k not in gone] if gone else text)
                        for text, gone in zip(lines.lines, dropped)]
                yield pa.RecordBatch.from_arrays(
                    [lines.ids, pa.array([len(x) for x in lines.lines], pa.int64()), pa.array([len(x) for x in dropped], pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])

    return run
