"""Token ids as length-delimited binary records with checksums and a separate offset index.

A data set is a folder of shards. ``shard-NNNNNN-ATTEMPT.records`` holds records one after
another, documents in ascending doc_id order within a shard and from shard to shard:

    u64 length of the payload | u32 masked CRC-32 of those 8 bytes
    payload                   | u32 masked CRC-32 of the payload

The payload is i64 doc_id, u8 flags (1: doc_id is null, 2: ids take 4 bytes, else 2), then
the ids, all little-endian. The mask is a rotation plus a constant, so that a checksum
stored inside checksummed data does not cancel out. ``shard-NNNNNN-ATTEMPT.index`` holds the u64
byte offset of each record and the file's length at the end: a shuffled read seeks to
single records. A manifest (Parquet) has a row per shard: records, tokens, bytes.

Each attempt of a task writes files of its own name and puts that name into its row of the manifest, whose commit decides
between attempts: what a lost or repeated attempt leaves is named by no row, and no file is ever replaced. Files go through ``pyarrow.fs``
(local and HDFS or object-store URIs); the folder must be shared by all executors.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridestar.llm.split import KEPT_UNIT_CHARS, KEPT_UNITS, UnitTable
from ridestar.llm.words import pieces, text_column

#: Fixed value: added to the rotated checksum.
MASK_DELTA = 0xA282EAD8
NULL_ID, WIDE = 1, 2
#: Fixed value: the letters that stand for a blank and a line feed in a byte-level vocabulary.
BLANK_LETTERS = "\u0120\u010a"
READ_BYTES = 4 << 20
#: Shards that a task of a shuffled read holds open.
OPEN_FILES = 64
MANIFEST_SCHEMA = "shard int, name string, records long, tokens long, bytes long"
RECORD_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One record."""
    wide = len(ids) > 0 and int(ids.max()) > 0xFFFF
    flags = (NULL_ID if doc_id is None else 0) | (WIDE if wide else 0)
    payload = struct.pack("<qB", doc_id or 0, flags) + ids.astype("<u4" if wide else "<u2").tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join([length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))])


class Damaged(ValueError):
    """A record whose lengths or checksums do not agree."""


def parse(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """doc_id, ids and the offset after the record at ``at``."""
    if at + 12 > len(data):
        raise Damaged(f"a record's head is cut off at byte {at}")
    length, crc = struct.unpack_from("<QI", data, at)
    if masked_crc(bytes(data[at:at + 8])) != crc:
        raise Damaged(f"wrong checksum of a length at byte {at}")
    body, end = at + 12, at + 12 + length
    if end + 4 > len(data):
        raise Damaged(f"a record is cut off at byte {at}")
    if masked_crc(data[body:end]) != struct.unpack_from("<I", data, end)[0]:
        raise Damaged(f"wrong checksum of a record at byte {at}")
    doc_id, flags = struct.unpack_from("<qB", data, body)
    ids = np.frombuffer(data[body + 9:end], dtype="<u4" if flags & WIDE else "<u2")
    return (None if flags & NULL_ID else doc_id), ids.astype("<u4"), end + 4


def file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


_TABLES: dict[str, UnitTable] = {}


def library_table(path: str) -> UnitTable:
    """The tokenizers library behind a table of units, one per worker and vocabulary file."""
    if path not in _TABLES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()

        _TABLES[path] = UnitTable(Together(t).encode, 2 * KEPT_UNITS)
    return _TABLES[path]


#: A blank, then text without blanks and without white space at its ends.
_JOINS = re.compile(r"[ \n]\S(?:[^ \n]*\S)?")


class Together:
    """The library's ids of many units at little cost: units that begin with a blank are encoded as one text.

    Such units, with no other white space at their ends or blank within, are cut apart in any text by the byte-level pattern, so
    their tokens do not depend on each other; and only a unit's first token begins with the blank's letter. Others, and all
    units of a group whose tokens do not come apart that way, go to the library one by one.
    """

    GROUP = 512

    def __init__(self, tokenizer):
        self.one = tokenizer
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.begins[[i for token, i in vocabulary.items() if token[:1] in BLANK_LETTERS]] = True
        self.added = [x.content for x in tokenizer.get_added_tokens_decoder().values()]
        if any(c.isspace() for x in self.added for c in x):   # one could lie across two units
            self.GROUP = 1

    def joins(self, unit: str) -> bool:
        return len(unit) <= KEPT_UNIT_CHARS and _JOINS.fullmatch(unit) is not None and not any(x in unit for x in self.added)

    def encode(self, units: list[str]) -> Iterator[bytes]:
        for i in range(0, len(units), self.GROUP):
            group = units[i:i + self.GROUP]
            out: dict[int, bytes] = {}
            joined = [k for k, u in enumerate(group) if self.joins(u)]
            if joined:
                ids = np.array(self.one.encode_batch_fast(["".join([group[k] for k in joined])], add_special_tokens=False)[0].ids,
                               dtype="<u4")
                ends = [*np.flatnonzero(self.begins[ids]).tolist(), len(ids)]
                if len(ends) == len(joined) + 1:
                    packed = ids.tobytes()
                    out = {k: packed[4 * a:4 * z] for k, a, z in zip(joined, ends, ends[1:])}
            rest = [k for k in range(len(group)) if k not in out]
            for k, e in zip(rest, self.one.encode_batch_fast([group[k] for k in rest], add_special_tokens=False)):
                out[k] = struct.pack(f"<{len(e.ids)}I", *e.ids)
            yield from (out[k] for k in range(len(group)))


def write_token_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encodes every whole text (null: empty), appends ``end_id`` and writes the shards; returns the manifest.

    Rows are dealt by ranges of doc_id (null first; rows of one id by a hash of their text), so a
    shard is a run of documents in order; repeated rows are records of their own.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("__tie")]
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
            .withColumn("__tie", F.xxhash64("text"))
            .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))

    def write(batches):
        table = library_table(tokenizer)
        end = np.array([end_id], dtype="<u4")
        task = TaskContext.get()
        fs, base = file_system(folder)
        fs.create_dir(base)
        name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        own = f"{base}/{name}"
        offsets, tokens, size, buffer = [], 0, 0, []
        with fs.open_output_stream(f"{own}.records") as out:
            for batch in batches:
                texts, doc_ids = text_column(batch.column(1)), batch.column(0)
                for i, j in pieces(texts):
                    for doc_id, packed in zip(doc_ids[i:j].to_pylist(), table.encode(texts[i:j].to_pylist())):
                        ids = np.concatenate([np.frombuffer(packed, dtype="<u4"), end])
                        record = frame(doc_id, ids)
                        offsets.append(size)
                        size += len(record)
                        tokens += len(ids)
                        buffer.append(record)
                    out.write(b"".join(buffer))
                    buffer = []
        if not offsets:
            fs.delete_file(f"{own}.records")
            return
        with fs.open_output_stream(f"{own}.index") as out:
            out.write(np.array([*offsets, size], dtype="<u8").tobytes())
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([task.partitionId()], pa.int32()), "name": pa.array([name]), "records": pa.array([len(offsets)], pa.int64()),
            "tokens": pa.array([tokens], pa.int64()), "bytes": pa.array([size], pa.int64())})

    manifest = rows.mapInArrow(write, MANIFEST_SCHEMA)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A row per shard with ``start``, the number of tokens in all shards before it."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/manifest")
    return rows.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_token_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records in order of their shards: doc_id, start (ids before it), n_tokens, ids (binary, u32).

    Lengths and checksums are verified; a damaged record raises ``Damaged``.
    """
    manifest = read_manifest(spark, folder)
    shards = max(1, manifest.count())

    def read(batches):
        fs, base = file_system(folder)
        for batch in batches:
            for name, start, size in zip(*(batch.column(k).to_pylist() for k in range(3))):
                rows: list[tuple] = []
                pending = 0
                with fs.open_input_stream(f"{base}/{name}.records") as f:
                    rest, done, seen = b"", False, 0
                    while not done:
                        block = f.read(READ_BYTES)
                        seen += len(block)
                        done = not block
                        data = memoryview(rest + block)
                        at = 0
                        while at < len(data):
                            if not done and (at + 12 > len(data)
                                             or at + 16 + struct.unpack_from("<Q", data, at)[0] > len(data)):
                                break
                            doc_id, ids, at = parse(data, at)
                            rows.append((doc_id, start, len(ids), ids.tobytes()))
                            start += len(ids)
                            pending += 4 * len(ids)
                            if pending >= READ_BYTES:
                                yield _records(rows)
                                rows, pending = [], 0
                        rest = bytes(data[at:])
                if seen != size:
                    raise Damaged(f"{name} has {seen} bytes, the manifest says {size}")
                if rows:
                    yield _records(rows)

    return manifest.select("name", "start", "bytes").repartition(shards).mapInArrow(read, RECORD_SCHEMA)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])


def read_shuffled(spark: SparkSession, folder: str, seed: int, epoch: int = 0) -> DataFrame:
    """All records in a pseudo-random order fixed by ``seed`` and ``epoch``: order, doc_id, n_tokens, ids.

    The index alone is shuffled (16 bytes a record); tasks then seek to their records.
    """
    manifest = read_manifest(spark, folder)
    shards = max(1, manifest.count())

    def entries(batches):
        fs, base = file_system(folder)
        for batch in batches:
            for shard, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_stream(f"{base}/{name}.index") as f:
                    at = np.frombuffer(f.read(), dtype="<u8").astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(np.full(len(at) - 1, shard, dtype=np.int32)), "name": pa.array([name] * (len(at) - 1)), "at": pa.array(at[:-1]),
                    "size": pa.array(np.diff(at))})

    def fetch(batches):
        fs, base = file_system(folder)
        for batch in batches:
            order, name, at, size = (batch.column(k).to_pylist() for k in range(4))
            files, rows = {}, []
            for o, s, a, n in zip(order, name, at, size):
                if s not in files:
                    if len(files) == OPEN_FILES:
                        files.pop(next(iter(files))).close()
                    files[s] = fs.open_input_file(f"{base}/{s}.records")
                files[s].seek(a)
                doc_id, ids, _ = parse(memoryview(files[s].read(n)), 0)
                rows.append((o, doc_id, len(ids), ids.tobytes()))
            for f in files.values():
                f.close()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["order", "doc_id", "n_tokens", "ids"])

    index = (manifest.select("shard", "name").repartition(shards).mapInArrow(entries, "shard int, name string, at long, size long")
             .withColumn("order", F.xxhash64(F.lit(seed), F.lit(epoch), "shard", "at")))
    dealt = index.repartitionByRange("order").sortWithinPartitions("order").select("order", "name", "at", "size")
    return dealt.mapInArrow(fetch, "order long, doc_id long, n_tokens long, ids binary")
