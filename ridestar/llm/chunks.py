"""Chunks of documents that converse with hash bins.

Texts are staged once as chunks: compressed runs of rows of at most a few MB, each with an id, written
to the shared folder. A chunk deals packed records to bins (rows (chunk, bin, data)), a bin
sees the records of all chunks and answers each of them (rows of the same form, usually aligned with what was
sent), and the answers of all bins are joined back to the chunk. A key that occurs everywhere is
one record per chunk, so bins stay even; a chunk's answers are bounded by its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridestar.llm.space import written
from ridestar.llm.words import BATCH_BYTES, giving_back, pieces, text_column

PIECE = "chunk long, bin int, data binary"


def stage(docs: DataFrame, limit: int = BATCH_BYTES) -> DataFrame:
    """(chunk, body) of rows of ``docs``, whose column ``text`` is made non-null; a chunk has ``limit`` bytes of text at most, or one row."""
    at = docs.columns.index("text")

    def pack(batches):
        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = text_column(batch.column(at))
            columns = [texts if k == at else c for k, c in enumerate(batch.columns)]
            whole = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
            for i, j in pieces(texts, limit):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int64()), pa.array([_body(whole.slice(i, j - i))], pa.binary())], names=["chunk", "body"])
                n += 1

    return written(docs.mapInArrow(giving_back(pack), "chunk long, body binary"), "chunks")


def _body(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def opened(body: pa.Scalar) -> pa.RecordBatch:
    """The rows of a chunk."""
    return pa.ipc.open_stream(body.as_buffer()).read_next_batch()


def records(chunk: int, which: np.ndarray, bins: int, columns: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    """(chunk, bin, data) for each bin: the columns one after another; ``which`` (bins) is sorted."""
    ends = np.searchsorted(which, np.arange(bins + 1))
    for b in np.flatnonzero(np.diff(ends)):
        yield chunk, int(b), b"".join(c[ends[b]:ends[b + 1]].tobytes() for c in columns)


def split(data, kinds: list) -> list[np.ndarray]:
    """The columns of packed records."""
    kinds = [np.dtype(k) for k in kinds]
    n, at, out = data.size // sum(k.itemsize for k in kinds), 0, []
    for k in kinds:
        out.append(np.frombuffer(data, dtype=k, count=n, offset=at))
        at += n * k.itemsize
    return out


def batch_of(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    chunk, which, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(which, pa.int32()), pa.array(data, pa.binary())],
                                      names=["chunk", "bin", "data"])


def by_bin(batches) -> Iterator[tuple[int, list[tuple[int, object]]]]:
    """(bin, [(chunk, data)]) of a task's rows."""
    rows = [(c, b, d.as_buffer()) for x in batches
            for c, b, d in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), x.column(2))]
    for b in sorted({r[1] for r in rows}):
        yield b, [(c, d) for c, of, d in rows if of == b]


def gathered(answers: DataFrame, name: str) -> DataFrame:
    """(``name``_chunk, ``name``): a chunk's answers from all bins, at most one per bin."""
    return (answers.groupBy(F.col("chunk").alias(f"{name}_chunk"))
            .agg(F.collect_list(F.struct("bin", "data")).alias(name)))


def answers(value: pa.Scalar, kind) -> dict[int, np.ndarray]:
    """One chunk's answers by bin."""
    if not value.is_valid:
        return {}
    part = value.values
    return {b: np.frombuffer(d.as_buffer(), dtype=kind) for b, d in zip(part.field("bin").to_pylist(), part.field("data"))}
