"""Words of whole texts as numpy arrays: boundaries, 64-bit hashes and k-word windows.

A word is a longest run of bytes outside ``[\\x20\\x09-\\x0D]``; words never
cross a document. All work is vectorised over the Arrow buffer of a batch, with
temporaries bounded by ``PIECE`` bytes, so one very long text needs no more
memory per byte than many short ones.

Hashes are polynomial in a random odd base over a random byte table, finished by
a mixer: equal words have equal hashes, different words collide with a
probability near 2^-60. Where an operator needs more it takes two lanes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
PIECE = 1 << 20
BATCH_BYTES = 4 << 20

_rng = np.random.Generator(np.random.PCG64(20240517))
_TABLE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * U64(2) + U64(1)
LANES = _rng.integers(1, 2**63, size=(4, 64), dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled:filled + step] = out[:step] * U64(pow(base, filled, 1 << 64))
        filled += step
    return out


_POW: np.ndarray | None = None
_INV: np.ndarray | None = None


def _tables() -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if _POW is None:
        _POW = _powers(_BASE, PIECE + 1)
        _INV = _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)
    return _POW, _INV


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class Words:
    """The words of a run of documents.

    ``data``: bytes (folded if asked); ``offsets``: document bounds in ``data``;
    ``starts``/``ends``: word bounds in ``data``; ``first``: index of each document's
    first word, with the number of words at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: bool):
        if fold:
            data = _FOLD[data]
        self.data, self.offsets = data, offsets
        inside = ~_SPACE[data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        close = inside.copy()
        close[:-1] &= ~inside[1:]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        begin[heads] = inside[heads]
        tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        close[tails] = inside[tails]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(close) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def docs(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), self.counts())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word."""
        power, inverse = _tables()
        out = np.empty(len(self.starts), dtype=np.uint64)
        i, n = 0, len(self.starts)
        while i < n:
            base = self.starts[i]
            j = int(np.searchsorted(self.ends, base + PIECE, side="right"))
            if j == i:   # one word longer than a piece: hash it piece by piece
                word = self.data[base:self.ends[i]]
                h = U64(len(word))
                for k in range(0, len(word), PIECE):
                    part = word[k:k + PIECE]
                    h = mix(np.array([h], dtype=np.uint64))[0] + (_TABLE[part] * power[:len(part)]).sum(dtype=np.uint64)
                out[i] = h
                i += 1
                continue
            part = self.data[base:self.ends[j - 1]]
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_TABLE[part] * power[:len(part)], out=sums[1:])
            s, e = self.starts[i:j] - base, self.ends[i:j] - base
            out[i:j] = (sums[e] - sums[s]) * inverse[s]
            i = j
        return mix(out)


def give_back() -> None:
    """Hands memory that this process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # only where the C library has it
    if trim is not None:
        trim(0)


def giving_back(work: Callable[[Iterable[pa.RecordBatch]], Iterable[pa.RecordBatch]]):
    """``work`` as it is; at a task's end its Python worker, which stays for later tasks, gives back what the task had freed."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def text_column(column) -> pa.Array:
    """An Arrow string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column.cast(pa.large_string()), "")


def bounds(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and offsets of a ``large_string`` array without nulls."""
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buf = column.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, dtype=np.uint8)
    if len(off) == 0:
        off = np.zeros(1, dtype=np.int64)
    return data[off[0]:off[-1]], off - off[0]


def pieces(column, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes (or one longer row)."""
    column = text_column(column)
    _, off = bounds(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def words_of(column, fold: bool = False) -> Words:
    return Words(*bounds(text_column(column)), fold)


def windows(hashes: np.ndarray, first: np.ndarray, k: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows and the index of each window's first word, documents in order.

    ``first`` are the documents' bounds in ``hashes``; a window lies within one document.
    """
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    sums = hashes[:n] * LANES[lane, 0]
    for i in range(1, k):
        sums += hashes[i:i + n] * LANES[lane, i]
    at = np.arange(n)
    last = np.repeat(first[1:], np.diff(first))[:n]
    keep = at + k <= last
    return mix(sums[keep] + U64(k)), at[keep]
