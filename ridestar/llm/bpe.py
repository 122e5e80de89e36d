"""Byte-pair encoding and decoding of whole texts.

A symbol list is doubly linked; a priority queue holds (merge rank, position) of
adjacent pairs. Popping the least rank merges the pair in place and queues the two new
neighbour pairs; entries whose symbols have changed since are stale and skipped. Ties in
rank go to the leftmost pair. Decoding concatenates vocabulary strings.

The vocabulary file (a parameter) is a byte-level BPE in the tokenizers library's JSON
form; it is read once per worker. Added tokens are matched first, leftmost and longest.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from ridestar.llm.split import KEPT_UNITS, UnitTable, older_half
from ridestar.llm.words import giving_back, pieces, text_column

#: Fixed value: the byte-level pattern that splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(self.letters)}
        self.byte_ids = [vocab[c] for c in self.letters]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank << 32 for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(byte_of[c] for c in token)
        for token, i in self.added.items():
            self.strings[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self.pattern = regex.compile(PATTERN)
        longest = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.words: dict[str, bytes] = {}
        self.table = UnitTable(self.encode_units)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token."""
        ids = [self.byte_ids[b] for b in word]
        n = len(ids)
        if n < 2:
            return ids
        rank_of = self.ranks.get
        # an entry is rank << 32 | place: least rank first, then leftmost
        queue = [r | i for i, pair in enumerate(zip(ids, ids[1:])) if (r := rank_of(pair)) is not None]
        if len(queue) == 0:
            return ids
        heapq.heapify(queue)
        pop, push, merged = heapq.heappop, heapq.heappush, self.merged
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        while queue:
            entry = pop(queue)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if j < 0:
                continue
            pair = ids[i], ids[j]
            rank = entry ^ i
            if rank_of(pair) != rank:
                continue   # stale: one of the two has merged since
            ids[i] = new = merged[rank >> 32]
            ids[j] = -1
            after[i] = k = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                r = rank_of((new, ids[k]))
                if r is not None:
                    push(queue, r | i)
            h = before[i]
            if h >= 0:
                r = rank_of((ids[h], new))
                if r is not None:
                    push(queue, r | h)
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            ids = self.merge(word.encode("utf-8", "surrogatepass"))
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(word) <= 64:
                if len(self.words) >= KEPT_UNITS:
                    self.words = older_half(self.words, KEPT_UNITS)
                self.words[word] = found
        return found

    def encode_units(self, texts: list[str]) -> Iterator[bytes]:
        word, find, special, added = self._word, self.pattern.findall, self.special, self.added
        for text in texts:
            if special is None or special.search(text) is None:
                yield b"".join([word(w) for w in find(text)])
                continue
            out = []
            for k, part in enumerate(special.split(text)):
                out += [struct.pack("<I", added[part])] if k % 2 else [word(w) for w in find(part)]
            yield b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """ids of each text as little-endian unsigned 32-bit integers."""
        return self.table.encode(texts)

    def decode(self, ids: list[int]) -> str:
        """Text of ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join([self.strings[i] for i in ids]).decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """One encoder per worker and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encode_column(docs: DataFrame, path: str, column: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with a binary column ``into`` added: ids as little-endian unsigned 32-bit (null text: no ids).

    A column of that name already there is an error.
    """
    if into.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"docs already has a column {into}")

    def encode(batches):
        bpe = loaded(path)
        for batch in batches:
            texts = text_column(batch.column(batch.schema.get_field_index(column)))
            out: list[bytes] = []
            for i, j in pieces(texts):
                out += bpe.encode(texts[i:j].to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, into])

    return docs.mapInArrow(giving_back(encode), StructType([*docs.schema.fields, StructField(into, BinaryType())]))


def token_digests(docs: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """Per document: id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (decoded text).

    Encodes each whole text (null: empty), then decodes the ids.
    """
    def digest(batches):
        bpe = loaded(path)
        decimal, strings = bpe.decimal, bpe.strings
        for batch in batches:
            texts = text_column(batch.column(1))
            count, ids_sha, text_sha = [], [], []
            for i, j in pieces(texts):
                for packed in bpe.encode(texts[i:j].to_pylist()):
                    ids = memoryview(packed).cast("I").tolist() if packed else []
                    count.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join([decimal[x] for x in ids]).encode()).hexdigest())
                    back = b"".join([strings[x] for x in ids]).decode("utf-8", "replace")
                    text_sha.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())],
                names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, "text").mapInArrow(
        giving_back(digest), f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
