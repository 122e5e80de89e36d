"""Cutting a text into units whose tokens do not depend on their neighbours.

With the byte-level pattern a space between two non-space characters always starts a
new pre-token, and a line feed between two non-space characters is one by itself. So a
text without two white-space characters in a row can be cut before each such space or
line feed, and the tokens of the text are those of its units in order. Units repeat, so
a task encodes each of them once and keeps the ids in a bounded table. Texts with
white-space runs are one unit.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from itertools import islice

_RUN = re.compile(r"\s\s")
#: Units kept per worker (about 200 bytes each); of a full table the older half stays, as common units come early.
KEPT_UNITS = 1 << 19
KEPT_UNIT_CHARS = 256


def units(text: str) -> list[str]:
    """``text`` cut into units; joined by nothing they give the text back."""
    if _RUN.search(text) is not None:
        return [text]
    parts = text.replace("\n", " \n").split(" ")
    return [parts[0], *[p if p[:1] == "\n" else " " + p for p in parts[1:]]]


def older_half(known: dict[str, bytes], limit: int) -> dict[str, bytes]:
    """The first ``limit // 2`` entries made."""
    return dict(islice(known.items(), limit // 2))


class UnitTable:
    """ids (little-endian unsigned 32-bit) of units seen lately, filled by ``encode_many``."""

    def __init__(self, encode_many: Callable[[list[str]], Iterable[bytes]], limit: int = KEPT_UNITS):
        self.encode_many, self.limit = encode_many, limit
        self.ids: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        cut = [units(t) for t in texts]
        wanted: set[str] = set()
        for c in cut:
            wanted.update(c)
        known = self.ids
        new = list(wanted.difference(known))
        if len(known) + len(new) > self.limit:
            self.ids = known = older_half(known, self.limit)
            new = [u for u in wanted if u not in known]
        known.update(zip(new, self.encode_many(new)))
        out = [b"".join([known[u] for u in c]) for c in cut]
        for u in new:
            if len(u) > KEPT_UNIT_CHARS:
                del known[u]
        return out
