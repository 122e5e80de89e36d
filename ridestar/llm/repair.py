"""Conversation structure repair: the cheapest edits that give a conversation the roles ``(s?(ua)+)?``.

Rows of a conversation are taken by turn (nulls first; ties by role, then text). A row's first fault
counts: blank (no character outside ``[\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier in the conversation),
truncated (the last such character is none of ``.!?``). Edits: Keep costs 0, Rerole to user or assistant 2, Delete 3
(required for blank and duplicate rows), Insert of an empty user or assistant row 2; a truncated row that stays adds 1.
A role counts by its first character; an empty role has none and cannot be kept. Nulls in role and text are read as one
space. Rows of a null ``conv_id`` are one conversation. An empty table gives no rows.

Lattice. A node is a number of rows dealt with and the last role put out (none, s, u, a); edits are edges. The
search is a bidirectional Dijkstra: a forward heap from the start and a reverse heap from the ends expand, the cheaper
side first, until no crossing can be as cheap as the best one. All crossings of least cost are finished that way, and the
ASCII-least concatenated audit is taken. Of two audits of one node and cost neither starts the other (the
difference would be inserts, which cost), so the least audit through a crossing is the least prefix and the least suffix.

Scale. Rows are range-partitioned by conversation and turn and cut into blocks of at most ``BLOCK`` rows. A conversation
within one block is solved where it lies. Of any other one, each block is solved from each role before it to each role
after it; the numbers and audits of its blocks are then put together, and each block makes its own part of the
repaired text, so a conversation with a third of all rows is spread over the tasks. Only its audit and its hash, one
value each in the result, are made in order by one task, which reads the blocks one after another.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ridestar.llm.space import written

BLOCK = 512
#: Characters of a role and a text that split ranges of rows with the same turn.
HEAD = 64
WHITE = " \t\n\x0b\f\r"
STOPS = ".!?"
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1

START, S, U, A = range(4)
SYMBOL = {S: "s", U: "u", A: "a"}
PUT = {U: "user", A: "assistant"}
#: What may come after and before each last role, and the last roles a conversation may end with.
AFTER = {START: (S, U), S: (U,), U: (A,), A: (U,)}
BEFORE = {START: (), S: (START,), U: (START, S, A), A: (U,)}
ENDS = (START, A)
LEGAL = {"su", "ua", "au"}

#: Faults of a row.
NONE, BLANK, DUPLICATE, TRUNCATED = "-", "b", "d", "t"


# ------------------------------------------------------------------ the search

def _steps(roles: list[str], faults: list[str]) -> tuple[Callable, Callable]:
    """The edits (node, cost, letter) from a node, and those that lead to one."""
    n = len(roles)
    stays = [f not in (BLANK, DUPLICATE) for f in faults]
    more = [CUT if f == TRUNCATED else 0 for f in faults]

    def ahead(node):
        i, last = node
        for role in AFTER[last]:
            if role in PUT:
                yield (i, role), INSERT, "I"
                if i < n and stays[i]:
                    yield (i + 1, role), REROLE + more[i], "R"
            if i < n and stays[i] and roles[i] == SYMBOL[role]:
                yield (i + 1, role), more[i], "K"
        if i < n:
            yield (i + 1, last), DELETE, "D"

    def behind(node):
        i, last = node
        for before in BEFORE[last]:
            if last in PUT:
                yield (i, before), INSERT, "I"
                if i and stays[i - 1]:
                    yield (i - 1, before), REROLE + more[i - 1], "R"
            if i and stays[i - 1] and roles[i - 1] == SYMBOL[last]:
                yield (i - 1, before), more[i - 1], "K"
        if i:
            yield (i - 1, last), DELETE, "D"

    return ahead, behind


class _Side:
    """One side's heap of (cost, rows dealt with on this side, audit, node) and its settled nodes.

    Edits that cost nothing deal with a row, so at equal cost nodes with fewer rows go first and a node's
    least audit is in the heap when the node comes up.
    """

    def __init__(self, starts: list, steps: Callable, way: int):
        self.steps, self.way = steps, way
        self.heap = [(0, way * i, "", (i, last)) for i, last in starts]
        heapq.heapify(self.heap)
        self.settled: dict = {}

    def least(self) -> float:
        while self.heap and self.heap[0][3] in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self, other: _Side) -> Iterator[tuple[int, str, str]]:
        """Settles the next node; gives (cost, audit, audit) of its crossings to the other side's nodes."""
        cost, _, audit, node = heapq.heappop(self.heap)
        self.settled[node] = cost, audit
        if node in other.settled:
            rest, its = other.settled[node]
            yield (cost + rest, *((audit, its) if self.way > 0 else (its, audit)))
        for to, price, letter in self.steps(node):
            mine = audit + letter if self.way > 0 else letter + audit
            if to in other.settled:
                rest, its = other.settled[to]
                yield (cost + price + rest, *((mine, its) if self.way > 0 else (its, mine)))
            if to not in self.settled:
                heapq.heappush(self.heap, (cost + price, self.way * to[0], mine, to))


def cheapest(roles: list[str], faults: list[str], entry: int = START, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """(cost, audit) from the last role ``entry`` before the rows to one of ``ends`` after them; None if there is no way."""
    forth, back = _steps(roles, faults)
    ahead = _Side([(0, entry)], forth, 1)
    behind = _Side([(len(roles), e) for e in ends], back, -1)
    best, crossings = float("inf"), set()
    while True:
        f, b = ahead.least(), behind.least()
        # a path without a crossing yet costs at least f + b; those equal to the best are finished too
        if f + b > best or f == float("inf") or b == float("inf"):
            break
        side, other = (ahead, behind) if f <= b else (behind, ahead)
        for cost, prefix, suffix in side.settle(other):
            if cost < best:
                best, crossings = cost, set()
            if cost == best:
                crossings.add((prefix, suffix))
    return (best, min(p + s for p, s in crossings)) if crossings else None


def repaired(audit: str, rows: list[tuple[str, str]], entry: int = START) -> list[str]:
    """The rows ``role:text`` that an audit makes of ``rows`` (role, text), after the last role ``entry``."""
    out, at, last = [], 0, entry
    for edit in audit:
        if edit != "D":
            if edit == "K":
                role, text = rows[at]
                last = next(r for r in AFTER[last] if SYMBOL[r] == role[:1])
            else:
                last = next(r for r in AFTER[last] if r in PUT)
                role, text = PUT[last], "" if edit == "I" else rows[at][1]
            out.append(f"{role}:{text}")
        at += edit != "I"
    return out


# ------------------------------------------------------------------ rows of one conversation

def digest(row: tuple[str, str]) -> bytes:
    role, text = (x.encode() for x in row)
    return hashlib.blake2b(len(role).to_bytes(4, "little") + role + text, digest_size=16).digest()


def faults_of(rows: list[tuple[str, str]], seen: set[bytes]) -> list[str]:
    """The first fault of each row; ``seen``: digests of earlier rows, to which these rows' are added."""
    out = []
    for row in rows:
        body, key = row[1].strip(WHITE), digest(row)
        out.append(BLANK if not body else DUPLICATE if key in seen else NONE if body[-1] in STOPS else TRUNCATED)
        seen.add(key)
    return out


@dataclass
class Count:
    """Counts of consecutive rows of a conversation; those of two runs of rows can be added in order."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_role: str | None = None
    last_role: str | None = None

    @staticmethod
    def of(turns: list, roles: list[str], faults: list[str]) -> Count:
        known = [t for t in turns if t is not None]
        return Count(faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
                     sum(a + b not in LEGAL for a, b in zip(roles, roles[1:])), len(set(known)),
                     min(known, default=None), max(known, default=None),
                     roles[0] if roles else None, roles[-1] if roles else None)

    def add(self, more: Count) -> None:
        self.blank += more.blank
        self.duplicate += more.duplicate
        self.truncated += more.truncated
        self.illegal += more.illegal
        if more.first_role is not None:
            self.illegal += self.last_role is not None and self.last_role + more.first_role not in LEGAL
            self.first_role = more.first_role if self.last_role is None else self.first_role
            self.last_role = more.last_role
        if more.first_turn is not None:
            self.turns += more.turns - (self.last_turn == more.first_turn)
            self.first_turn = more.first_turn if self.last_turn is None else self.first_turn
            self.last_turn = more.last_turn

    def result(self) -> dict:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


def sha256(parts: list[str]) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


# ------------------------------------------------------------------ Spark

_LONGS = [(c, "long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
_PLACE = [("part", "int"), ("seq", "long")]
_ROWS = [("turns", "array<long>"), ("roles", "array<string>"), ("texts", "array<string>"), ("digests", "array<binary>")]
_COUNT = ", ".join(f"{c}: {'string' if 'role' in c else 'long'}" for c in Count.__dataclass_fields__)


def _schema(conv: T.DataType, fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv), *[T.StructField(c, T.DataType.fromDDL(k)) for c, k in fields]])


def _mapped(df: DataFrame, schema: T.StructType, each: Callable[[Iterator[dict]], Iterator[dict]], step: int = 64) -> DataFrame:
    """``each`` over the rows of every partition, in their order."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        held = []
        for row in each(r for b in batches for i in range(0, b.num_rows, BLOCK) for r in b.slice(i, BLOCK).to_pylist()):
            held.append(row)
            if len(held) == step:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return df.mapInArrow(run, schema)


def _cut(rows: Iterator[dict], size: int) -> Iterator[dict]:
    """Blocks of a partition's sorted rows. A conversation that is whole here is solved; others give their rows."""
    part, seq = TaskContext.get().partitionId(), 0
    ahead: list[dict] = []   # the last conversation so far: only what follows shows whether it is whole
    whole = False            # the partition's first conversation may have begun in the one before

    def opened(block):
        nonlocal seq
        seq += 1
        there = [(r["role"], r["text"]) for r in block if r["there"]]
        return {"conv_id": block[0]["conv_id"], "part": part, "seq": seq, "turns": [r["turn"] for r in block if r["there"]],
                "roles": [r for r, _ in there], "texts": [t for _, t in there], "digests": [digest(r) for r in there]}

    for row in rows:
        if ahead and row["conv_id"] != ahead[0]["conv_id"]:
            yield _solved(ahead) if whole else opened(ahead)
            ahead, whole = [], True
        elif len(ahead) == size:
            yield opened(ahead)
            ahead, whole = [], False
        ahead.append(row)
    if ahead:
        yield opened(ahead)


def _solved(block: list[dict]) -> dict:
    rows = [(r["role"], r["text"]) for r in block if r["there"]]
    roles, faults = [r[:1] for r, _ in rows], faults_of(rows, set())
    cost, audit = cheapest(roles, faults)
    return {"conv_id": block[0]["conv_id"], **Count.of([r["turn"] for r in block if r["there"]], roles, faults).result(),
            "cost": cost, "audit": audit, "repaired_sha256": sha256(repaired(audit, rows))}


def _tables(blocks: Iterator[dict]) -> Iterator[dict]:
    """Counts of a block, and its cheapest edits from each last role to each (entry * 4 + exit)."""
    for b in blocks:
        rows = list(zip(b["roles"], b["texts"]))
        roles, faults = [r[:1] for r, _ in rows], faults_of(rows, set(b["seen"] or ()))
        found = [cheapest(roles, faults, entry, (end,)) for entry in range(4) for end in range(4)]
        yield {"conv_id": b["conv_id"], "part": b["part"], "seq": b["seq"], "count": vars(Count.of(b["turns"], roles, faults)),
               "costs": [x and x[0] for x in found], "audits": [x and x[1] for x in found]}


def _joined(blocks: Iterator[dict]) -> Iterator[dict]:
    """Blocks of whole conversations in order: a row with the result of each, and one with the audit of each block."""
    for conv, own in groupby(blocks, lambda b: b["conv_id"]):
        total, tables = Count(), []
        now = {START: (0, "")}
        for b in own:
            total.add(Count(**b["count"]))
            ways = {}
            for end in range(4):
                on = [(cost + b["costs"][e * 4 + end], audit + b["audits"][e * 4 + end], e)
                      for e, (cost, audit) in now.items() if b["costs"][e * 4 + end] is not None]
                if on:
                    ways[end] = min(on)
            now = {end: (cost, audit) for end, (cost, audit, _) in ways.items()}
            tables.append((b["part"], b["seq"], b["audits"], {end: e for end, (_, _, e) in ways.items()}))
        cost, audit, last = min((*now[end], end) for end in ENDS if end in now)
        yield {"conv_id": conv, **total.result(), "cost": cost, "audit": audit}
        for part, seq, audits, entries in reversed(tables):
            entry = entries[last]
            yield {"conv_id": conv, "part": part, "seq": seq, "entry": entry, "audit": audits[entry * 4 + last]}
            last = entry


def _texts(blocks: Iterator[dict]) -> Iterator[dict]:
    for b in blocks:
        out = repaired(b["audit"], list(zip(b["roles"], b["texts"])), b["entry"])
        yield {"conv_id": b["conv_id"], "part": b["part"], "seq": b["seq"], "body": "\n".join(out) if out else None}


def _hashed(blocks: Iterator[dict]) -> Iterator[dict]:
    for conv, own in groupby(blocks, lambda b: b["conv_id"]):
        whole, begun = hashlib.sha256(), False
        for b in own:
            if b["body"] is not None:
                whole.update((("\n" if begun else "") + b["body"]).encode())
                begun = True
        yield {"conv_id": conv, "repaired_sha256": whole.hexdigest()}


def _in_order(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")


def repair_conversations(rows: DataFrame, there: Column | None = None, block: int = BLOCK) -> DataFrame:
    """One row per ``conv_id`` of ``rows`` (conv_id, turn, role, text): gaps, faults, the cheapest edits and the repaired text.

    ``there``: rows for which it is false only name their conversation. Columns: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.
    """
    conv = rows.schema["conv_id"].dataType
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
                       (F.lit(True) if there is None else F.coalesce(there, F.lit(False))).alias("there"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    ranges = [*order[:2], F.substring("role", 1, HEAD), F.substring("text", 1, HEAD)]
    result = [*_LONGS, ("audit", "string"), ("repaired_sha256", "string")]
    blocks = written(_mapped(rows.repartitionByRange(*ranges).sortWithinPartitions(*order),
                             _schema(conv, [*result, *_PLACE, *_ROWS]), partial(_cut, size=block)), "conversation-blocks")
    solved = blocks.where("part IS NULL").select("conv_id", *[c for c, _ in result])
    parts = blocks.where("part IS NOT NULL").select("conv_id", *[c for c, _ in [*_PLACE, *_ROWS]])

    # of rows of one role and text in several blocks, those after the first block's are duplicates there
    place = F.struct("part", "seq")
    each = parts.select("conv_id", "part", "seq", F.explode(F.array_distinct("digests")).alias("digest"))
    first = each.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("same")).agg(F.min(place).alias("first"))
    seen = (each.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")))
            .where(place != F.col("first")).groupBy("part", "seq").agg(F.collect_list("digest").alias("seen")))
    tables = _mapped(parts.join(seen, ["part", "seq"], "left"),
                     _schema(conv, [*_PLACE, ("count", f"struct<{_COUNT}>"), ("costs", "array<long>"), ("audits", "array<string>")]), _tables)
    joined = written(_mapped(_in_order(tables), _schema(conv, [*_LONGS, ("audit", "string"), *_PLACE, ("entry", "int")]), _joined),
                     "conversation-audits")
    audits = joined.where("part IS NOT NULL").select("part", "seq", "entry", "audit")
    texts = _mapped(parts.join(audits, ["part", "seq"]), _schema(conv, [*_PLACE, ("body", "string")]), _texts)
    hashes = _mapped(_in_order(texts), _schema(conv, [("repaired_sha256", "string")]), _hashed)
    whole = joined.where("part IS NULL").select("conv_id", *[c for c, _ in result[:-1]])
    hashes = hashes.withColumnRenamed("conv_id", "of")
    return solved.unionByName(whole.join(hashes, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of"))


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Stand-in faults for ``rows``: by crc32(``conv_id:turn``) % 20 a row is dropped (0), loses its text (1) or its stops (2),
    is repeated (3) or becomes the user's (4). Nulls are read as one space. With the column that tells whether a row is there."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    turn = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")) % 20
    body = F.when(turn == 1, F.lit("")).when(turn == 2, F.translate(text["text"], STOPS, "")).otherwise(text["text"])
    copies = F.when(turn == 0, F.array(F.lit(False))).when(turn == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(F.lit(True)))
    out = rows.select("conv_id", "turn", F.when(turn == 4, F.lit("user")).otherwise(text["role"]).alias("role"), body.alias("text"),
                      F.explode(copies).alias("there"))
    return out, F.col("there")
