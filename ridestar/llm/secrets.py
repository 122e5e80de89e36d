"""Secrets in whole texts: fixed patterns, and a battery of randomness tests over every long token.

Base spans come from three patterns (assign, access, hex). The method adds ``random`` spans:

* Tokens are maximal runs of ``[A-Za-z0-9+/_-]`` with the ``=`` that pad them, of ``MIN_TOKEN`` characters
  or more: a ``=`` before another token character ends a name. The parts of a run between ``/`` that are long enough
  are tokens too, each tested by itself; where a whole run is found its parts are not reported. The
  encoding is the smallest alphabet that holds the token: decimal, hexadecimal, one case of letters, base32,
  base36, base62, base64 (separators and padding aside).
* Against prose (null hypothesis), whose symbol shares and rate of change between
  character classes are counted over the whole corpus: a chi-squared statistic (too even
  for prose, by its exact mean and variance under those shares) and a runs statistic (more
  runs of one class than prose has, by a Chernoff bound). Their Bonferroni combination
  is the token's p-value. A token of one class is weighed by its evenness alone, against prose's shares
  within that class: digits, which prose has nearly even, need length or skewed prose to tell.
* Over all tokens of the corpus a Benjamini-Hochberg procedure at rate ``fdr`` weighs
  p-values by token length (long tokens, whose tests have power, get more of the error
  budget; weights average one). It works on a histogram of p-values with fixed bins.
* A discovery must also look random in its own encoding: chi-squared uniformity, runs above
  and below the middle symbol, and lag-1 serial correlation, each at ``alpha`` / 3.

Three passes over the texts; what reaches the driver is two histograms of fixed size.
A null text counts as empty. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestar.llm.words import Words, bounds, pieces, text_column

KINDS = ("assign", "access", "hex", "random")
#: The base patterns.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
HINTS = ("passw", "secret", "token", "api")

MIN_TOKEN = 16
ORDINARY = range(4, MIN_TOKEN)
TOKEN = re.compile(r"[A-Za-z0-9+/_-]++(?:=++(?![A-Za-z0-9+/_-]))?")
PART = re.compile(r"[^/]+")
DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = [
    ("decimal", DIGITS), ("hex", DIGITS + "abcdef"), ("hex", DIGITS + "ABCDEF"), ("upper", UPPER), ("lower", UPPER.lower()),
    ("base32", UPPER + "234567"),
    ("base36", DIGITS + UPPER.lower()), ("base36", DIGITS + UPPER), ("base62", DIGITS + UPPER + UPPER.lower()),
    ("base64", DIGITS + UPPER + UPPER.lower() + "+/"), ("base64", DIGITS + UPPER + UPPER.lower() + "-_"),
    ("base64", DIGITS + UPPER + UPPER.lower() + "+/-_"),
]
_ALPHABETS = [(name, {c: i for i, c in enumerate(a)}, frozenset(a)) for name, a in ALPHABETS]
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[ord(c) for c in DIGITS]] = 1
_CLASS[[ord(c) for c in UPPER]] = 2
_CLASS[[ord(c) for c in UPPER.lower()]] = 3
_CLASS[[ord(c) for c in "+/=_-"]] = 4
SWITCH, PAIRS, TOKENS, TOKEN_CHARS = 256, 257, 258, 259
BIN, BINS = 0.02, 4000   # histogram of log10 p: bin b holds p in (10^-(b+1)*BIN, 10^-b*BIN]


@dataclass(frozen=True)
class Prose:
    """What the corpus says of ordinary words and of the tokens to be tested."""

    square: float
    cube: float
    change: float
    mean_length: float
    within: tuple[tuple[float, float], ...] = ()   # square and cube of the shares within digits, upper, lower

    @staticmethod
    def of(counts: dict[int, int]) -> Prose:
        shares = np.array([counts.get(c, 0) for c in range(256)], dtype=float)
        shares = shares / max(shares.sum(), 1.0)
        change = (counts.get(SWITCH, 0) + 1) / (counts.get(PAIRS, 0) + 20)
        n = counts.get(TOKENS, 0)
        within = []
        for letters in (DIGITS, UPPER, UPPER.lower()):
            x = np.array([counts.get(ord(c), 0) + 1 for c in letters], dtype=float)
            x /= x.sum()
            within.append((float((x**2).sum()), float((x**3).sum())))
        return Prose(float((shares**2).sum()), float((shares**3).sum()), min(change, 0.5),
                     counts.get(TOKEN_CHARS, 0) / n if n else MIN_TOKEN, tuple(within))


def lower_tail(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def prose_p(token: str, prose: Prose) -> float:
    """How likely prose is to look as even and as mixed as ``token``."""
    n = len(token)
    codes = _CLASS[np.frombuffer(token.encode("ascii"), dtype=np.uint8)]
    changes = int(np.count_nonzero(codes[1:] != codes[:-1]))
    same = sum(c * (c - 1) for c in Counter(token).values())
    q, t = prose.square, prose.cube
    if changes == 0:
        if codes[0] == 4:   # signs only
            return 1.0
        if prose.within:
            q, t = prose.within[codes[0] - 1]
    mean = n * (n - 1) * q
    var = 4 * n * (n - 1) * (n - 2) * t + 2 * n * (n - 1) * q - 2 * n * (n - 1) * (2 * n - 3) * q * q
    even = lower_tail((same - mean) / math.sqrt(var)) if var > 0 else 1.0
    rate, usual = changes / (n - 1), prose.change
    mixed = 1.0
    if rate > usual:
        kl = rate * math.log(rate / usual)
        if rate < 1:
            kl += (1 - rate) * math.log((1 - rate) / (1 - usual))
        mixed = math.exp(-(n - 1) * kl)
    return min(1.0, 2 * min(even, mixed))


def encoding(token: str) -> tuple[str, list[int], int] | None:
    """Name, symbol values and size of the smallest alphabet that holds the token."""
    core = token.rstrip("=")
    bare = core.replace("-", "").replace("_", "")
    for text, known in ((core, _ALPHABETS[:3]), (bare, _ALPHABETS[:3]), (core, _ALPHABETS[3:])):
        for name, index, letters in known:
            if text and letters.issuperset(text):
                return name, [index[c] for c in text], len(letters)
    return None


def randomness(token: str) -> tuple[float, float, float]:
    """p-values under uniform randomness: chi-squared, runs about the middle, serial correlation."""
    found = encoding(token)
    if found is None or len(found[1]) < 8:
        return 0.0, 0.0, 0.0
    _, values, k = found
    n = len(values)
    squares = sum(c * c for c in Counter(values).values())
    chi = k * squares / n - n
    z = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    high = [2 * v >= k for v in values]
    runs = sum(a != b for a, b in zip(high, high[1:]))
    p_high = (k // 2) / k
    p_run = 2 * p_high * (1 - p_high)
    z_runs = (runs - (n - 1) * p_run) / math.sqrt((n - 1) * p_run * (1 - p_run))
    middle = (k - 1) / 2
    serial = sum((a - middle) * (b - middle) for a, b in zip(values, values[1:]))
    z_serial = serial / (((k * k - 1) / 12) * math.sqrt(n - 1))
    return two_sided(z), two_sided(z_runs), two_sided(z_serial)


def looks_random(token: str, alpha: float) -> bool:
    return min(randomness(token)) >= alpha / 3


def weight(token: str, prose: Prose) -> float:
    return len(token) / prose.mean_length


def p_bin(token: str, prose: Prose) -> int:
    """Histogram bin of the weighted p-value."""
    p = prose_p(token, prose)
    if p >= 1.0:
        return 0   # weights must not lift a p-value of one
    p = min(1.0, p / weight(token, prose))
    return min(BINS - 1, int(-math.log10(max(p, 1e-300)) / BIN))


def threshold(histogram: dict[int, int], fdr: float) -> int:
    """The least bin all of whose p-values are discoveries (BINS: none), by Benjamini-Hochberg.

    A bin's p-values are taken as its largest, so binning never adds discoveries.
    """
    total = sum(histogram.values())
    seen, least = 0, BINS
    for b in sorted(histogram, reverse=True):
        seen += histogram[b]
        if 10 ** (-b * BIN) <= fdr * seen / total:
            least = b
    return max(least, 1)


class Scan:
    """Long words of a run of documents, and code-point offsets."""

    def __init__(self, column: pa.Array):
        self.column = column
        self.words = w = Words(*bounds(column), False)
        long = np.flatnonzero(w.ends - w.starts >= MIN_TOKEN)
        self.doc = np.searchsorted(w.first, long, side="right") - 1
        self.start, self.end = w.starts[long], w.ends[long]
        before = np.zeros(len(w.data) + 1, dtype=np.int64)
        np.cumsum((w.data & 0xC0) != 0x80, out=before[1:])
        self.place = before[self.start] - before[w.offsets[self.doc]]

    def long_words(self) -> Iterator[tuple[int, int, str]]:
        """(document, code point of the first character, word) of words of MIN_TOKEN bytes or more."""
        data = self.words.data
        for d, at, s, e in zip(self.doc.tolist(), self.place.tolist(), self.start.tolist(), self.end.tolist()):
            yield d, at, data[s:e].tobytes().decode("utf-8", "replace")


def tokens_of(word: str) -> Iterator[list[tuple[int, str]]]:
    """(offset, token) of each run of a long word: the run itself, then its parts between slashes."""
    for m in TOKEN.finditer(word):
        run, at = m[0], m.start()
        if len(run) >= MIN_TOKEN:
            parts = [(at + x.start(), x[0]) for x in PART.finditer(run) if MIN_TOKEN <= len(x[0]) < len(run)] if "/" in run else []
            yield [(at, run), *parts]


def assigned(text: str) -> list[tuple[int, int, int]]:
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    return [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]


def fixed_spans(at: int, word: str) -> list[tuple[int, int, int]]:
    """access and hex spans of one long word: (start, kind, end)."""
    out = []
    if "AKIA" in word:
        out += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(word) if m.end() - m.start() >= ACCESS_MIN]
    if len(word) >= HEX_MIN:
        out += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(word) if m.end() - m.start() >= HEX_MIN]
    return out


def prose_counts(docs: DataFrame) -> dict[int, int]:
    """Symbol, class-change and token counts over all texts (at most 260 numbers)."""

    def count(batches):
        total = np.zeros(260, dtype=np.int64)
        for batch in batches:
            column = text_column(batch.column(0))
            for i, j in pieces(column):
                scan = Scan(column[i:j])
                w = scan.words
                size = w.ends - w.starts
                use = (size >= ORDINARY.start) & (size < ORDINARY.stop)
                edge = np.zeros(len(w.data) + 1, dtype=np.int8)
                edge[w.starts[use]] += 1
                edge[w.ends[use]] -= 1
                inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
                kind = _CLASS[w.data]
                known = inside & (kind > 0)
                total[:256] += np.bincount(w.data[known], minlength=256)
                pair = known[1:] & known[:-1]
                pair[w.starts[use & (w.starts > 0)] - 1] = False   # pairs lie within one word
                total[PAIRS] += int(np.count_nonzero(pair))
                total[SWITCH] += int(np.count_nonzero(pair & (kind[1:] != kind[:-1])))
                for _, _, word in scan.long_words():
                    for tokens in tokens_of(word):
                        total[TOKENS] += len(tokens)
                        total[TOKEN_CHARS] += sum(len(t) for _, t in tokens)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"k": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    rows = docs.select("text").mapInArrow(count, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    return {r["k"]: r["n"] for r in rows}


def p_histogram(docs: DataFrame, prose: Prose) -> dict[int, int]:
    """Weighted p-values of all tokens by bin (at most BINS numbers)."""

    def count(batches):
        total: Counter[int] = Counter()
        for batch in batches:
            column = text_column(batch.column(0))
            for i, j in pieces(column):
                for _, _, word in Scan(column[i:j]).long_words():
                    for tokens in tokens_of(word):
                        total.update(p_bin(t, prose) for _, t in tokens)
        yield pa.RecordBatch.from_pydict({"b": pa.array(list(total), pa.int32()),
                                          "n": pa.array(list(total.values()), pa.int64())})

    rows = docs.select("text").mapInArrow(count, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).collect()
    return {r["b"]: r["n"] for r in rows}


class Taken:
    """The places of a text that spans (start, kind, end) hold already, and the end of what was added since, in order."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        found = sorted((a, b) for a, _, b in spans)
        self.starts = [a for a, _ in found]
        self.ends = list(accumulate((b for _, b in found), max))
        self.end = -1

    def touches(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)   # spans that begin before the end
        return start < self.end or (before > 0 and start < self.ends[before - 1])


def secret_spans(docs: DataFrame, fdr: float = 0.01, alpha: float = 0.001) -> DataFrame:
    """Per row of ``docs``: doc_id and ``spans``, an array of (kind, start, end) by start, then kind as listed."""
    prose = Prose.of(prose_counts(docs))
    least = threshold(p_histogram(docs, prose), fdr)
    kind_type = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def find(batches):
        for batch in batches:
            column, out = text_column(batch.column(1)), []
            for i, j in pieces(column):
                part = column[i:j]
                spans = [assigned(t) for t in part.to_pylist()]
                random: list[list[tuple[int, int, int]]] = []
                for d, at, word in Scan(part).long_words():
                    spans[d] += fixed_spans(at, word)
                    random += [[(d, at + s, at + s + len(t)) for s, t in tokens
                                if p_bin(t, prose) >= least and looks_random(t, alpha)] for tokens in tokens_of(word)]
                # a token that a base span touches is found already, as are the parts of a run that is found
                taken = [Taken(x) for x in spans]
                for run in random:
                    for d, s, e in run:
                        if not taken[d].touches(s, e):
                            spans[d].append((s, 3, e))
                            taken[d].end = e
                out += [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(x)] for x in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        find, f"doc_id {kind_type}, spans array<struct<kind: string, start: long, end: long>>")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def digest_columns(found: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, their digest, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), count("random"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
