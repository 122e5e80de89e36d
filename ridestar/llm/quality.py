"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are documents labelled 1 in the training fold; all other documents are unlabelled, and
labels of 0 are never read. With a class prior ``pi`` and a loss l, the risk of a scorer g is

    pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi * E_P[l(-g)])

where U is unlabelled text. When the second term falls below zero the step goes the other
way on that term alone (the non-negative correction). The prior is estimated from the
same data: a plain positive-against-unlabelled scorer is fitted on one half and measured on the other,
and pi is the least ratio of the shares of U and P above a threshold (mean of both halves).

Features are shares of characters and of pairs of character classes, and the shape of words and
lines, all from the text alone. The fit uses at most ``max_rows`` positives and ``max_rows``
unlabelled documents (chosen by a hash of doc_id, so the bound holds at every size); scoring covers
every whole text. A null text counts as empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestar.llm.words import Words, bounds, giving_back, pieces, text_column

MAX_ROWS = 20_000
#: Bytes of texts whose features are made at once: each byte takes some ten numbers of 8 bytes meanwhile.
STEP = 512 << 10
THRESHOLD = 0.7
HELD_OUT = (4, 2)

#: Character classes: lower, upper, digit, blank, line break, stop, other sign, beyond ASCII.
_CLASS = np.full(256, 6, dtype=np.int64)
_CLASS[128:] = 7
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[0x20, 0x09]] = 3
_CLASS[[0x0A, 0x0B, 0x0C, 0x0D]] = 4
_CLASS[[ord(c) for c in ".,;:'"]] = 5
CLASSES = 8
SHAPE = 10
WIDTH = 129 + CLASSES * CLASSES + SHAPE


def features(column: pa.Array) -> np.ndarray:
    """A row per text."""
    w = Words(*bounds(column), False)
    n = w.docs
    size = np.diff(w.offsets)
    doc = np.repeat(np.arange(n), size)
    total = np.maximum(size, 1)[:, None].astype(float)
    chars = np.bincount(doc * 129 + np.minimum(w.data, 128), minlength=n * 129).reshape(n, 129)
    kind = _CLASS[w.data]
    within = doc[1:] == doc[:-1]
    pairs = np.bincount((doc[1:] * 64 + kind[1:] * CLASSES + kind[:-1])[within], minlength=n * 64).reshape(n, 64)
    words = w.counts()
    length = (w.ends - w.starts).astype(float)
    owner = w.doc_of_word()
    each = np.maximum(words, 1).astype(float)
    mean = np.bincount(owner, length, minlength=n) / each
    square = np.bincount(owner, length**2, minlength=n) / each
    long = np.bincount(owner, length > 15, minlength=n) / each
    short = np.bincount(owner, length <= 3, minlength=n) / each
    h = w.hashes()
    distinct = _distinct(owner, h, n) / each
    follows = (owner[1:] == owner[:-1])
    bigrams = h[1:] * np.uint64(0x9E3779B97F4A7C15) + h[:-1]
    distinct2 = _distinct(owner[1:][follows], bigrams[follows], n) / each
    same = np.bincount(owner[1:][follows & (h[1:] == h[:-1])], minlength=n) / each
    lines = np.bincount(doc[w.data == 10], minlength=n) + 1
    shape = np.column_stack([
        np.log1p(words), np.log1p(size), mean / 10, np.sqrt(np.maximum(square - mean**2, 0)) / 10, long, short,
        distinct, distinct2, same, np.log1p(words / lines)])
    return np.hstack([np.sqrt(chars / total), np.sqrt(pairs / total), shape]).astype(np.float32)


def _distinct(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    if len(values) == 0:
        return np.zeros(n)
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    new = np.ones(len(o), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    return np.bincount(o[new], minlength=n).astype(float)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float
    fitted: bool = True

    def margins(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -5, 5) @ self.weights + self.bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margins(x))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


class _Adam:
    def __init__(self, n: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(n), np.zeros(n), 0, rate

    def step(self, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _against(p: np.ndarray, u: np.ndarray, steps: int, rate: float, ridge: float) -> np.ndarray:
    """Weights (bias last) of a plain logistic scorer of P against U."""
    w = np.zeros(p.shape[1])
    adam = _Adam(len(w), rate)
    for _ in range(steps):
        g = (-(p * (1 - _sigmoid(p @ w))[:, None]).mean(0) + (u * _sigmoid(u @ w)[:, None]).mean(0)) / 2
        g[:-1] += ridge * w[:-1]
        w -= adam.step(g)
    return w


def estimate_prior(p: np.ndarray, u: np.ndarray, least_share: float = 0.75) -> float:
    """Share of positives in U: the least of U(S) / P(S) over upper sets S that hold enough of P, by cross-fitting."""
    if min(len(p), len(u)) < 4:
        return 0.5
    ratios = []
    for side in (0, 1):   # fitted on one half, measured on the other
        w = _against(p[side::2], u[side::2], 200, 0.05, 1e-3)
        sp, su = np.sort(p[1 - side::2] @ w), np.sort(u[1 - side::2] @ w)
        at = np.quantile(sp, np.linspace(0.02, 1 - least_share, 24))
        above_p = 1 - np.searchsorted(sp, at, side="left") / len(sp)
        above_u = 1 - np.searchsorted(su, at, side="left") / len(su)
        ratios.append(above_u / np.maximum(above_p, 1e-9))
    return float(np.clip(np.mean(ratios, axis=0).min(), 0.05, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, steps: int = 400,
        rate: float = 0.03) -> Model:
    """Minimises the non-negative risk with the logistic loss."""
    width = positive.shape[1]
    if len(positive) == 0 or len(unlabelled) == 0:
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.5, False)
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(0), np.maximum(both.std(0), 1e-3)

    def ready(x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - mean) / scale, -5, 5), np.ones((len(x), 1))])

    p, u = ready(positive), ready(unlabelled)
    pi = estimate_prior(p, u) if prior is None else prior
    w = np.zeros(width + 1)
    w[-1] = np.log(pi / (1 - pi))
    ridge = 1e-4 + 4.0 / len(p)   # few positives: stay near the prior
    adam = _Adam(len(w), rate)
    for _ in range(steps):
        zp, zu = p @ w, u @ w
        # the logistic loss: l(z) = log(1 + exp(-z)), l'(z) = sigmoid(z) - 1
        negative = np.logaddexp(0, zu).mean() - pi * np.logaddexp(0, zp).mean()
        g_negative = (u * _sigmoid(zu)[:, None]).mean(0) - pi * (p * _sigmoid(zp)[:, None]).mean(0)
        g_positive = pi * (p * (_sigmoid(zp) - 1)[:, None]).mean(0)
        g = g_positive + g_negative if negative >= 0 else -g_negative
        g[:-1] += ridge * w[:-1]
        w -= adam.step(g)
    return Model(mean, scale, w[:-1], float(w[-1]), pi)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT[0]


def held_out(doc_id: Column) -> Column:
    """Of the rows never learnt from (a null id has no label: False)."""
    return F.coalesce(fold(doc_id) == HELD_OUT[1], F.lit(False))


def feature_rows(docs: DataFrame) -> DataFrame:
    """group, x (float32 features as bytes) of (group, text) rows."""

    def compute(batches):
        for batch in batches:
            column, groups = text_column(batch.column(1)), batch.column(0)
            for i, j in pieces(column, STEP):
                x = features(column[i:j])
                yield pa.RecordBatch.from_arrays([groups[i:j], pa.array([r.tobytes() for r in x], pa.binary())],
                                                 names=["part", "x"])

    return docs.select("part", "text").mapInArrow(giving_back(compute), "part int, x binary")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fits on at most ``max_rows`` trusted positives and ``max_rows`` unlabelled rows of ``docs``.

    An id with a label of 1 outside the held-out fold is a positive; no other label is read, so every other row is unlabelled.
    """
    known = (labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .select(F.col("doc_id").alias("id"), F.lit(1).alias("positive")).distinct())
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    sizes = {r["part"]: r["n"] for r in
             rows.select("doc_id").join(known, F.col("doc_id") == F.col("id"), "left")
             .groupBy(F.coalesce("positive", F.lit(2)).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {part: min(1.0, 0.97 * max_rows / max(1, sizes.get(part, 0))) for part in (1, 2)}

    def pick(c: str) -> Column:
        """A number in [0, 1) by hash of an id."""
        return F.xxhash64(F.lit(17), F.col(c)).bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))

    most = max(share.values())   # both sides are thinned before the join
    chosen = (rows.where(pick("doc_id") < most)
              .join(known.where(pick("id") < most), F.col("doc_id") == F.col("id"), "left")
              .withColumn("part", F.coalesce("positive", F.lit(2))))
    x: dict[int, list[np.ndarray]] = {}
    for part in (1, 2):   # a limit, should many rows share one id
        got = feature_rows(chosen.where((F.col("part") == part) & (pick("doc_id") < share[part]))).limit(max_rows).toArrow()
        values = got.column("x").to_pylist()
        x[part] = np.frombuffer(b"".join(values), dtype=np.float32).reshape(len(values), WIDTH).astype(float)
    # an order free of partitions: a fit does not depend on which task ended first
    x = {k: v[np.lexsort(v.T[[0, -9, -10]])] if len(v) else v for k, v in x.items()}
    rng = np.random.default_rng(5)
    x = {k: v[rng.permutation(len(v))] for k, v in x.items()}
    return fit(x[1], x[2])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def compute(batches):
        for batch in batches:
            column = text_column(batch.column(1))
            out = [model.scores(features(column[i:j]).astype(float)) for i, j in pieces(column, STEP)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(out) if out else [], pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(giving_back(compute), f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted (1: score >= THRESHOLD) for every row."""
    return score(docs, train(docs, labels, max_rows)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns as they were.

    Without a positive label outside the held-out fold, or without an unlabelled row, nothing is fitted: every score is
    0.5, which says nothing of a row, and all rows are kept.
    """
    model = train(docs, labels, max_rows)
    if not model.fitted:
        return docs
    at = docs.columns.index("text")

    def choose(batches):
        for batch in batches:
            column = text_column(batch.column(at))
            keep = [model.scores(features(column[i:j]).astype(float)) >= THRESHOLD for i, j in pieces(column, STEP)]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else [], pa.bool_()))

    return docs.mapInArrow(giving_back(choose), docs.schema)
