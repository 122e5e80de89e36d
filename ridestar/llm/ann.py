"""Nearest neighbours by inner product through balanced posting lists.

Vectors ``x`` become ``(x, sqrt(M^2 - |x|^2))`` with ``M`` the largest norm, and queries ``(q, 0)``: the nearest
in Euclidean distance is then the largest inner product.

* Lists. Centroids are the means of even parts of at most ``SAMPLE`` vectors (chosen by a hash of vec_id), halved
  again and again by balanced 2-means; there is one per ``LIST_ROWS`` rows, at most ``MAX_LISTS``. Every row is indexed. A row near a
  boundary is entered in several lists: those at most ``1 + CLOSURE`` times as far as the nearest, unless a
  list already taken is closer to that centroid than the row is.
* Centroid search. Tasks hold the centroids in a symmetric neighbour graph and search it best
  first from its entry point.
* Pruning. A query reads the lists at most ``ratio`` times as far as the nearest one. The ratio is
  measured: for ``PROBES`` vectors the true neighbours among all rows are found by a block scan, and
  the ratio is the least that reaches a share ``recall`` of them.

Lists longer than ``PART_ROWS`` are split by a hash of vec_id, and a list's queries by a hash of theirs, so a list that
holds a third of all rows, or is asked by a third of all queries, is many units of work. Scores
are recomputed in double precision on the original vectors; ties go to the smaller vec_id.

Vectors that are null, zero, hold null or non-finite components, or have a null vec_id take no part. Vectors of
different lengths have no inner product: each length has an index of its own, and a query is answered from the rows of its
own length. Of rows that share a vec_id each is a candidate of its own vector; a query id given
twice is answered once, for the vector of its least row.
"""

from __future__ import annotations

import heapq
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridestar.llm.space import written

SAMPLE = 20_000
LIST_ROWS = 1024
MAX_LISTS = 4096
PART_ROWS = 2048
PART_QUERIES = 1024
COPIES = 4
CLOSURE = 0.05
DEGREE = 12
PROBES = 64
RECALL = 0.97
SLACK = 1e-9


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v: array of double) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    return (table.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("v").isNotNull()
                   & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
                   & F.exists("v", lambda x: x != 0)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a float64 matrix."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), width)


# ------------------------------------------------------------------ the index on the driver and in tasks

def balanced_centroids(x: np.ndarray, k: int, rounds: int = 6, seed: int = 3) -> np.ndarray:
    """Means of ``k`` even parts: parts are halved by 2-means, cut along the line of the two means where their shares meet."""
    rng = np.random.default_rng(seed)
    out = []
    parts = [(x, k)]
    while parts:
        rows, leaves = parts.pop()
        if leaves == 1:
            out.append(rows.mean(0))
            continue
        few = leaves // 2
        ends = rows[rng.choice(len(rows), 2, replace=False)]
        for _ in range(rounds):
            side = rows @ (ends[1] - ends[0])
            order = np.argsort(side, kind="stable")
            cut = len(rows) * few // leaves
            ends = np.array([rows[order[:cut]].mean(0), rows[order[cut:]].mean(0)])
        parts += [(rows[order[:cut]], few), (rows[order[cut:]], leaves - few)]
    return np.array(out)


class Graph:
    """Centroids and a connected, symmetric neighbour graph over them."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        self.square = (centroids**2).sum(1)
        k = len(centroids)
        near = self.square[None, :] - 2 * centroids @ centroids.T + self.square[:, None]
        np.fill_diagonal(near, np.inf)
        links: list[set[int]] = [set() for _ in range(k)]
        for i in range(k):
            for j in np.argsort(near[i], kind="stable")[:min(DEGREE, k - 1)]:
                links[i].add(int(j))
                links[int(j)].add(i)
        seen = self._reach(links, 0)
        while len(seen) < k:   # join the nearest part that cannot be reached yet
            inside = np.zeros(k, dtype=bool)
            inside[list(seen)] = True
            block = near[np.ix_(inside, ~inside)]
            a, b = np.unravel_index(np.argmin(block), block.shape)
            a, b = int(np.flatnonzero(inside)[a]), int(np.flatnonzero(~inside)[b])
            links[a].add(b)
            links[b].add(a)
            seen |= self._reach(links, b)
        self.links = [np.array(sorted(s), dtype=np.int64) for s in links]
        self.entry = int(np.argmin(((centroids - centroids.mean(0))**2).sum(1)))

    @staticmethod
    def _reach(links: list[set[int]], start: int) -> set[int]:
        seen, stack = {start}, [start]
        while stack:
            for j in links[stack.pop()] - seen:
                seen.add(j)
                stack.append(j)
        return seen

    def search(self, x: np.ndarray, ratio: float, at_least: int) -> tuple[np.ndarray, np.ndarray]:
        """Centroids within ``ratio`` times the least distance (and the ``at_least`` nearest met), nearest first."""
        norm = float(x @ x)

        def distance(at):
            return np.sqrt(np.maximum(self.square[at] - 2 * (self.c[at] @ x) + norm, 0.0))

        seen = np.zeros(len(self.c), dtype=bool)
        seen[self.entry] = True
        d0 = float(distance(np.array([self.entry]))[0])
        queue, met, best = [(d0, self.entry)], [(d0, self.entry)], d0
        worst: list[float] = [-d0]   # the at_least nearest so far, as a heap of negatives
        while queue:
            d, i = heapq.heappop(queue)
            if d > best * ratio * 1.05 + 1e-12 and len(worst) >= at_least and d > -worst[0]:
                break
            new = self.links[i][~seen[self.links[i]]]
            if len(new) == 0:
                continue
            seen[new] = True
            for dj, j in zip(distance(new).tolist(), new.tolist()):
                best = min(best, dj)
                heapq.heappush(queue, (dj, j))
                met.append((dj, j))
                if len(worst) < at_least:
                    heapq.heappush(worst, -dj)
                else:
                    heapq.heappushpop(worst, -dj)
        met.sort()
        keep = [m for k, m in enumerate(met) if m[0] <= best * ratio + 1e-12 or k < at_least]
        return np.array([j for _, j in keep], dtype=np.int64), np.array([d for d, _ in keep])

    def lists_of(self, x: np.ndarray) -> list[int]:
        """The lists that a row goes to: the nearest, and others across a boundary."""
        near, d = self.search(x, 1 + CLOSURE, 1)
        taken: list[int] = []
        for j, dj in zip(near.tolist(), d.tolist()):
            if len(taken) == COPIES:
                break
            if all(np.sqrt(((self.c[j] - self.c[t])**2).sum()) > dj for t in taken):
                taken.append(j)
        return taken


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Rows with the component that makes all norms ``sqrt(top)``."""
    rest = np.sqrt(np.maximum(top - (x**2).sum(1), 0.0))
    return np.hstack([x, rest[:, None]])


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, each summed the same way whatever the other rows are."""
    return np.array([math.fsum(r) for r in (x * q).tolist()])


def best_of(q: np.ndarray, ids: np.ndarray, x: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of (ids, x) to q, without ``own``: ids and exact scores in order."""
    rough = x @ q
    rough[ids == own] = -np.inf
    n = min(k, int(np.count_nonzero(rough > -np.inf)))
    if n == 0:
        return ids[:0], rough[:0]
    cut = np.partition(rough, len(rough) - n)[len(rough) - n]
    at = np.flatnonzero(rough >= cut - SLACK * max(1.0, abs(cut)))
    score = exact_scores(q, x[at])
    order = np.lexsort((ids[at], -score))[:k]
    return ids[at][order], score[order]


# ------------------------------------------------------------------ Spark jobs

def _sample(rows: DataFrame, n: int, most: int, salt: int) -> DataFrame:
    """The ``most`` rows of least hash of vec_id: the same rows however the table is laid out."""
    pick = F.xxhash64(F.lit(salt), "vec_id").bitwiseAND(F.lit((1 << 40) - 1))
    share = min(1.0, 1.5 * (most + 16) / max(1, n))   # hardly ever too few; each task hands on its ``most`` least ones
    return rows.where(pick <= int(share * (1 << 40))).orderBy(pick, "vec_id").limit(most)


def _top(df: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def measured_ratio(rows: DataFrame, graph, probes: np.ndarray, probe_ids: np.ndarray, top: float, width: int, k: int,
                   recall: float) -> float:
    """The least distance ratio whose lists hold a share ``recall`` of the probes' true neighbours among all rows."""

    def scan(batches):
        g: Graph = graph.value
        ds = [np.sqrt(np.maximum(g.square - 2 * (g.c[:, :width] @ p) + p @ p, 0.0)) for p in probes]
        held: list[list[tuple[float, int, float]]] = [[] for _ in probes]
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1), width)
            if not len(ids):
                continue
            for p, (q, own) in enumerate(zip(probes, probe_ids)):
                score = x @ q
                score[ids == own] = -np.inf
                for i in np.argpartition(-score, min(k, len(score)) - 1)[:k]:
                    if score[i] > -np.inf and (len(held[p]) < k or score[i] > held[p][0][0]):
                        lists = g.lists_of(lifted(x[i:i + 1], top)[0])
                        entry = (float(score[i]), -int(ids[i]), float(ds[p][lists].min() / max(ds[p].min(), 1e-12)))
                        (heapq.heappush if len(held[p]) < k else heapq.heappushpop)(held[p], entry)
        out = [(p, -i, s, r) for p, h in enumerate(held) for s, i, r in h]
        columns = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.float64(), pa.float64()))],
                                         names=["probe", "vec_id", "score", "ratio"])

    near = rows.mapInArrow(scan, "probe int, vec_id long, score double, ratio double")
    near = near.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(16)))
    near = _top(_top(near, ["probe", "salt"], k).drop("rank"), ["probe"], k)   # in two steps: a probe is not one task
    ratios = np.sort([r["ratio"] for r in near.select("ratio").collect()])
    return float(ratios[min(len(ratios) - 1, math.ceil(recall * len(ratios)) - 1)]) * (1 + 1e-9) if len(ratios) else 1.0


def build(rows: DataFrame, k: int = 20, recall: float = RECALL, list_rows: int = LIST_ROWS):
    """(graph broadcast, ratio, squared largest norm, width, rows) of an index over ``rows`` (vec_id, v)."""
    spark = rows.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda a, b: a + b * b)
    n, top, width = rows.agg(F.count(F.lit(1)), F.max(square), F.max(F.size("v"))).first()
    if not n:
        return None
    sample = _sample(rows, n, SAMPLE, 1).toArrow().combine_chunks()
    x = matrix(sample.column("v").combine_chunks(), width)[np.argsort(sample.column("vec_id").to_numpy(), kind="stable")]
    lists = int(max(1, min(MAX_LISTS, n // list_rows, len(x) // 8)))
    space = lifted(x, top)
    centroids = balanced_centroids(space, lists) if lists > 1 else space[:1]
    graph = spark.sparkContext.broadcast(Graph(centroids))
    ratio = 1.0
    if lists > 1:
        probes = _sample(rows, n, PROBES, 2).toArrow()
        ratio = measured_ratio(rows, graph, matrix(probes.column("v").combine_chunks(), width),
                               probes.column("vec_id").to_numpy(), top, width, k, recall)
    return graph, ratio, top, width


def _entered(rows: DataFrame, graph, top: float, width: int) -> DataFrame:
    """(list, vec_id, v): each row in each of its lists."""

    def enter(batches):
        g = graph.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = lifted(matrix(batch.column(1), width), top)
            lists = [g.lists_of(r) for r in x]
            at = np.repeat(np.arange(len(lists)), [len(s) for s in lists])
            yield pa.RecordBatch.from_arrays(
                [pa.array([j for s in lists for j in s], pa.int32()), batch.column(0).take(pa.array(at)),
                 batch.column(1).take(pa.array(at))], names=["list", "vec_id", "v"])

    return rows.mapInArrow(enter, "list int, vec_id long, v array<double>")


def _asked(queries: DataFrame, graph, ratio: float, width: int, sizes: np.ndarray, k: int) -> DataFrame:
    """(list, query_id, q): each query with each list that it reads, at least as many as hold k + 1 rows twice over."""

    def ask(batches):
        g = graph.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            q = matrix(batch.column(1), width)
            chosen = []
            for r in np.hstack([q, np.zeros((len(q), 1))]):
                need = 1
                while True:
                    near, _ = g.search(r, ratio, need)
                    if sizes[near].sum() >= 2 * (COPIES * k + 1) or len(near) >= len(g.c):
                        break
                    need = max(2 * need, len(near) + 1)
                chosen.append(near)
            at = np.repeat(np.arange(len(chosen)), [len(s) for s in chosen])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(chosen), pa.int32()), batch.column(0).take(pa.array(at)),
                 batch.column(1).take(pa.array(at))], names=["list", "query_id", "q"])

    return queries.mapInArrow(ask, "list int, query_id long, q array<double>")


def search(table: DataFrame, query_filter, k: int = 20, recall: float = RECALL, list_rows: int = LIST_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for the rows of ``table`` that pass ``query_filter``."""
    rows = written(valid_vectors(table).withColumn("width", F.size("v")), "ann-rows")
    widths = [r["width"] for r in rows.select("width").distinct().orderBy("width").collect()]
    parts = [_search(rows.where(F.col("width") == w).drop("width"), query_filter, k, recall, list_rows) for w in widths]
    return reduce(DataFrame.unionByName, parts) if parts else table.sparkSession.createDataFrame([], ANSWER)


ANSWER = "query_id long, rank int, vec_id long, score double"


def _search(rows: DataFrame, query_filter, k: int, recall: float, list_rows: int) -> DataFrame:
    """``search`` among vectors (vec_id, v) of one length."""
    spark = rows.sparkSession
    graph, ratio, top, width = build(rows, k, recall, list_rows)
    lists = len(graph.value.c)
    postings = written(_entered(rows, graph, top, width), "ann-lists")
    sizes = np.zeros(lists, dtype=np.int64)
    for r in postings.groupBy("list").count().collect():   # one row per list, at most MAX_LISTS
        sizes[r["list"]] = r["count"]
    queries = (rows.where(query_filter).groupBy("vec_id").agg(F.min("v").alias("v")))
    asked = written(_asked(queries, graph, ratio, width, sizes, k), "ann-queries")
    load = np.zeros(lists, dtype=np.int64)
    for r in asked.groupBy("list").count().collect():
        load[r["list"]] = r["count"]
    parts, turns = np.maximum(1, -(-sizes // PART_ROWS)), np.maximum(1, -(-load // PART_QUERIES))
    plan = spark.createDataFrame([(i, int(p), int(t)) for i, (p, t) in enumerate(zip(parts, turns))],
                                 "of int, parts int, turns int")
    unit = ["list", "part", "turn"]

    def deal(df: DataFrame, key: str, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        return (df.join(F.broadcast(plan), F.col("list") == F.col("of"))
                .withColumn(own, F.pmod(F.xxhash64(key), F.col(own_count)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)))
                .drop("of", "parts", "turns"))

    left = deal(postings, "vec_id", "part", "parts", "turn", "turns").select(*unit, "vec_id", "v")
    right = deal(asked, "query_id", "turn", "turns", "part", "parts").select(*unit, "query_id", "q")

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "near": pa.array([], pa.list_(NEAR))})
        ids, x = a.column("vec_id").to_numpy(), matrix(a.column("v").combine_chunks(), width)
        query_ids, q = b.column("query_id").to_numpy(), matrix(b.column("q").combine_chunks(), width)
        out = []
        for own, r in zip(query_ids.tolist(), q):
            near, score = best_of(r, ids, x, own, k)
            out.append([{"vec_id": i, "score": s} for i, s in zip(near.tolist(), score.tolist())])
        return pa.table({"query_id": pa.array(query_ids), "near": pa.array(out, pa.list_(NEAR))})

    def merge(found: pa.Table) -> pa.Table:
        every = found.column("near").combine_chunks().flatten()
        ids, score = every.field("vec_id").to_numpy(), every.field("score").to_numpy()
        order = np.lexsort((ids, -score))
        ids, score = ids[order], score[order]
        new = np.ones(len(ids), dtype=bool)   # a row that is in several lists has the same score in each
        new[1:] = (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
        ids, score = ids[new][:k], score[new][:k]
        return pa.table({"query_id": pa.array(np.full(len(ids), found.column("query_id")[0].as_py(), dtype=np.int64)),
                         "rank": pa.array(np.arange(1, len(ids) + 1), pa.int32()), "vec_id": pa.array(ids, pa.int64()),
                         "score": pa.array(score, pa.float64())})

    # one packed row per query and unit: what is gathered per query stays small
    near = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(
        meet, "query_id long, near array<struct<vec_id: long, score: double>>")
    return near.groupBy("query_id").applyInArrow(merge, ANSWER)


NEAR = pa.struct([("vec_id", pa.int64()), ("score", pa.float64())])
