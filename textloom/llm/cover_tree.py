"""Exact top-k inner products by dual cover trees.

The upper levels of a cover tree, of a bounded sample, deal all vectors to balls. A query is sent only to balls that can
hold one of its k highest scores: its kth score in the sample bounds these from below. In each pair of a ball's piece and
a block of near queries both are indexed by a cover tree of their own, and a pair of nodes is passed over when no inner
product between their balls can reach the worst kth score of the query node.
"""

import heapq
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ._store import stage
from ._vectors import matrix, top, valid
from ._words import mix

#: Vectors of a piece and queries of a block on average; points of a leaf at most, unless they are equal.
BLOCK, QUERY_BLOCK, LEAF, QUERY_LEAF = 8192, 4096, 512, 128
#: Vectors that the upper levels are made of and that bound scores, at most; of these in a ball, at least.
SAMPLE, BALL = 8192, 16
#: By which the scale falls from one level of a tree to the next, where so many children of a node at most can cover it at that scale.
BASE, CHILDREN = 1.3, 32
#: A length that the sample lacks has no more than so many times the rows that a sampled row stands for, but with a chance of exp(-RARE).
RARE = 16


class Node:
    __slots__ = ("center", "norm", "radius", "points", "children")

    def __init__(self, center, radius, points, children):
        self.center, self.radius, self.points, self.children = center, radius, points, children
        self.norm = float(np.sqrt(center @ center))


def build(x: np.ndarray, leaf: int, points: np.ndarray | None = None, squares: np.ndarray | None = None) -> Node:
    """The cover tree of rows of x: a node's children are the balls around points that lie apart by the level's scale, at least, and cover the node's points within it.

    A child's point is the farthest from those before, until they cover the node at 1 / BASE of its radius, are
    CHILDREN, or twice as many as leaves could hold the points. Every node that isn't a leaf has two children or more, and every leaf few points or equal ones.
    """
    points = np.arange(len(x)) if points is None else points
    squares = (x * x).sum(1) if squares is None else squares
    own, size = x[points], squares[points]

    def distances(center):
        # a little more than by rounding, as bounds must hold
        return np.sqrt(np.maximum(size + size[center] - 2 * (own @ own[center]), 0) + 1e-12 * (size + size[center]))

    first = int(np.argmin(size - 2 * (own @ own.mean(0))))
    near = distances(first)
    radius = float(near.max())
    if len(points) <= leaf or not np.ptp(own, axis=0).any():
        return Node(own[first], radius, points, [])
    child, near[first], count = np.zeros(len(points), np.int64), 0.0, 1
    most = min(CHILDREN, ceil(2 * len(points) / leaf))
    while count < 2 or (near.max() > radius / BASE and count < most):
        new = int(np.argmax(near))
        d = distances(new)
        d[new] = 0.0
        closer = d < near
        closer[new] = True
        child[closer], near[closer] = count, d[closer]
        count += 1
    return Node(own[first], radius, points, [build(x, leaf, points[child == i], squares) for i in range(count)])


def leaves(node: Node) -> list[Node]:
    """From left to right, so that what lies near in space does so in the list."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        out += [] if x.children else [x]
        todo += reversed(x.children)
    return out


def reach(product, radius, norm):
    """The most that an inner product with a point of a ball can be; a little more than by rounding. product: with its center; norm: of the other vector."""
    bound = product + radius * norm
    return bound + 1e-9 * (np.abs(product) + radius * norm + 1)


def search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int, low: np.ndarray | None = None, stats: dict | None = None):
    """(scores, ids): for each query its k highest inner products with data of another id, ties to the smaller id; -inf and -1 where there are fewer.

    low: scores below these aren't wanted. stats: gets the number of pairs compared.
    """
    scores, ids = np.full((len(queries), k), -np.inf), np.full((len(queries), k), -1, np.int64)
    if not len(queries) or not len(data):
        return scores, ids
    least = np.full(len(queries), -np.inf) if low is None else low.astype(float)
    norms = np.sqrt((queries * queries).sum(1))
    stats = {} if stats is None else stats

    def bound(q: Node, d: Node) -> float:
        return float(reach(q.center @ d.center + q.radius * d.norm, d.radius, q.norm + q.radius))

    def worst(q: Node) -> float:
        return float(least[q.points].min())

    def compare(q: Node, d: Node) -> None:
        # of the leaf's queries those that can reach the ball
        asking = q.points[reach(queries[q.points] @ d.center, d.radius, norms[q.points]) >= least[q.points]]
        stats["pairs"] = stats.get("pairs", 0) + len(asking) * len(d.points)
        new = queries[asking] @ data[d.points].T
        new[query_ids[asking][:, None] == data_ids[d.points]] = -np.inf
        low = least[asking]
        if len(d.points) > k and np.isneginf(low).any():
            low = np.maximum(low, np.partition(new, len(d.points) - k, 1)[:, len(d.points) - k])
        row, column = np.nonzero((new >= low[:, None]) & (new > -np.inf))
        if not len(row):
            return
        # those found, beside the k of their queries: the best k of each query
        asked, own = np.unique(row, return_inverse=True)
        some = asking[asked]
        both = np.concatenate([scores[some].ravel(), new[row, column]])
        named = np.concatenate([ids[some].ravel(), data_ids[d.points[column]]])
        of = np.concatenate([np.repeat(np.arange(len(some)), k), own])
        order = np.lexsort((named, -both, of))
        size = k + np.bincount(own)
        order = order[((np.cumsum(size) - size)[:, None] + np.arange(k)).ravel()]
        scores[some], ids[some] = both[order].reshape(-1, k), named[order].reshape(-1, k)
        least[some] = np.maximum(least[some], scores[some, -1])

    def dual(q: Node, pending: list) -> None:
        """pending: data nodes that the ancestors of q have not passed over."""
        lowest = worst(q)
        pending = [d for d in pending if bound(q, d) >= lowest]
        if q.children:
            # data nodes wider than the query node are opened here, once for all of its children
            opened = []
            for d in pending:
                opened += d.children if d.children and d.radius > q.radius else [d]
            for child in q.children:
                dual(child, opened)
            return
        heap = [(-bound(q, d), i, d) for i, d in enumerate(pending)]
        heapq.heapify(heap)
        count = len(heap)
        while heap:
            b, _, d = heapq.heappop(heap)
            if -b < worst(q):
                break
            if d.children:
                for child in d.children:
                    count += 1
                    heapq.heappush(heap, (-bound(q, child), count, child))
            else:
                compare(q, d)

    dual(build(queries, QUERY_LEAF), [build(data, LEAF)])
    return scores, ids


def quantised(scale: int = 64):
    """floor(scale * x) of a component."""
    return lambda x: F.floor(x * scale).cast("double")


def _by_dim(batch, dims: pa.Array):
    """(length, row numbers, matrix) of a batch's vectors, which are its second column."""
    dims = dims.to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, pa.array(at), matrix(batch.column(1).take(pa.array(at)))


class _Upper:
    """Balls that the sampled vectors of one length are dealt to, in the order of a tree, and these vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, ball: int):
        self.ids, self.x = ids, x
        self.centers = np.array([n.center for n in leaves(build(x, ball))])

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ball of each row, and its distance from the center."""
        half = (self.centers**2).sum(1) / 2
        at = np.concatenate([np.argmax(x[i : i + 2048] @ self.centers.T - half, 1) for i in range(0, len(x), 2048)])
        return at, np.sqrt(((x - self.centers[at]) ** 2).sum(1)) * (1 + 1e-12)

    def bounds(self, ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
        """Each row's kth score among the sampled vectors of other ids."""
        if len(self.ids) <= k:
            return np.full(len(ids), -np.inf)
        out = []
        for i in range(0, len(x), 512):
            products = x[i : i + 512] @ self.x.T
            products[ids[i : i + 512, None] == self.ids] = -np.inf
            out.append(np.partition(products, len(self.ids) - k, 1)[:, len(self.ids) - k])
        low = np.concatenate(out)
        return low - 1e-9 * (np.abs(np.where(np.isneginf(low), 0, low)) + 1)


def top_k(vectors, k: int = 20, every: int = 20, value=None, block: int = BLOCK, query_block: int = QUERY_BLOCK, sample: int = SAMPLE):
    """(query_id, rank, vec_id, score): for each vec_id divisible by every, its k highest inner products with all other vectors, exactly.

    value: of a component, instead of itself (see quantised()); scores are exact while sums stay below 2 ** 53. Which
    vectors take part: see valid(). Vectors are compared with those of their own length. Ties go to the smaller
    vec_id; a query with fewer than k others has them all, and none at all if it is alone.

    A ball of many vectors, equal ones too, is searched in pieces. A piece is sent once for each block of queries that
    it is not out of reach for: where vectors fill space evenly, that is all of them.
    """
    spark = vectors.sparkSession
    rows = stage(valid(vectors, value).select("vec_id", "v", F.size("v").alias("dim")), "cover-vectors", spark)
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n, asked = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    by: dict[int, list] = {}
    for r in drawn:
        by.setdefault(r.dim, []).append(r)
    ball = max(BALL, block * len(drawn) // max(1, n))
    upper = spark.sparkContext.broadcast({dim: _Upper(np.array([r.vec_id for r in some]), np.array([r.v for r in some], float), ball) for dim, some in by.items()})  # of the sample's size

    def placed(batches):
        for batch in batches:
            for dim, at, x in _by_dim(batch, batch.column(2)):
                d, far = upper.value[dim].place(x) if dim in upper.value else (np.full(len(x), -1), np.zeros(len(x)))
                yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns), pa.array(d.astype(np.int32)), pa.array(far)], ["vec_id", "v", "dim", "d", "far"])

    dealt = stage(rows.mapInArrow(placed, "vec_id bigint, v array<double>, dim int, d int, far double"), "cover-dealt", spark)
    # a row for each ball, fewer than the sample has
    balls = dealt.where("d >= 0").groupBy("dim", "d").agg(F.count("*").alias("n"), F.max("far").alias("radius"), F.count(F.when(is_query, 1)).alias("asked")).orderBy("dim", "d").collect()
    known, before = {}, 0
    for r in balls:
        known.setdefault(r.dim, []).append((r.d, ceil(r.n / block), r.radius, before, r.asked))
        before += r.asked
    known = spark.sparkContext.broadcast({dim: [np.array(c) for c in zip(*some)] for dim, some in known.items()})
    rest, query_blocks = max(1, ceil(RARE * n / sample / block)), max(1, ceil(asked / query_block))

    def visits(batches):
        for batch in batches:
            for dim, at, x in _by_dim(batch, batch.column(2)):
                ids, own = batch.column(0).take(at).to_numpy(), batch.column(3).take(at).to_numpy()
                if dim in known.value:
                    d, pieces, radius, first, times = known.value[dim]
                    low = upper.value[dim].bounds(ids, x, k)
                    visited = reach(x @ upper.value[dim].centers[d].T, radius, np.sqrt((x**2).sum(1))[:, None]) >= low[:, None]
                    of = np.searchsorted(d, own)
                    q = (first[of] + (mix(ids.view(np.uint64)) % times[of].astype(np.uint64)).astype(np.int64)) // query_block
                else:
                    d, pieces, low, visited = np.array([-1]), np.array([rest]), np.full(len(ids), -np.inf), np.ones((len(ids), 1), bool)
                    q = (mix(ids.view(np.uint64)) % np.uint64(query_blocks)).astype(np.int64)
                for i in range(0, len(ids), 256):
                    row, ball_ = np.nonzero(visited[i : i + 256])
                    row = np.repeat(row + i, pieces[ball_])
                    part = np.concatenate([np.arange(p) for p in pieces[ball_]] or [np.zeros(0, np.int64)])
                    of_ball = np.repeat(d[ball_], pieces[ball_])
                    named = [np.full(len(row), dim), of_ball, part, q[row]]
                    whole = at.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in named), batch.column(0).take(whole), batch.column(1).take(whole), pa.array(low[row])], ["dim", "d", "piece", "q", "vec_id", "v", "low"])

    key = ["dim", "d", "piece", "q"]
    sent = stage(dealt.where(is_query).mapInArrow(visits, "dim int, d int, piece int, q int, vec_id bigint, v array<double>, low double"), "cover-visits", spark)
    counts = spark.createDataFrame([(r.dim, r.d, ceil(r.n / block)) for r in balls], "dim int, d int, pieces int")
    data = dealt.join(F.broadcast(counts), ["dim", "d"], "left")  # broadcast: a row for each ball
    data = data.withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.coalesce("pieces", F.lit(rest))).cast("int"))
    # merge: else a few tasks would be broadcast, and a larger input would be another plan
    tasks = sent.select(*[F.col(c).alias(c) for c in key]).distinct()
    data = data.join(tasks.hint("merge"), ["dim", "d", "piece"]).select(*key, "vec_id", "v")

    def run(left, right):
        a, b = matrix(left["v"]), matrix(right["v"])
        ids = left["vec_id"].to_numpy()
        scores, found = search(a, ids, b, right["vec_id"].to_numpy(), k, left["low"].to_numpy())
        keep = found.ravel() >= 0 if not len(found) else ~np.isneginf(scores.ravel())
        return pa.table({"query_id": np.repeat(ids, k)[keep], "vec_id": found.ravel()[keep], "score": scores.ravel()[keep]})

    found = sent.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(run, "query_id bigint, vec_id bigint, score double")
    return top(found, k)
