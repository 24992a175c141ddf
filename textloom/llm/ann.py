"""Approximate nearest neighbours by an inverted file of product-quantised residuals.

Coarse centroids and codebooks are fitted on a bounded sample; every row is indexed. A query visits the lists of its
nearest centroids, where a table of its inner products with the codebooks gives approximate scores from the codes
alone; the best are ranked again by their own vectors.
"""

from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from . import cover_tree
from ._store import stage
from ._vectors import matrix, top, valid

#: Rows to fit on, at most (those of the smallest hash of their vec_id).
SAMPLE = 20_000
#: Rows after these that scales, error and probes are measured on: one to so many of the sample. Rows of the sample to a list, at least.
MEASURED, FITTED = 4, 39
#: Rows of a list on average, lists at most, rows of a piece of a list and queries of a block on average.
LIST, LISTS, PIECE, QUERIES = 512, 16_384, 2_048, 16_384
#: Candidates of a piece are ranked again if they come within so many standard errors of its kth approximate score.
ERRORS = 4.0
#: Sampled rows of the visited lists bound a query's scores from below by their BELOW * kth best: what can't reach it is not passed on. Twice k, so that k are left even if codes hide some.
BOUNDING, BELOW = 8_192, 2
#: A query visits so many lists that in the sample so large a share of true neighbours lies in them; measured on so many queries.
SHARE, ASKED = 0.97, 500
#: Codebooks, and entries of each.
PARTS, CODES = 16, 256


def k_means(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    """k centers of rows of x; an empty one starts again at a random row."""
    k = min(k, len(x))
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, centers)
        count = np.bincount(at, minlength=k)
        sums = np.stack([np.bincount(at, x[:, j], k) for j in range(x.shape[1])], 1)
        centers = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], x[rng.integers(0, len(x), k)])
    return centers


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The nearest center of each row."""
    half = (centers**2).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 2048] @ centers.T - half, 1) for i in range(0, len(x), 2048)] or [np.zeros(0, np.int64)])


@dataclass
class Index:
    """centers, scales: of the lists. cuts: where the parts of a vector end. books: the codebook of each part. error: root mean square of a
    scaled residual's distance from its code. probes: lists that a query visits.

    Residuals are divided by their list's scale, so that a list of nearly equal vectors has codes that tell them apart.
    """

    centers: np.ndarray
    scales: np.ndarray
    cuts: list[int]
    books: list[np.ndarray]
    error: float
    probes: int

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list of each row, and its residual's code in each part."""
        at = nearest(x, self.centers)
        rest = (x - self.centers[at]) / self.scales[at, None]
        return at, np.stack([nearest(rest[:, a:b], book) for a, b, book in zip([0, *self.cuts], self.cuts, self.books)], 1).astype(np.uint8)

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """Inner products of each query's parts with the codebooks."""
        return [q[:, a:b] @ book.T for a, b, book in zip([0, *self.cuts], self.cuts, self.books)]


def probes_for(sample: np.ndarray, centers: np.ndarray, share: float, k: int, rng) -> int:
    """The fewest lists by inner product with their centers that hold so large a share of the k neighbours of sampled queries."""
    some = rng.choice(len(sample), min(ASKED, len(sample)), replace=False)
    products = sample[some] @ sample.T
    products[np.arange(len(some)), some] = -np.inf
    true = np.argsort(-products, 1, kind="stable")[:, : min(k, len(sample) - 1)]
    if not true.size:
        return 1
    order = np.argsort(-(sample[some] @ centers.T), 1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None], 1)
    needed = np.sort(np.take_along_axis(rank, nearest(sample, centers)[true], 1), None)
    return int(needed[min(len(needed) - 1, int(share * len(needed)))]) + 1


def fit(sample: np.ndarray, lists: int, parts: int = PARTS, share: float = SHARE, k: int = 20, seed: int = 0, measured: np.ndarray | None = None) -> Index:
    """Centers and codebooks of the sample; scales, error and probes from other rows, or from the sample if there are none."""
    measured = sample if measured is None else measured
    rng, dim = np.random.default_rng(seed), sample.shape[1]
    centers = k_means(np.unique(sample, axis=0), lists, rng)
    at, seen = nearest(sample, centers), nearest(measured, centers)
    rest, other = sample - centers[at], measured - centers[seen]
    spread, other_spread = (np.sqrt((x**2).sum(1)) for x in (rest, other))
    scales = np.array([np.median(other_spread[seen == i]) if (seen == i).any() else np.median(spread[at == i]) if (at == i).any() else 0.0 for i in range(len(centers))])
    scales = np.where(scales > 1e-12, scales, 1.0)
    rest, other = rest / scales[at, None], other / scales[seen, None]
    cuts = [round(dim * (i + 1) / min(parts, dim)) for i in range(min(parts, dim))]
    books = [k_means(rest[:, a:b], CODES, rng, 8) for a, b in zip([0, *cuts], cuts)]
    left = np.hstack([other[:, a:b] - book[nearest(other[:, a:b], book)] for a, b, book in zip([0, *cuts], cuts, books)])
    return Index(centers, scales, cuts, books, float(np.sqrt((left**2).sum(1).mean())), probes_for(measured, centers, share, k, rng))


def ranked(products: np.ndarray, held: np.ndarray, probes: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of each query by product, and how many of them it visits: probes, or more until they hold so many rows (all, if they never do). held: rows of each list."""
    order = np.argsort(-products, 1, kind="stable")
    enough = (np.cumsum(held[order], 1) < least).sum(1) + 1
    times = np.minimum(np.maximum(enough, probes), order.shape[1])
    return order[:, : times.max(initial=0)], times


def _search(sent, k: int, errors: float):
    """Of a piece of a list and the queries that visit it: each query's k best."""

    def run(key, left, right):
        index = sent.value
        queries, ids, data, data_ids = matrix(left["v"]), left["vec_id"].to_numpy(), matrix(right["v"]), right["vec_id"].to_numpy()
        least, out = left["low"].to_numpy(), []
        if len(ids) and len(data_ids):
            order = np.argsort(data_ids, kind="stable")
            data, data_ids = data[order], data_ids[order]
            codes = np.frombuffer(b"".join(right["code"].to_pylist()), np.uint8).reshape(len(order), -1)[order]
            # an error of this length in a random direction, seen along a query, of two scores that are compared
            margin = errors * np.sqrt(2 / queries.shape[1]) * index.error * np.sqrt((queries**2).sum(1))
            for i in range(0, len(ids), 128):
                q, own = queries[i : i + 128], ids[i : i + 128]
                # within a list its center and scale don't change the order
                rough = np.zeros((len(q), len(data)))
                for part, table in enumerate(index.tables(q)):
                    rough += table[:, codes[:, part]]
                rough[own[:, None] == data_ids] = -np.inf
                kth = np.partition(rough, max(0, len(data) - k), 1)[:, max(0, len(data) - k)]
                for row, (low, v, name, reach) in enumerate(zip(kth - margin[i : i + 128], q, own, least[i : i + 128])):
                    some = np.flatnonzero((rough[row] >= low) & (data_ids != name))
                    score = data[some] @ v
                    some, score = some[score >= reach], score[score >= reach]
                    at = np.lexsort((data_ids[some], -score))[:k]
                    out.append((np.full(len(at), name), data_ids[some[at]], score[at]))
        a, b, c = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": a, "vec_id": b, "score": c})

    return run


def neighbours(vectors, k: int = 20, every: int = 20, probes: int | None = None, share: float = SHARE, list_rows: int = LIST, errors: float = ERRORS, piece: int = PIECE, queries: int = QUERIES, sample: int = SAMPLE, seed: int = 0):
    """(query_id, rank, vec_id, score): for each vec_id divisible by every, k other vectors of high inner product, nearest first.

    Scores are inner products of the original vectors in double precision. probes: lists that a query visits; without
    it, as many as hold the given share of neighbours in the sample. Which vectors take part: see valid(); zero
    vectors don't. Vectors are compared with those of their own length: those as long as most of the sample are
    indexed, others searched exactly. Ties go to the smaller vec_id; fewer rows than k others of that length are all
    found. A query goes on to further lists until they hold k other rows. A list of many rows is searched in pieces,
    and many queries of a piece in blocks, which are both dealt evenly.
    """
    spark = vectors.sparkSession
    rows = stage(valid(vectors, nonzero=True), "ann-vectors", spark)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample + sample // MEASURED).collect()
    dims = np.array([len(r.v) for r in drawn] or [1])
    dim = int(np.bincount(dims).argmax())
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n, asked, others = rows.agg(*[F.count(F.when(c, 1)) for c in (F.size("v") == dim, (F.size("v") == dim) & is_query, F.size("v") != dim)]).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    query_blocks = max(1, ceil(asked / queries))
    drawn = [r for r in drawn if len(r.v) == dim]
    x = np.array([r.v for r in drawn], float)
    # where the rows drawn are all there are, figures of all of them are those of the table
    measured = x if n <= len(x) else x[sample * len(x) // (sample + sample // MEASURED) :]
    fitted = x[:sample] if n <= len(x) else x[: len(x) - len(measured)]
    lists = min(LISTS, max(1, ceil(n / list_rows)), max(1, len(fitted) // FITTED))
    index = fit(fitted, lists, share=share, k=k, seed=seed, measured=measured)
    sent = spark.sparkContext.broadcast(index)  # of a size that the parameters bound, like the next
    some = drawn[:BOUNDING]
    some_at = nearest(np.array([r.v for r in some], float), index.centers)
    bounding = spark.sparkContext.broadcast((np.array([r.vec_id for r in some]), np.array([r.v for r in some], float), some_at))

    def bounds(ids, x, near, visited):
        names, v, at = bounding.value
        if len(names) <= BELOW * k:
            return np.full(len(ids), -np.inf)
        seen = np.zeros((len(ids), len(sent.value.centers)), bool)
        np.put_along_axis(seen, near, visited, 1)
        products = np.where(seen[:, at] & (ids[:, None] != names), x @ v.T, -np.inf)
        low = np.partition(products, len(names) - BELOW * k, 1)[:, len(names) - BELOW * k]
        return np.where(np.isneginf(low), low, low - 1e-9 * (np.abs(np.where(np.isneginf(low), 0, low)) + 1))

    def encoded(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            at, codes = sent.value.encode(x) if batch.num_rows else (np.zeros(0, np.int64), np.zeros((0, 1), np.uint8))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())], ["vec_id", "v", "list", "code"])

    exact = cover_tree.top_k(rows.where(F.size("v") != dim).select("vec_id", F.col("v").alias("embedding")), k, every) if others else None
    rows = rows.where(F.size("v") == dim)
    indexed = stage(rows.mapInArrow(encoded, "vec_id bigint, v array<double>, list int, code binary"), "ann-index", spark)
    pieces, in_list = np.zeros((2, len(index.centers)), np.int64)
    for r in indexed.groupBy("list").count().collect():  # a row for each list
        pieces[r["list"]], in_list[r["list"]] = ceil(r["count"] / piece), r["count"]

    def visits(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            if not batch.num_rows:
                continue
            held = np.flatnonzero(pieces)
            order, lengths = ranked(x @ sent.value.centers[held].T, in_list[held], probes or sent.value.probes, k + 1)
            near, visited = held[order], np.arange(order.shape[1]) < lengths[:, None]
            for i in range(0, len(x), 1000):
                some, there = near[i : i + 1000], visited[i : i + 1000]
                low = bounds(batch.column(0).to_numpy()[i : i + 1000], x[i : i + 1000], some, there)
                flat, times = some[there], pieces[some[there]]
                at = np.repeat(np.repeat(np.arange(i, i + len(some)), there.sum(1)), times)
                part = np.concatenate([np.arange(t) for t in times])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(flat, times).astype(np.int32)), pa.array(part.astype(np.int32)), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(low[at - i])], ["list", "piece", "vec_id", "v", "low"])

    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(query_blocks)).cast("int").alias("block")
    visiting = rows.where(is_query).mapInArrow(visits, "list int, piece int, vec_id bigint, v array<double>, low double").select("*", block)
    counts = spark.createDataFrame([(i, int(p)) for i, p in enumerate(pieces) if p], "list int, pieces int")
    data = indexed.join(F.broadcast(counts), "list")  # broadcast: a row for each list
    data = data.withColumn("piece", F.pmod(F.xxhash64("vec_id"), "pieces").cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    data, key = data.select("list", "piece", "block", "vec_id", "v", "code"), ["list", "piece", "block"]
    found = visiting.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(_search(sent, k, errors), "query_id bigint, vec_id bigint, score double")
    return top(found, k) if exact is None else top(found, k).unionByName(exact)
