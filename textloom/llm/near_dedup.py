"""Near-duplicate documents by min-max hashing.

Each permutation of the shingles' hashes gives two values of a signature, its minimum and its maximum, so that half as
many hashes are evaluated. Bands of the signature join documents to candidate groups; links within these are
confirmed on full shingle sets. Documents with equal sets are one node from the start. A candidate group is compared
in blocks of bounded size: first each block by itself with a few sets of the whole group, which connect the blocks of
near copies; then only what that left apart with all of the group. A block passes on no more links than connect its
members.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from textloom.functions.shingles import ROWS, Shingler, Signer

from ._store import column, narrow, partitions, stage
from .components import components

#: Chance to miss a link of exactly the wanted similarity, for the number of bands.
MISS = 1e-7
#: Sets and shingles of a block, at most on average.
BLOCK_SETS, BLOCK_SHINGLES = 256, 500_000
#: Sets of a group that all its blocks get, about, besides its first.
COMMON = 8


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log1p(-(similarity**rows)))


def key_of(shingles: np.ndarray) -> tuple[int, int]:
    """Two signed numbers that stand for a set."""
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64).tolist())


def sketch(docs, size: int, bands: int):
    """(doc_id, h, row, n, s1, s2, bands): h is xxhash64 of the text, row numbers the rows, s1 and s2 stand for the shingle set, n is its size; no bands for an empty set."""

    def run(batches):
        from pyspark import TaskContext

        shingle, signer, row = Shingler(size), Signer(bands), TaskContext.get().partitionId() << 33
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part, out = batch.slice(k, 1000), []
                for doc, text, h in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist()):
                    s = shingle(text.as_py())
                    s1, s2 = key_of(s)
                    out.append((doc, h, row, len(s), s1, s2, signer.bands(s) if len(s) else []))
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (*[pa.int64()] * 6, pa.list_(pa.int64())))], ["doc_id", "h", "row", "n", "s1", "s2", "bands"])

    rows = narrow(docs, doc_id="bigint", text="string").select("doc_id", "text", F.xxhash64("text").alias("h"))
    return rows.mapInArrow(run, "doc_id bigint, h bigint, row bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>")


def _within_batches(batches):
    """(band, a, b). Without a band: edges that connect those nodes of the batch that have common bands, one less than nodes. With one: a is the first node that those of the batch with the band are connected to."""
    for batch in batches:
        size = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
        value, node = batch.column(1).flatten().to_numpy(), np.repeat(batch.column(0).to_numpy(), size)
        if not len(value):
            continue
        order = np.lexsort((node, value))
        value, node = value[order], node[order]
        begins = np.concatenate([[True], value[1:] != value[:-1]])
        head = node[np.maximum.accumulate(np.where(begins, np.arange(len(value)), 0))]
        root: dict[int, int] = {}

        def find(i):
            while (j := root.get(i, i)) != i:
                root[i] = root.get(j, j)
                i = j
            return i

        edges = []
        for a, b in np.unique(np.stack([head, node], 1)[~begins & (head != node)], axis=0).tolist():
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                edges.append((a, b))
        first = head[begins]
        if root:
            first = np.array([find(i) for i in first.tolist()])
        yield pa.RecordBatch.from_arrays([pa.array(value[begins]), pa.array(first), pa.nulls(len(first), pa.int64())], ["band", "a", "b"])
        if edges:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(edges), pa.int64()), *(pa.array(x, pa.int64()) for x in zip(*edges))], ["band", "a", "b"])


def _runs(batches):
    """Of rows sorted by band: edges from each band's first node to its others."""
    band, start = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        v, node = (batch.column(k).to_numpy() for k in (0, 1))
        begins = np.concatenate([[v[0] != band if band is not None else True], v[1:] != v[:-1]])
        at = np.maximum.accumulate(np.where(begins, np.arange(len(v)), -1))
        head = np.where(at >= 0, node[np.maximum(at, 0)], start if start is not None else 0)
        band, start = v[-1], head[-1]
        keep = head != node
        yield pa.RecordBatch.from_arrays([pa.array(head[keep]), pa.array(node[keep])], ["a", "b"])


def candidate_edges(nodes):
    """Edges (a, b) that connect all nodes with a common band. nodes: (node, bands). A band's nodes meet within batches first, so a band that a third of all nodes share sends a row for each batch."""
    rows = stage(nodes.select("node", "bands").mapInArrow(_within_batches, "band bigint, a bigint, b bigint"), "near-bands", nodes.sparkSession)
    across = rows.where(F.col("band").isNotNull()).select("band", F.col("a").alias("node")).repartition(partitions(nodes.sparkSession), "band").sortWithinPartitions("band", "node").mapInArrow(_runs, "a bigint, b bigint")
    return across.unionByName(rows.where(F.col("band").isNull()).select("a", "b")).distinct()


def links(sets: list[np.ndarray], left: list[int], right: list[int] | None, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of indexes into sets, between left and right or within left, with den * intersection >= num * union; no more than connect the same members."""
    within, right = right is None, left if right is None else right
    right = sorted(right, key=lambda i: len(sets[i]))
    size = np.array([len(sets[i]) for i in right])
    _, codes = np.unique(np.concatenate([sets[i] for i in left] + ([] if within else [sets[i] for i in right])), return_inverse=True)
    at, k = {}, 0
    for i in left + ([] if within else right):
        at[i] = codes[k : k + len(sets[i])]
        k += len(sets[i])
    flat, starts = np.concatenate([at[i] for i in right]), np.concatenate([[0], np.cumsum(size)])
    flag, root, out = np.zeros(codes.max() + 1, np.int32), {i: i for i in [*left, *right]}, []

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in left:
        n = len(sets[i])
        low, high = np.searchsorted(size, -(-n * num // den)), np.searchsorted(size, n * den // num, "right")
        if low >= high:
            continue
        flag[at[i]] = 1
        both = np.add.reduceat(flag[flat[starts[low] : starts[high]]], starts[low:high] - starts[low])
        flag[at[i]] = 0
        for j in np.flatnonzero(den * both >= num * (n + size[low:high] - both)) + low:
            a, b = find(i), find(right[j])
            if a != b:
                root[a] = b
                out.append((i, right[j]))
    return out


def _sets(table, side=None):
    rows = zip(table["node"].to_pylist(), table["body"].to_pylist(), table["side"].to_pylist())
    by = {node: body for node, body, s in rows if side is None or s == side}
    return list(by), [np.frombuffer(x, np.uint64) for x in by.values()], by


def _edges(names, found):
    return [names[i] for i, _ in found], [names[j] for _, j in found]


def _first_pass(num: int, den: int):
    """(a, b, body): links among a block's sets; and, of groups of several blocks, its own sets (side 1) themselves, with b null."""

    def run(key, table):
        names, sets, by = _sets(table)
        a, b = _edges(names, links(sets, list(range(len(names))), None, num, den))
        own = sorted(set(table.filter(pc.and_(pc.equal(table["side"], 1), pc.greater(table["chunks"], 1)))["node"].to_pylist()))
        body = [None] * len(a) + [by[n] for n in own]
        return pa.table({"a": pa.array(a + own, pa.int64()), "b": pa.array(b + [None] * len(own), pa.int64()), "body": pa.array(body, pa.binary())})

    return run


def _second_pass(num: int, den: int):
    """(a, b): links between a block's sets of side 0 and those of side 1."""

    def run(key, table):
        (left, x, _), (right, y, _) = _sets(table, 0), _sets(table, 1)
        found = links(x + y, list(range(len(x))), list(range(len(x), len(x) + len(y))), num, den) if x and y else []
        a, b = _edges(left + right, found)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _apart(nodes, edges, block_sets: int, block_shingles: int):
    """(node, grp, chunks, parts, is_rest) of groups of several blocks that edges leave in several components: is_rest outside of the largest. parts: blocks of the rest."""
    several = nodes.where("chunks > 1").join(components(edges), "node", "left")
    placed = stage(several.select("node", "grp", "n", "chunks", F.coalesce("component", "node").alias("c")), "near-placed", nodes.sparkSession)
    largest = placed.groupBy("grp", "c").agg(F.count("*").alias("k")).groupBy("grp").agg(F.max_by("c", F.struct("k", "c")).alias("largest"))
    told = placed.join(largest, "grp").select("node", "grp", "n", "chunks", (F.col("c") != F.col("largest")).alias("is_rest"))
    rest = told.where("is_rest").groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / block_sets), F.ceil(F.sum("n") / block_shingles)).cast("int").alias("parts"))
    return told.join(rest, "grp").select("node", "grp", "chunks", "parts", "is_rest")


def confirmed(nodes, sets, num: int, den: int, block_sets: int, block_shingles: int):
    """(node, component) of sets that links join. nodes: a stored table (node, grp, n, size, chunks): of a group grp, named by its first node, of so many sets in so many blocks. sets: the same with body, evaluated once.

    In the first pass a set goes to its block, and the group's first and about COMMON others to all of its blocks. Where
    that leaves one component, every link is within it. Elsewhere the sets outside the largest component meet all of
    the group in a second pass, so that all links between components are found.
    """
    spark, chunk = nodes.sparkSession, F.pmod(F.xxhash64("node"), "chunks").cast("int")
    often = F.least(F.lit(COMMON), F.greatest(F.lit(1), F.floor(F.col("size") / (8 * F.col("chunks")))))
    common = (F.col("node") == F.col("grp")) | (F.pmod(F.xxhash64("node", F.lit(1)), "size") < often)
    to = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    blocks = sets.select("grp", "chunks", F.explode(F.when(common, to("chunks")).otherwise(F.array(chunk))).alias("j"), chunk.alias("own"), "node", "body")
    blocks = blocks.select("grp", "j", "chunks", (F.col("own") == F.col("j")).cast("int").alias("side"), "node", "body")
    out = stage(blocks.groupBy("grp", "j").applyInArrow(_first_pass(num, den), "a bigint, b bigint, body binary"), "near-links", spark)
    first = out.where("b IS NOT NULL").select("a", "b")
    # merge: else a small table would be broadcast, and the same step would be another one on a larger input
    apart = stage(_apart(nodes, first, block_sets, block_shingles), "near-apart", spark).hint("merge")
    again = out.where("b IS NULL").select(F.col("a").alias("node"), "body").join(apart, "node")
    right = again.select("grp", F.explode(to("parts")).alias("i"), chunk.alias("j"), F.lit(1).alias("side"), "node", "body")
    left = again.where("is_rest").select("grp", F.pmod(F.xxhash64("node", F.lit(2)), "parts").cast("int").alias("i"), F.explode(to("chunks")).alias("j"), F.lit(0).alias("side"), "node", "body")
    second = stage(left.unionByName(right).groupBy("grp", "i", "j").applyInArrow(_second_pass(num, den), "a bigint, b bigint"), "near-more-links", spark)
    return components(first.unionByName(second).where("a != b"))


def _grouped(docs, words: int, num: int, den: int, rows: int, miss: float, block_sets: int, block_shingles: int):
    """(doc_id, h, n, c, first_h) of every row: c and first_h name the first document of those that links reach, by doc_id, null last, and h; null where there are no others."""
    spark = docs.sparkSession
    all_rows = stage(sketch(docs, words, bands_for(num / den, rows, miss)), "near-sketch", spark)
    some = all_rows.where("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "row")
    reps = stage(some.groupBy("s1", "s2").agg(F.min(order).alias("m"), F.count("*").alias("copies"), F.first("n").alias("n")).select(F.col("m.row").alias("node"), F.col("m.doc_id").alias("doc_id"), F.col("m.h").alias("h"), "s1", "s2", "copies", "n"), "near-sets", spark)
    nodes = some.groupBy("s1", "s2").agg(F.min_by("bands", order).alias("bands"), F.min(order).alias("m")).select(F.col("m.row").alias("node"), "bands")
    groups = components(stage(candidate_edges(nodes), "near-candidates", spark)).withColumnRenamed("component", "grp")
    members = stage(reps.join(groups, "node"), "near-members", spark)
    sizes = members.groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / block_sets), F.ceil(F.sum("n") / block_shingles)).cast("int").alias("chunks"), F.count("*").alias("size"))
    wanted = stage(members.join(sizes, "grp").select(F.col("doc_id").alias("wanted_id"), "node", "grp", "n", "size", "chunks", "s1", "s2"), "near-wanted", spark)
    # merge: else a small wanted would be broadcast, and the same step would be another one on a larger input
    texts = narrow(docs, doc_id="bigint", text="string").join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("text", "s1", "s2", "node", "grp", "size", "chunks")

    def full(batches):
        shingle = Shingler(words)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                body, keep = [], []
                for text, s1, s2 in zip(part.column(0), part.column(1).to_pylist(), part.column(2).to_pylist()):
                    s = shingle(text.as_py())
                    keep.append(key_of(s) == (s1, s2))
                    if keep[-1]:
                        body.append(s.tobytes())
                part = part.filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays([*part.columns[3:], pa.array(body, pa.binary())], ["node", "grp", "size", "chunks", "body"])

    sets = texts.mapInArrow(full, "node bigint, grp bigint, size bigint, chunks int, body binary")
    found = stage(confirmed(wanted, sets, num, den, block_sets, block_shingles), "near-found", spark)
    named = stage(found.join(reps.select("node", "doc_id", "h", "s1", "s2"), "node"), "near-named", spark)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("of")
    of_sets = named.join(named.groupBy("component").agg(first), "component").select("s1", "s2", F.col("of.doc_id").alias("c"), F.col("of.h").alias("first_h"))
    copies = reps.where("copies > 1").join(found.select("node"), "node", "left_anti").select("s1", "s2", F.col("doc_id").alias("c"), F.col("h").alias("first_h"))
    return all_rows.select("doc_id", "h", "n", "s1", "s2").join(of_sets.unionByName(copies), ["s1", "s2"], "left").select("doc_id", "h", "n", "c", "first_h")


def near_duplicates(docs, words: int = 5, num: int = 80, den: int = 100, rows: int = ROWS, miss: float = MISS, block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES):
    """(doc_id, n_shingles, component_id, kept) of every row of docs.

    Documents are linked where den * |A and B| >= num * |A or B| of their distinct shingles of so many words; a link
    is missed with a chance of miss at most, and none is made that doesn't hold. component_id is the smallest doc_id
    reachable. A null or empty text has no shingles and no links. A null doc_id reaches its links' smallest doc_id and
    is null only without one; kept compares null-safely. Rows of a repeated doc_id are nodes of their own. Other
    columns don't matter.

    Rows of one candidate group are compared in blocks of block_sets sets: what a block reads is bounded. A group of
    near copies is read once; of r sets that aren't linked with most of the group so, all of it is read r / block_sets
    times more. Equal sets are compared once, however many they are.
    """
    out = _grouped(docs, words, num, den, rows, miss, block_sets, block_shingles)
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs, words: int = 5, num: int = 80, den: int = 100, rows: int = ROWS, miss: float = MISS, block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES):
    """The rows of docs, with all their columns, without documents that links of near_duplicates() join to an earlier one: by doc_id, null last, then by a hash of the text.

    So one document of each group stays, also where doc_ids are null or repeated. Rows equal in doc_id and text are one
    document, and stay or go together.
    """
    found = _grouped(docs, words, num, den, rows, miss, block_sets, block_shingles).where("first_h IS NOT NULL AND NOT (doc_id <=> c AND h = first_h)")
    removed = found.select(F.col("doc_id").alias("__removed"), F.col("h").alias("__h")).distinct()
    same = column(docs, "doc_id", "bigint").eqNullSafe(F.col("__removed")) & (F.xxhash64(column(docs, "text", "string")) == F.col("__h"))
    # merge: else a few removed rows would be broadcast, and the same step would be another one on a larger input
    return docs.join(removed.hint("merge"), same, "left_anti")
