"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by the set of sources they belong to (their pattern). A flow routes words from patterns to the
quotas of their sources; each further copy of a pattern's words costs more than the one before. What a pattern sends
is then whole copies of its documents and, of one copy more, documents in a seeded order up to the rest.
"""

from collections import defaultdict

from pyspark.sql import Window
from pyspark.sql import functions as F

from ._store import narrow, stage

WORDS = r"[^\x20\x09-\x0D]+"
#: Parts of the seeded order in a level of its histogram; two levels are summed before rows are ordered.
PARTS = 1024
#: Rows of one doc_id are set apart if they are more than this share of all, and so many.
HOT, LEAST_HOT = 1 / 4096, 1000


def water_level(sizes: dict, weights: dict, total: float, most: float = 2.0) -> dict:
    """Targets that share total by weight, none above most times its size; the excess is shared again."""
    targets, rest, open_ = {}, total, set(sizes)
    while open_:
        level = rest / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > most * sizes[s]}
        if not full:
            targets |= {s: level * weights[s] for s in open_}
            break
        targets |= {s: most * float(sizes[s]) for s in full}
        open_ -= full
        rest = total - sum(targets[s] for s in targets)
    return targets


def cyclic_weights(sources, cycle=(3, 1, 2)) -> dict:
    """Weights in turn to sources by code point, null last."""
    return {s: cycle[i % len(cycle)] for i, s in enumerate(sorted(sources, key=lambda s: (s is None, s or "")))}


def flow(supply: dict, members: dict, quota: dict, copies: int = 2) -> dict:
    """Words that each pattern sends to each of its sources: the greatest flow of the least cost, if copy k of a word costs k.

    supply: words of each pattern; members: its sources; quota: words of each source. Successive shortest paths: as
    costs lie only on the arcs into the patterns, copies are opened one by one and each is filled by augmenting paths.
    Parts of the graph that share no source are solved apart.
    """
    sent = {p: dict.fromkeys(members[p], 0.0) for p in supply}
    left, of = dict(quota), defaultdict(list)
    for p, some in members.items():
        for s in some:
            of[s].append(p)
    for _ in range(copies):
        for p in supply:
            room = float(supply[p])
            while room > 1e-9:
                # breadth first from p to a source with quota left, back along words already sent
                came, queue, found = {}, [("p", p)], []
                seen = {("p", p)}
                for kind, x in queue:
                    if kind == "s" and left.get(x, 0) > 1e-9:
                        found = [x]
                        break
                    for y in ([("s", s) for s in members[x]] if kind == "p" else [("p", q) for q in of[x] if sent[q][x] > 1e-9]):
                        if y not in seen:
                            seen.add(y)
                            came[y] = (kind, x)
                            queue.append(y)
                if not found:
                    break
                end = found[0]
                path, at = [], ("s", end)
                while at in came:
                    path.append((came[at], at))
                    at = came[at]
                amount = min([room, left[end], *(sent[b[1]][a[1]] for a, b in path if a[0] == "s")])
                for a, b in path:
                    if a[0] == "p":
                        sent[a[1]][b[1]] += amount
                    else:
                        sent[b[1]][a[1]] -= amount
                left[end] -= amount
                room -= amount
    return sent


def sized(docs):
    """(doc_id, source, size, h): size counts words of the whole text, 0 for a null one; h is a hash of it."""
    return narrow(docs, doc_id="bigint", source="string", text="string").select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("bigint").alias("size"), F.xxhash64("text").alias("h"))


def apart(rows):
    """rows, a stored table, with a text __own that sets apart rows of a doc_id, null too, that many share: the hash h of the text, and a number if many share that as well. It is null for all others, whose order then depends on the doc_id alone.

    Many are more than a share HOT of all rows.
    """
    most = max(LEAST_HOT, int(rows.count() * HOT))

    def often(*by):
        same = [F.col(c).alias(f"__{c}") for c in by]
        return rows.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > most).select(*same, F.lit(True).alias("__often_" + by[-1]))

    # broadcast: 1 / HOT keys at most, twice
    found = rows.join(F.broadcast(often("doc_id")), F.col("doc_id").eqNullSafe(F.col("__doc_id")), "left").drop("__doc_id")
    found = found.join(F.broadcast(often("doc_id", "h")), F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("h") == F.col("__h")), "left").drop("__doc_id", "__h")
    own = F.concat_ws(":", F.col("h").cast("string"), F.when(F.col("__often_h"), F.monotonically_increasing_id()).cast("string"))
    return found.withColumn("__own", F.when(F.col("__often_doc_id"), own)).drop("__often_doc_id", "__often_h")


def choose(rows, plan, seed: int):
    """rows with copies: how often the mix takes each. rows: (doc_id, pattern, size, ...); plan: {pattern: words}.

    The seeded order is by a hash of doc_id, and of __own where rows have it
    (see apart()). Only the part of a part of it in which a pattern's rest ends is sorted.
    """
    spark = rows.sparkSession
    table = spark.createDataFrame([(p, int(whole), float(rest)) for p, (whole, rest) in plan.items()], "pattern string, whole int, rest double")
    own = ["__own"] if "__own" in rows.columns else []
    rank = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), *own)), 1, 15), 16, 10).cast("bigint")
    rows = rows.join(F.broadcast(table), "pattern").withColumn("__rank", rank)  # broadcast: a row for each pattern, of which the driver already holds the sums
    width = (1 << 60) // PARTS
    rows = rows.withColumn("__a", F.floor(F.col("__rank") / width).cast("int")).withColumn("__b", F.floor((F.col("__rank") % width) / (width // PARTS)).cast("int"))
    before = Window.partitionBy("pattern").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    def ends(some, part, base):
        """For each pattern the part in which the words reach its rest, and the words before it."""
        sums = some.groupBy("pattern", F.col(part).alias("part"), F.col("rest"), base.alias("base")).agg(F.sum("size").alias("s"))
        sums = sums.withColumn("at", F.col("base") + F.coalesce(F.sum("s").over(before), F.lit(0)))
        return sums.where("at <= rest and at + s > rest").select("pattern", F.col("part").alias("end" + part), F.col("at").alias("at" + part))

    first = ends(rows, "__a", F.lit(0))
    second = ends(rows.join(F.broadcast(first), "pattern").where("__a = end__a"), "__b", F.col("at__a"))
    edge = rows.join(F.broadcast(first), "pattern", "left").join(F.broadcast(second), "pattern", "left")  # broadcast: a row for each pattern
    # beyond any end (all words lie before the rest), everything is taken
    edge = edge.withColumn("__side", F.expr("CASE WHEN end__a IS NULL OR __a < end__a THEN 1 WHEN __a > end__a THEN 0 WHEN end__b IS NULL OR __b < end__b THEN 1 WHEN __b > end__b THEN 0 END"))
    inside = edge.where("__side IS NULL").withColumn("__before", F.coalesce(F.sum("size").over(Window.partitionBy("pattern").orderBy("__rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = inside.withColumn("__side", (F.col("at__b") + F.col("__before") + F.col("size") / 2 <= F.col("rest")).cast("int")).drop("__before")
    chosen = edge.where("__side IS NOT NULL").unionByName(inside)
    return chosen.withColumn("copies", F.col("whole") + F.col("__side")).drop("whole", "rest", "__rank", "__a", "__b", "end__a", "at__a", "end__b", "at__b", "__side")


def plan_of(sent: dict, supply: dict) -> dict:
    """{pattern: (whole copies, words of one copy more)} of a flow."""
    plan = {}
    for p, to in sent.items():
        words = sum(to.values())
        whole = int(words // supply[p]) if supply[p] else 0
        plan[p] = (whole, words - whole * supply[p])
    return plan


def mix(rows, targets: dict, copies: int = 2, seed: int = 0):
    """rows: (doc_id, sources array<string>, size, ...), with copies added, 0 for documents that the mix leaves out.

    targets: words of each source; a null source is the key None. Sums by pattern come to the driver: there must be
    few patterns. Documents of no words fall on either side. A null or empty list of sources belongs to none: 0 copies.
    """
    key = F.to_json(F.struct(F.array_sort(F.array_distinct("sources")).alias("p")))
    rows = rows.withColumn("pattern", F.coalesce(key, F.lit("{}")))
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("words"), F.first("sources").alias("sources")).collect()
    supply = {r.pattern: r.words for r in sums}
    members = {r.pattern: sorted(set(r.sources or []), key=lambda s: (s is None, s or "")) for r in sums}
    return choose(rows, plan_of(flow(supply, members, targets, copies), supply), seed).drop("pattern")


def mix_by_source(docs, cycle=(3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 0):
    """(doc_id, source, size, source_size, target, copies, taken) of every row: sources weigh cycle in turn and share so many times all words.

    Taken words differ from a source's target by half a document at most. Null texts have no words; null and empty
    sources are sources like others; rows of a repeated or null doc_id are rows of their own.
    """
    rows = apart(stage(sized(docs), "mix-sizes"))
    sizes = {r.source: r.words for r in rows.groupBy("source").agg(F.sum("size").alias("words")).collect()}
    targets = water_level(sizes, cyclic_weights(sizes, cycle), share * sum(sizes.values()), most)
    out = mix(rows.withColumn("sources", F.array("source")), targets, most, seed)
    table = docs.sparkSession.createDataFrame([(s, int(sizes[s]), float(targets[s])) for s in sizes], "s string, source_size bigint, target double")
    out = out.drop("h", "__own").join(F.broadcast(table), F.col("source").eqNullSafe(F.col("s")))  # broadcast: a row for each source
    return out.select("doc_id", "source", "size", "source_size", "target", F.col("copies").cast("int").alias("copies"), (F.col("size") * F.col("copies")).cast("bigint").alias("taken"))


def mixed(docs, **how):
    """The rows of docs, with all their columns, as often as mix_by_source(docs, **how) takes them. Rows of one doc_id are taken as often as the one taken most."""
    taken = mix_by_source(docs, **how).where(F.col("copies") > 0).groupBy("doc_id").agg(F.max("copies").alias("__copies")).withColumnRenamed("doc_id", "__doc_id")
    name = next(c for c in docs.columns if c.lower() == "doc_id")
    out = docs.join(taken.hint("merge"), docs[f"`{name}`"].cast("bigint").eqNullSafe(F.col("__doc_id")))
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*[docs[f"`{c}`"] for c in docs.columns])
