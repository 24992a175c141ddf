"""Training exports: union of sources, weights, texts and a budget of tokens."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.schema import SOURCE_WEIGHTS, TIER_WEIGHTS, tier_rank

#: Rows of narrow columns that one task may order for a budget; beyond it, sums of ranges are ordered first.
PARTS = 1024


def union(*inputs):
    """All rows; columns that an input lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)


def without_retrieval_only(documents):
    """Documents for training; a null eligibility stays."""
    return documents.where(F.coalesce("training_eligibility", F.lit("")) != "retrieval_only")


def skipped(documents):
    """(reason, n) of documents that an export leaves out."""
    return documents.where(F.col("training_eligibility") == "retrieval_only").groupBy(F.col("training_eligibility").alias("reason")).agg(F.count("*").alias("n"))


def weighted(documents, sources=SOURCE_WEIGHTS, tiers=TIER_WEIGHTS, otherwise: float = 0.0):
    """documents with source_weight, tier_weight and their product, sampling_weight. The weights are a few literals; a key without one gets otherwise."""

    def look(weights, key):
        table = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        return F.coalesce(F.try_element_at(table, F.col(key)), F.lit(otherwise))

    out = documents.withColumns({"source_weight": look(sources, "source"), "tier_weight": look(tiers, "quality_tier")})
    return out.withColumn("sampling_weight", F.col("source_weight") * F.col("tier_weight"))


def with_texts(manifest, texts, key: str = "doc_id"):
    """(found, missing): manifest rows with their text, and those without one."""
    t = texts.select(key, "text")
    return manifest.join(t, key), manifest.join(t, key, "left_anti")


def budget(counts, target: int, most: int, order=None, tokens: str = "token_count"):
    """counts with cumulative_tokens, in an order, until the target is reached; rows that would pass most are left out with all after them.

    The order is by default tier, source weight from high to low, and doc_id; it must end in a unique key. Sums of
    PARTS ranges of the order come first, so that only ranges that start below the target are ordered, each in its
    own task, and none gathers all rows.
    """
    order = order or [tier_rank(F.col("quality_tier")).asc(), F.col("source_weight").desc(), F.col("doc_id").asc()]
    n = min(PARTS, int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # ranges by a range partitioning, sums by partition, then prefix sums of the few sums
    ranged = counts.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id())
    before = ranged.groupBy("__part").agg(F.sum(tokens).alias("s")).withColumn("__before", F.coalesce(F.sum("s").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__part", "__before")
    w = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(before), "__part").where(F.col("__before") < target).withColumn("cumulative_tokens", F.col("__before") + F.sum(tokens).over(w))  # broadcast: PARTS rows at most
    return out.where((F.col("cumulative_tokens") - F.col(tokens) < target) & (F.col("cumulative_tokens") <= most)).drop("__part", "__before")


def manifest_summary(documents):
    """(kind, key, n): documents by source and by tier."""
    of = lambda c: documents.groupBy(F.col(c).alias("key")).agg(F.count("*").alias("n")).select(F.lit(f"by_{c}").alias("kind"), "key", "n")
    return of("source").unionByName(of("quality_tier"))
