"""Token counts, their sums over several dimensions, and profiles of a corpus."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import text as fn

DIMENSIONS = ("author", "period", "language", "source", "quality_tier", "work_id")
TOKENIZER = ("target_family", "backend", "model_id", "tokenizer", "tokenizer_version", "processor_revision", "context_length", "add_special_tokens", "plain_text_tokenization", "chat_template_applied", "enable_thinking")


def sums(counts, dimensions=DIMENSIONS, value: str = "token_count"):
    """(dimension, key, documents, tokens): sums over each dimension and, as dimension total, over all. A null key is a group like others; the total of no rows is 0.

    All take one pass: rows are expanded by grouping sets, and which set a row is of is told by its grouping id.
    """
    n = len(dimensions)
    # a bit of grouping_id is 0 for the column that is grouped by; the set of none is the total
    sets = {(1 << n) - 1 - (1 << (n - 1 - i)): d for i, d in enumerate(dimensions)} | {(1 << n) - 1: "total"}
    names = F.create_map(*[x for g, d in sets.items() for x in (F.lit(g), F.lit(d))])
    rows = counts.select(*[F.col(d).cast("string").alias(d) for d in dimensions], F.col(value).cast("bigint").alias("__v"))
    out = rows.groupingSets([*[[F.col(d)] for d in dimensions], []], *[F.col(d) for d in dimensions]).agg(F.grouping_id().cast("int").alias("g"), F.count("*").alias("documents"), F.coalesce(F.sum("__v"), F.lit(0)).alias("tokens"))
    out = out.select(names[F.col("g")].alias("dimension"), F.coalesce(*[F.col(d) for d in dimensions]).alias("key"), "documents", "tokens")
    nothing = counts.sparkSession.createDataFrame([("total", None, 0, 0)], "dimension string, key string, documents bigint, tokens bigint")
    return out.unionByName(nothing).groupBy("dimension", "key").agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


def top(counts, key: str = "work_id", value: str = "token_count", n: int = 10, order: str = "_ord"):
    """(key, tokens) of the n largest sums; of equal ones the key that came first."""
    return counts.groupBy(key).agg(F.sum(value).alias("tokens"), F.min(order).alias("__o")).orderBy(F.desc("tokens"), "__o").limit(n).select(key, "tokens")


def tokenizer_of(counts, order: str = "_ord"):
    """One row: the tokenizer's columns of the first row, none for no rows."""
    return counts.agg(F.min_by(F.struct(*TOKENIZER), order).alias("t")).where("t IS NOT NULL").select("t.*")


def line_statistics(documents, group=()):
    """Sum, mean, extremes and interpolated quartiles of characters and lines."""
    rows = documents.select(*group, fn.char_count(F.col("text")).alias("chars"), fn.line_count(F.col("text")).alias("lines"))
    aggregates = [F.count("*").alias("documents")]
    for c in ("chars", "lines"):
        q = F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        aggregates += [F.sum(c).alias(f"total_{c}"), F.avg(c).alias(f"mean_{c}"), F.min(c).alias(f"min_{c}"), q[0].alias(f"p25_{c}"), q[1].alias(f"median_{c}"), q[2].alias(f"p75_{c}"), F.max(c).alias(f"max_{c}")]
    return (rows.groupBy(*group) if group else rows).agg(*aggregates)


def shares(counts, key: str, value: str = "token_count"):
    """(key, tokens, share): of the sum of all."""
    by = counts.groupBy(key).agg(F.sum(value).alias("tokens"))
    return by.withColumn("share", F.col("tokens") / F.sum("tokens").over(Window.partitionBy()))


def pivot(counts, row: str, column: str, values, value: str = "token_count"):
    """Sums by row, a column for each of values and a total; null where there is nothing."""
    return counts.groupBy(row).agg(*[F.sum(F.when(F.col(column) == v, F.col(value))).alias(str(v)) for v in values], F.sum(value).alias("total"))


def histogram(rows, *keys):
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def class_histogram(scored, classes=("ocr_gold", "ocr_silver", "ocr_bronze", "reject")):
    """(ocr_quality_class, n) of each class, 0 for one that no row has."""
    all_classes = scored.sparkSession.createDataFrame([(i, c) for i, c in enumerate(classes)], "i int, ocr_quality_class string")
    return all_classes.join(histogram(scored, "ocr_quality_class"), "ocr_quality_class", "left").select("ocr_quality_class", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def status_profile(documents, *keys):
    """Records, characters and bytes of texts by the keys (stage, source, ...)."""
    return documents.groupBy(*keys).agg(F.count("*").alias("records"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("bigint").alias("chars"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("bigint").alias("bytes"))


def coverage_gaps(works, versions):
    """(work_id, author, title, period, quality_tier) of works that no version has."""
    return works.join(versions.select("work_id"), "work_id", "left_anti").select("work_id", "author", "title", "period", "quality_tier")


def per_work(documents):
    """(work_id, documents): null is a work like others."""
    return documents.groupBy("work_id").agg(F.count("*").alias("documents"))


def distinct_counts(documents, columns=("work_id", "author")):
    """One row: documents, and how many different values each column has, null not counted."""
    return documents.agg(F.count("*").alias("documents"), *[F.count_distinct(c).alias(f"{c}s") for c in columns])


def licence_summary(documents, policy):
    """(license_status, include_by_default, documents, chars): a status that the policy lacks is unknown; null is a status like others."""
    by = documents.groupBy("license_status").agg(F.count("*").alias("documents"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("bigint").alias("chars"))
    known = F.broadcast(policy.select(F.col("license_status").alias("__status"), "include_by_default"))  # broadcast: a policy's statuses
    return by.join(known, F.col("license_status") == F.col("__status"), "left").select("license_status", F.coalesce("include_by_default", F.lit("unknown")).alias("include_by_default"), "documents", "chars")


def reconciled(counts, documents, totals):
    """One row of checks: counts and documents name the same ids, and sums() of the counts adds up to totals' total in each dimension.

    totals: rows of sums().
    """
    ids = lambda d: d.select("doc_id").distinct()
    missing = ids(documents).join(ids(counts), "doc_id", "left_anti").agg(F.count("*").alias("without_count"))
    extra = ids(counts).join(ids(documents), "doc_id", "left_anti").agg(F.count("*").alias("without_document"))
    by = totals.groupBy("dimension").agg(F.sum("tokens").alias("t"))
    uneven = by.agg((F.count_distinct("t") <= 1).alias("sums_agree"))
    whole = counts.agg(F.coalesce(F.sum("token_count"), F.lit(0)).alias("tokens"))
    return missing.join(F.broadcast(extra)).join(F.broadcast(uneven)).join(F.broadcast(whole))  # broadcast: one row each
