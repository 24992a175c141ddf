"""Selection of manifest rows, lookups in side tables, and the checks that go with them.

Rows of a manifest have an order that matters for limits, repeated keys and ties: the column `_ord`.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.schema import REQUIRED, inclusion

CONFIDENCE = "high"


def selected(manifest, source: str, version_ids=None, confidence: str = CONFIDENCE, limit: int | None = None):
    """Rows of a source that were resolved with confidence, of the given version_ids if any, and the first ones by _ord only if there is a limit."""
    rows = manifest.where((F.col("source") == source) & (F.col("resolution_confidence") == confidence))
    if version_ids is not None:
        rows = rows.where(F.col("version_id").isin(list(version_ids)))
    return rows if limit is None else first_rows(rows, limit)


def first_rows(rows, limit: int):
    """The first rows by _ord; a negative limit is an error."""
    if limit < 0:
        raise ValueError("a limit can't be negative")
    return rows.orderBy("_ord").limit(limit)


def missing_ids(requested, rows, key: str = "version_id"):
    """Requested keys, a column of a frame, that no row has. Before any limit, so that a limit doesn't make ids look missing."""
    return requested.select(key).distinct().join(rows.select(key), key, "left_anti")


def violations(rows, required=REQUIRED, key: str = "version_id"):
    """(key, field) of each required field that is null or empty, or the number 0."""
    empty = lambda c: F.col(c).isNull() | F.col(c).cast("string").isin("", "0")
    fields = F.filter(F.array(*[F.when(empty(c), F.lit(c)) for c in required]), lambda x: x.isNotNull())
    return rows.select(F.col(key), F.explode(fields).alias("field"))


def last_wins(rows, key: str):
    """One row a key, the last by _ord; null keys are one key. An aggregate, which combines before its shuffle, so that a key of many rows is no task's."""
    rest = [c for c in rows.columns if c != key]
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.coalesce(F.col("_ord").cast("bigint"), F.lit(-(1 << 63))))
    out = rows.groupBy(key).agg(last.alias("__last"))
    return out.select(*[F.col(f"`{c}`") if c == key else F.col("__last")[c].alias(c) for c in rows.columns])


def with_works(versions, works, fields=("author", "quality_tier", "period")):
    """versions with fields of their work and title, the work's where the version has none. Left join; of works with one id the last counts; null ids match.

    Spark broadcasts works where their size allows and merges them otherwise.
    """
    w = last_wins(works, "work_id").select(F.col("work_id").alias("__id"), F.col("title").alias("__title"), *[F.col(f).alias(f"__{f}") for f in fields])
    joined = versions.join(w, F.coalesce(versions["work_id"], F.lit("None")) == F.coalesce(F.col("__id"), F.lit("None")), "left")
    out = joined.withColumns({**{f: F.col(f"__{f}") for f in fields}, "title": F.coalesce(F.nullif("title", F.lit("")), "__title")})
    return out.drop("__id", "__title", *[f"__{f}" for f in fields])


def scan_gate(documents, scores, key: str = "source_id"):
    """documents with the score and class of their scan, without those whose class is reject. A document without a score stays; of several scores the last by _ord counts."""
    s = last_wins(scores, key).select(F.col(key).alias("__key"), "ocr_quality_score", "ocr_quality_class")
    joined = documents.join(s, documents[key] == F.col("__key"), "left").drop("__key")
    return joined.where(F.coalesce("ocr_quality_class", F.lit("")) != "reject")


def long_enough(documents, text: str = "text", least: int = 100):
    """Documents of so many characters or more, before any cleaning; a null text has none."""
    return documents.where(F.length(text) >= least)


def scan_tier(scan_class):
    """The tier of a scanned document: the last one for a bronze class, the first for any other or none."""
    from textloom.schema import TIERS

    return F.when(scan_class == "ocr_bronze", TIERS[-1]).otherwise(TIERS[0])


def eligibility(scan_class):
    return F.when(scan_class == "ocr_bronze", "retrieval_only").otherwise("training_candidate")


def licence_gate(documents, policy, review: bool = False):
    """Documents whose licence_status the policy includes, or leaves to review if review is set; one without a policy isn't included.

    policy: (license_status, include_by_default): a row for each status that there is.
    """
    p = policy.select("license_status", inclusion(F.col("include_by_default")).alias("inclusion"))
    return documents.join(p, "license_status").where(F.col("inclusion").isin(["include", "review"] if review else ["include"]))


def id_mismatch(left, right, key: str = "doc_id"):
    """(key, side) of keys that one side only has."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def first_artifact(artifacts, format: str):
    """The first element of an array of artifacts in a format, or null."""
    return F.get(F.filter(artifacts, lambda a: a["format"] == format), F.lit(0))


def short_texts(documents, below: int = 10_000, text: str = "text"):
    """Documents of fewer characters, to be looked at; a null text has none."""
    return documents.where(F.coalesce(F.length(text), F.lit(0)) < below)


def without_internal(rows, prefix: str = "_dedup_"):
    """rows without the columns of a prefix."""
    return rows.drop(*[c for c in rows.columns if c.startswith(prefix)])
