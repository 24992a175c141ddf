"""From raw texts and manifests to normalized documents. Rows that can't be normalized are returned apart, with the reason."""

from pyspark.sql import functions as F

from textloom.functions import boilerplate
from textloom.functions import text as fn
from textloom.operators import select

_NESTED = ("version_id", "work_id", "source", "source_id", "source_url", "title", "author_metadata", "translator", "editor", "language", "source_release_date", "license_status", "license_rationale", "acquisition_method", "resolution_confidence")


def record(rows, details, format: str | None = "txt", normalizer: str = "textloom"):
    """The 25 columns of a normalized document. rows: a version with its work's fields, artifacts, raw_path, raw_sha256, acquired_at_utc and text. details: columns of the struct normalization that are the source's own.

    format: of the artifact that the text came from; None for the first.
    """
    artifact = select.first_artifact(F.col("artifacts"), format) if format else F.get("artifacts", F.lit(0))
    top = ["version_id", "work_id", "title", "author", "author_metadata", "translator", "editor", "language", "source", "source_id", "source_url", "source_release_date", "license_status", "license_rationale", "quality_tier", "period", "resolution_confidence", "acquisition_method"]
    none = F.lit(None).cast("string")
    return rows.select(
        F.concat("version_id", F.lit("__full_text")).alias("doc_id"),
        *top,
        F.struct(F.col("title").alias("work"), none.alias("book"), none.alias("section")).alias("hierarchy"),
        F.struct("raw_path", "raw_sha256", artifact["source_url"].alias("source_artifact_url"), "acquired_at_utc").alias("raw"),
        F.struct(*details, F.lit(normalizer).alias("normalizer"), F.lit("NFC").alias("unicode_normalization"), F.lit("full_text_only").alias("segmentation"), fn.char_count(F.col("text")).alias("text_char_count"), fn.line_count(F.col("text")).alias("text_line_count")).alias("normalization"),
        F.struct(*_NESTED).alias("manifest_record"),
        F.struct("version_id", "acquired_at_utc", "artifacts").alias("acquisition_metadata"),
        "text",
    )


def _inputs(versions, works, sidecars, texts):
    """Versions with work fields, sidecar and raw text, all left joins: what is missing is null. texts: (version_id, raw_path, raw_sha256, raw)."""
    rows = select.with_works(versions, works)
    side = sidecars.select("version_id", "acquired_at_utc", "artifacts")
    return rows.join(side, "version_id", "left").join(texts, "version_id", "left")


def marked_texts(versions, works, sidecars, texts):
    """(documents, rejected) of texts between a start and an end marker."""
    rows = _inputs(versions, works, sidecars, texts).withColumn("__b", boilerplate.between_markers(F.col("raw")))
    reason = F.when(F.col("raw").isNull(), "missing_raw_text").when(~F.col("__b.start_marker_found"), "missing_start_marker")
    rows = rows.withColumn("reject_reason", reason).withColumn("text", F.col("__b.text"))
    details = [F.lit(True).alias("boilerplate_removed"), *[F.col(f"__b.{c}").alias(c) for c in ("start_marker_found", "end_marker_found")], F.col("__b.notices_removed").alias("leading_project_gutenberg_notes_removed"), F.col("__b.start_line").alias("start_marker_line"), F.col("__b.end_line").alias("end_marker_line")]
    return record(rows.where("reject_reason IS NULL"), details), rows.where("reject_reason IS NOT NULL").select("version_id", "reject_reason")


def scanned_texts(versions, works, sidecars, texts):
    """(documents, rejected) of scanned texts with a scanner's or library's notice at the start."""
    rows = _inputs(versions, works, sidecars, texts).withColumn("__b", boilerplate.without_scan_headers(F.col("raw"))).withColumn("text", F.col("__b.text"))
    details = [F.col("__b.boilerplate_removed").alias("boilerplate_removed"), F.col("__b.scan_notice_removed").alias("google_books_notice_removed"), F.col("__b.library_header_removed").alias("cornell_header_removed")]
    return record(rows.where("raw IS NOT NULL"), details, "djvu_txt"), rows.where("raw IS NULL").select("version_id", F.lit("missing_raw_text").alias("reject_reason"))


def book_texts(versions, works, sidecars, books):
    """(documents, rejected) of EPUB books. books: files.books() with version_id, raw_path and raw_sha256."""
    rows = _inputs(versions, works, sidecars, books.withColumnRenamed("text", "raw")).withColumn("text", F.col("raw"))
    details = [F.col(c) for c in ("spine_items_total", "spine_items_accepted", "spine_items_skipped", "spine_items_failed", "skipped_filenames")]
    reason = F.coalesce("error", F.lit("missing_raw_text"))
    return record(rows.where("raw IS NOT NULL"), details, None), rows.where("raw IS NULL").select("version_id", reason.alias("reject_reason"))


def resolved_scans(versions, scores, texts, least: int = 100):
    """(documents, rejected) in the flat shape: versions found through an archive's interface, whose scans pass the gate and are long enough, cleaned.

    texts: (source_id, text). Of versions and of scores with one source_id the last counts.
    """
    wanted = select.last_wins(versions.where((F.col("source") == "internet_archive") & (F.col("acquisition_method") == "internet_archive_api_discovery")), "source_id")
    passed = select.scan_gate(wanted, scores)
    stopped = wanted.select("version_id").join(passed.select("version_id"), "version_id", "left_anti").withColumn("reject_reason", F.lit("scan_class_reject"))
    rows = passed.join(texts.select("source_id", F.col("text").alias("raw")), "source_id", "left")
    short = rows.where(~F.coalesce(F.length("raw") >= least, F.lit(False))).select("version_id", F.lit("short_or_missing_text").alias("reject_reason"))
    rows = select.long_enough(rows, "raw", least).withColumn("text", fn.clean_scan(F.col("raw")))
    scan_class = F.col("ocr_quality_class")
    documents = rows.select(
        F.concat("version_id", F.lit("__full_text")).alias("doc_id"), "work_id", "version_id", "title", "author", "language", "source", "source_id", "source_url", "license_status",
        select.scan_tier(scan_class).alias("quality_tier"), "ocr_quality_score", "ocr_quality_class", select.eligibility(scan_class).alias("training_eligibility"), "acquisition_method", fn.char_count(F.col("text")).alias("character_count"), "text",
    )
    return documents, stopped.unionByName(short)


def totals(documents):
    """One row: records, characters, records whose boilerplate was removed and, where texts have markers, those without an end."""
    marked = "end_marker_found" in documents.schema["normalization"].dataType.names
    ends = [F.count(F.when(~F.col("normalization.end_marker_found"), 1)).alias("missing_end_markers")] if marked else []
    return documents.agg(*ends, F.count("*").alias("records"), F.coalesce(F.sum("normalization.text_char_count"), F.lit(0)).alias("chars"), F.count(F.when(F.col("normalization.boilerplate_removed"), 1)).alias("boilerplate_removed"))
