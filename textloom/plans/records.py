"""Queries over files, normalized records, audits and scans, each with its SQL; they join the catalogue's.

What the driver's tables lack stands on their properties: a document has a sidecar or a file if it has a label, its
text is missing where its source is src2, and has no start marker where its language is fr.
"""

from pyspark.sql import functions as F

from textloom.functions import boilerplate, scan_quality
from textloom.functions import text as fn
from textloom.operators import acquire, export, select, tokens
from textloom.plans import normalize
from textloom.plans.catalogue import _S, _SCORE, _STRIP, _scored, _tidy, _tokens, documents, query, table
from textloom.schema import TIERS, TOKEN_COUNTS
from textloom.sources import files, jsonl, parquet
from textloom.store import new_path

# --- files -----------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, lang, NULL::VARCHAR AS nothing, sha256(text) AS digest FROM documents")
def json_lines_round_trip(spark, sf_dir):
    """Documents written as JSON lines and read by a strict schema."""
    path = new_path(spark, "json-lines")
    jsonl.write(table(spark, sf_dir, "documents").select("doc_id", "lang", "text", F.lit(None).cast("string").alias("nothing")), path)
    return jsonl.read(spark, path, "doc_id BIGINT, lang STRING, text STRING, nothing STRING").select("doc_id", "lang", "nothing", F.sha2("text", 256).alias("digest"))


@query("""SELECT line, problem FROM (SELECT CASE lang WHEN 'de' THEN '{"version_id":"' || doc_id || '"' WHEN 'fr' THEN '{"version_id":"","text":"' || doc_id || '"}' WHEN 'es' THEN '{"version_id":"' || doc_id || '"}' ELSE '{"version_id":"' || doc_id || '","text":"x"}' END AS line,
  CASE lang WHEN 'de' THEN 'not a JSON object' WHEN 'fr' THEN 'no version_id' WHEN 'es' THEN 'no key text' END AS problem FROM documents) WHERE problem IS NOT NULL""")
def json_line_problems(spark, sf_dir):
    """Lines by language: broken, without a version, without a text, and good ones."""
    path, id_ = new_path(spark, "json-problems"), F.col("doc_id").cast("string")
    whole = F.concat(F.lit('{"version_id":"'), id_, F.lit('"'))
    line = F.when(F.col("lang") == "de", whole).when(F.col("lang") == "fr", F.concat(F.lit('{"version_id":"","text":"'), id_, F.lit('"}'))).when(F.col("lang") == "es", F.concat(whole, F.lit("}"))).otherwise(F.concat(whole, F.lit(',"text":"x"}')))
    table(spark, sf_dir, "documents").select(line.alias("value")).write.text(path)
    return jsonl.problems(spark, path, "version_id STRING, text STRING")


_REASONS = "CASE WHEN length(text) < 300 THEN 'short text' WHEN lang = 'fr' THEN 'french' END"


@query(f"SELECT doc_id, {_REASONS} AS reject_reason FROM documents WHERE {_REASONS} IS NOT NULL")
def rejected_by_reason(spark, sf_dir):
    """Rejected documents, written to a folder for each reason and read again."""
    path = new_path(spark, "rejected")
    jsonl.write_rejected(table(spark, sf_dir, "documents").select("doc_id", F.expr(_REASONS).alias("reject_reason")).where("reject_reason IS NOT NULL"), path)
    return spark.read.schema("doc_id BIGINT, reject_reason STRING").json(path)


@query(f"SELECT doc_id::VARCHAR AS doc_id, source, {_tokens('text')} AS token_count, length(text)::BIGINT AS char_count, NULL::INT AS context_length, false AS chat_template_applied FROM documents")
def token_counts_parquet(spark, sf_dir):
    """Count records, written by their schema in the order of sources, and read again."""
    path = new_path(spark, "token-counts")
    parquet.write(tokens.count_records(documents(spark, sf_dir)), path, TOKEN_COUNTS, order=("source", "doc_id"))
    return parquet.read(spark, path, TOKEN_COUNTS).select("doc_id", "source", "token_count", "char_count", "context_length", "chat_template_applied")


@query("SELECT 'source=' || source AS source_id, doc_id FROM documents")
def text_files(spark, sf_dir):
    """Files of lines in a folder for each source, read as texts and taken apart again."""
    path = new_path(spark, "text-files")
    table(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("value")).write.partitionBy("source").text(path)
    lines = files.texts(spark, path).select("source_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.where("line != ''").select("source_id", F.col("line").cast("bigint").alias("doc_id"))


def _as_files(spark, sf_dir):
    content = F.encode("text", "UTF-8")
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("raw/"), F.col("doc_id").cast("string")).alias("path"), F.octet_length(content).cast("bigint").alias("length"), content.alias("content"))


@query("SELECT 'raw/' || doc_id AS path, octet_length(encode(text))::BIGINT AS byte_count, sha256(text) AS sha256 FROM documents")
def file_fingerprints(spark, sf_dir):
    return files.fingerprints(_as_files(spark, sf_dir))


@query("SELECT doc_id, sha256(text || chr(65533)) AS digest FROM documents")
def decoded_bytes(spark, sf_dir):
    """Texts between a byte order mark and a byte that UTF-8 doesn't know."""
    content = F.concat(F.unhex(F.lit("EFBBBF")), F.col("content"), F.unhex(F.lit("FF")))
    return _as_files(spark, sf_dir).select("doc_id", F.sha2(files.decoded(content), 256).alias("digest"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_files(spark, sf_dir):
    name = F.concat(F.lit("raw/"), F.col("doc_id").cast("string"))
    manifest = table(spark, sf_dir, "documents").select("doc_id", name.alias("raw_path"))
    return files.missing_files(manifest, table(spark, sf_dir, "labels").select(name.alias("path"))).select("doc_id")


# --- acquisition -----------------------------------------------------------------------------------------------------


def _planned(spark, sf_dir):
    return acquire.plan(documents(spark, sf_dir), "project_gutenberg")


def _present(spark, sf_dir):
    """The text file of each label's document."""
    id_ = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "labels").select(F.concat(F.lit("raw/pg_"), id_, F.lit("_"), id_).alias("folder"), F.concat(id_, F.lit(".txt")).alias("filename")).distinct()


_LABELLED = "doc_id IN (SELECT doc_id FROM labels)"


@query(f"SELECT 2 * count(*) AS planned, count(*) AS folders, count(*) FILTER ({_LABELLED}) AS found, (2 * count(*) - count(*) FILTER ({_LABELLED}))::BIGINT AS missing FROM documents")
def acquisition_audit(spark, sf_dir):
    return acquire.audit(_planned(spark, sf_dir), _present(spark, sf_dir))


@query(f"SELECT doc_id::VARCHAR AS version_id, f AS format FROM documents, (VALUES ('txt'), ('epub')) v(f) WHERE NOT (f = 'txt' AND {_LABELLED})")
def still_to_fetch(spark, sf_dir):
    return acquire.to_fetch(_planned(spark, sf_dir), _present(spark, sf_dir)).select("version_id", "format")


@query("SELECT doc_id::VARCHAR AS version_id, 'https://archive.org/download/' || doc_id || '/' || doc_id || '_djvu.txt' AS url, 'raw/ia_' || doc_id || '_' || doc_id AS folder, doc_id || '.txt' AS filename FROM documents")
def acquisition_plan_scans(spark, sf_dir):
    """The plan of another source, with one format."""
    return acquire.plan(documents(spark, sf_dir), "internet_archive").drop("format")


@query("SELECT status, count(*) AS n, coalesce(sum(byte_count), 0)::BIGINT AS bytes FROM (SELECT CASE quality WHEN 1 THEN 'downloaded' WHEN 0 THEN 'skipped_existing' ELSE 'failed' END AS status, CASE WHEN quality = 1 THEN octet_length(encode(text)) END AS byte_count FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY status")
def acquisition_outcomes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("b")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return acquire.outcomes(d.select(F.when(F.col("quality") == 1, "downloaded").when(F.col("quality") == 0, "skipped_existing").otherwise("failed").alias("status"), F.when(F.col("quality") == 1, F.col("b")).alias("byte_count")))


# --- selection and texts ---------------------------------------------------------------------------------------------


@query("SELECT doc_id, length(text)::BIGINT AS chars FROM documents WHERE length(text) >= 300")
def long_enough_texts(spark, sf_dir):
    return select.long_enough(table(spark, sf_dir, "documents"), least=300).select("doc_id", fn.char_count(F.col("text")).alias("chars"))


@query("SELECT doc_id, source, lang FROM documents")
def without_internal_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.col("text").alias("_dedup_text"), F.lit(1).alias("_dedup_rank"))
    return select.without_internal(rows)


@query("SELECT d.doc_id, p.page_id IS NOT NULL AS has_text, sha256(p.html) AS digest FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id")
def manifest_with_texts(spark, sf_dir):
    """Documents as a manifest, pages as its texts; and the rows without one."""
    texts = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    found, missing = export.with_texts(table(spark, sf_dir, "documents").select("doc_id"), texts)
    return found.select("doc_id", F.lit(True).alias("has_text"), F.sha2("text", 256).alias("digest")).unionByName(missing.select("doc_id", F.lit(False).alias("has_text"), F.lit(None).cast("string").alias("digest")))


@query(f"SELECT doc_id, sha256({_tidy('text')}) AS digest, lang IN ('en', 'fr') AS scan_notice_removed, lang IN ('en', 'de') AS library_header_removed FROM documents")
def scan_notices(spark, sf_dir):
    """A scanning notice, a library's header, both or none."""
    scan = "This is a digital copy of a book that was preserved\nand can be found at http://books.google.com/\n\n"
    library = "The original of this book is in\nthe Library.\nhttp://www.archive.org/details/abc123 \n\n"
    raw = F.concat(F.when(F.col("lang").isin("en", "fr"), scan).otherwise(""), F.when(F.col("lang").isin("en", "de"), library).otherwise(""), "text")
    b = table(spark, sf_dir, "documents").select("doc_id", boilerplate.without_scan_headers(raw).alias("b"))
    return b.select("doc_id", F.sha2("b.text", 256).alias("digest"), "b.scan_notice_removed", "b.library_header_removed")


@query(f"SELECT doc_id, sha256({_tidy('text')}) AS digest, CASE lang WHEN 'en' THEN 2 WHEN 'de' THEN 1 ELSE 0 END AS notices_removed FROM documents")
def asterisk_notices(spark, sf_dir):
    """A notice between lines of asterisks, after it a credit, one of them or none."""
    stars, credit = "*" * 40 + "\nThis edition was made from another one.\n" + "*" * 40 + "\n\n", "E-text prepared by someone\n\n\n"
    notices = F.when(F.col("lang") == "en", stars + credit).when(F.col("lang") == "de", stars).otherwise("")
    raw = F.concat(F.lit("*** START OF THE PROJECT GUTENBERG EBOOK A BOOK ***\n\n"), notices, "text")
    return table(spark, sf_dir, "documents").select("doc_id", boilerplate.between_markers(raw).alias("b")).select("doc_id", F.sha2("b.text", 256).alias("digest"), "b.notices_removed")


# --- scans -----------------------------------------------------------------------------------------------------------

_SHARES = {"printable_ratio": "p", "alpha_ratio": "a", "weird_char_ratio": "w", "long_token_ratio": "l", "common_word_ratio": "c", "hyphen_break_rate": "h", "short_line_ratio": "s"}


@query(f"WITH {_SCORE} SELECT doc_id, {', '.join(f'round_even({c}, 4) AS {name}' for name, c in _SHARES.items())} FROM f")
def ocr_ratios(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", *scan_quality.RATIOS)


_TIER_OF = f"CASE WHEN ocr_quality_class = 'ocr_bronze' THEN '{TIERS[-1]}' ELSE '{TIERS[0]}' END"
_ELIGIBLE = "CASE WHEN ocr_quality_class = 'ocr_bronze' THEN 'retrieval_only' ELSE 'training_candidate' END"


@query(f"WITH {_SCORE} SELECT doc_id, {_TIER_OF} AS quality_tier, {_ELIGIBLE} AS training_eligibility FROM y")
def scan_tiers(spark, sf_dir):
    c = F.col("ocr_quality_class")
    return _scored(spark, sf_dir).select("doc_id", select.scan_tier(c).alias("quality_tier"), select.eligibility(c).alias("training_eligibility"))


def _resolved(spark, sf_dir):
    d, none = documents(spark, sf_dir), F.lit(None).cast("string")
    found = F.when(F.col("language") == "es", "by_hand").otherwise("internet_archive_api_discovery")
    versions = d.select("_ord", "version_id", "work_id", "title", "author", "language", F.lit("internet_archive").alias("source"), "source_id", none.alias("source_url"), none.alias("license_status"), found.alias("acquisition_method"))
    scores = _scored(spark, sf_dir).select(F.col("doc_id").cast("string").alias("source_id"), F.col("doc_id").alias("_ord"), "ocr_quality_score", "ocr_quality_class")
    return normalize.resolved_scans(versions, scores, d.select("source_id", "text"), least=300)


_CLEAN = rf"""nfc_normalize(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\n{{3,}}', chr(10) || chr(10), 'g'), '(?m)^[ \t]*[\p{{Nd}}\-—–]+[ \t]*$', '', 'g'),
  '[{_S}]+([.,:;!?])', '\1', 'g'), '([.,:;!?])[{_S}]+', '\1 ', 'g'), ' +', ' ', 'g'), '\n +', chr(10), 'g'), '{_STRIP}', '', 'g'))"""


@query(f"""WITH {_SCORE} SELECT doc_id || '__full_text' AS doc_id, source AS work_id, {_TIER_OF} AS quality_tier, ocr_quality_class, {_ELIGIBLE} AS training_eligibility, length({_CLEAN})::BIGINT AS character_count, sha256({_CLEAN}) AS digest
  FROM documents JOIN y USING (doc_id) WHERE lang <> 'es' AND ocr_quality_class <> 'reject' AND length(text) >= 300""")
def resolved_scan_documents(spark, sf_dir):
    rows = _resolved(spark, sf_dir)[0]
    return rows.select("doc_id", "work_id", "quality_tier", "ocr_quality_class", "training_eligibility", F.col("character_count").cast("bigint").alias("character_count"), F.sha2("text", 256).alias("digest"))


@query(f"WITH {_SCORE} SELECT doc_id::VARCHAR AS version_id, CASE WHEN ocr_quality_class = 'reject' THEN 'scan_class_reject' ELSE 'short_or_missing_text' END AS reject_reason FROM documents JOIN y USING (doc_id) WHERE lang <> 'es' AND (ocr_quality_class = 'reject' OR length(text) < 300)")
def resolved_scan_rejects(spark, sf_dir):
    return _resolved(spark, sf_dir)[1]


# --- normalized records ----------------------------------------------------------------------------------------------


def _marked(spark, sf_dir):
    d, none = documents(spark, sf_dir), F.lit(None).cast("string")
    empty = [none.alias(c) for c in ("author_metadata", "editor", "source_url", "source_release_date", "license_status", "license_rationale", "acquisition_method")]
    versions = d.select("version_id", "work_id", F.when(F.col("language") != "de", F.col("title")).alias("title"), "translator", "language", "source", "source_id", F.lit("high").alias("resolution_confidence"), *empty)
    works = d.groupBy("work_id").agg(F.min("author").alias("author"), F.min("source").alias("title"), F.max("language").alias("period"), F.lit(TIERS[0]).alias("quality_tier"), F.max("_ord").alias("_ord"))
    id_ = F.col("doc_id").cast("string")
    artifact = lambda format: F.struct(F.lit(format).alias("format"), F.concat(F.lit(f"http://{format}/"), id_).alias("source_url"))
    sidecars = table(spark, sf_dir, "labels").select(id_.alias("version_id"), F.lit("2026-01-01T00:00:00Z").alias("acquired_at_utc"), F.array(artifact("epub"), artifact("txt"), artifact("txt")).alias("artifacts"))
    start = F.when(F.col("language") != "fr", "*** START OF THE PROJECT GUTENBERG EBOOK X ***\n\n").otherwise("")
    end = F.when(F.col("language") != "en", "\n\n*** END OF THE PROJECT GUTENBERG EBOOK X ***\n").otherwise("")
    texts = d.where("source <> 'src2'").select("version_id", F.concat(F.lit("raw/"), "version_id").alias("raw_path"), F.sha2("text", 256).alias("raw_sha256"), F.concat(start, "text", end).alias("raw"))
    return normalize.marked_texts(versions, works, sidecars, texts)


_BODY = _tidy("text")
_RECORDS = "FROM documents d JOIN (SELECT source, max(lang) AS period FROM documents GROUP BY source) USING (source) WHERE source <> 'src2' AND lang <> 'fr'"


@query(f"""SELECT doc_id || '__full_text' AS doc_id, source AS work_id, coalesce(CASE WHEN lang <> 'de' THEN nullif(substr(string_split(text, chr(10))[1], 1, 40), '') END, source) AS title, 'author of ' || source AS author, period, '{TIERS[0]}' AS quality_tier,
  'raw/' || doc_id AS raw_path, sha256(text) AS raw_sha256, CASE WHEN {_LABELLED} THEN 'http://txt/' || doc_id END AS artifact_url, lang <> 'en' AS end_marker_found, length({_BODY})::BIGINT AS text_char_count, sha256({_BODY}) AS digest, doc_id::VARCHAR AS manifest_version {_RECORDS}""")
def normalized_records(spark, sf_dir):
    rows = _marked(spark, sf_dir)[0]
    return rows.select(
        "doc_id", "work_id", F.col("hierarchy.work").alias("title"), "author", "period", "quality_tier", "raw.raw_path", "raw.raw_sha256", F.col("raw.source_artifact_url").alias("artifact_url"), "normalization.end_marker_found",
        F.col("normalization.text_char_count").cast("bigint").alias("text_char_count"), F.sha2("text", 256).alias("digest"), F.col("manifest_record.version_id").alias("manifest_version"),
    )


@query("SELECT doc_id::VARCHAR AS version_id, CASE WHEN source = 'src2' THEN 'missing_raw_text' ELSE 'missing_start_marker' END AS reject_reason FROM documents WHERE source = 'src2' OR lang = 'fr'")
def normalized_rejects(spark, sf_dir):
    return _marked(spark, sf_dir)[1]


@query(f"SELECT count(*) FILTER (lang = 'en') AS missing_end_markers, count(*) AS records, coalesce(sum(length({_BODY})), 0)::BIGINT AS chars, count(*) AS boilerplate_removed {_RECORDS}")
def normalized_totals(spark, sf_dir):
    return normalize.totals(_marked(spark, sf_dir)[0])
