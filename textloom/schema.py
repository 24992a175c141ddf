"""Entities and policies."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

WORKS = "work_id STRING, author STRING, title STRING, period STRING, quality_tier STRING, status STRING, candidate_sources ARRAY<STRING>"
VERSIONS = (
    "version_id STRING, work_id STRING, source STRING, source_id STRING, source_url STRING, title STRING, author STRING, author_metadata STRING, translator STRING, editor STRING, "
    "language STRING, source_release_date STRING, publication_year INT, license_status STRING, license_rationale STRING, acquisition_method STRING, resolution_confidence STRING"
)
ARTIFACT = "format STRING, source_url STRING, raw_path STRING, status STRING, error STRING, http_status INT, content_type STRING, content_length_header STRING, byte_count BIGINT, sha256 STRING"
SIDECAR = f"version_id STRING, work_id STRING, source STRING, source_id STRING, source_url STRING, license_status STRING, license_rationale STRING, acquired_at_utc STRING, manifest_record STRUCT<{VERSIONS.replace(' ', ': ').replace(',:', ',')}>, artifacts ARRAY<STRUCT<{ARTIFACT.replace(' ', ': ').replace(',:', ',')}>>"
TOKEN_COUNTS = (
    "doc_id STRING, work_id STRING, version_id STRING, author STRING, title STRING, period STRING, language STRING, source STRING, quality_tier STRING, target_family STRING, backend STRING, model_id STRING, "
    "tokenizer STRING, tokenizer_version STRING, processor_revision STRING, context_length INT, add_special_tokens BOOLEAN, plain_text_tokenization BOOLEAN, chat_template_applied BOOLEAN, enable_thinking BOOLEAN, "
    "token_count BIGINT, char_count BIGINT, counted_at_utc STRING"
)

# Tiers in order, weights of a training export, and which licences it includes.
TIERS = ("tier_1_canonical_primary", "tier_2_major_primary", "tier_3_secondary", "tier_4_ocr_expansion")
UNKNOWN_TIER = 99
TIER_WEIGHTS = dict(zip(TIERS, (1.0, 0.8, 0.6, 0.2)))
SOURCE_WEIGHTS = {"project_gutenberg": 1.0, "standard_ebooks": 1.0, "internet_archive": 0.8, "lane_b": 0.6}
INCLUDE, REVIEW, EXCLUDE = "include", "review", "exclude"
REQUIRED = ("version_id", "source_id", "source_url", "license_rationale")
PART_OR_VOLUME = r"(?i)\b(?:vol\.?|volume|part|book)\b"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def tier_rank(tier, tiers=TIERS):
    """0 for the best tier; a null or unknown one comes last."""
    out = F.lit(UNKNOWN_TIER)
    for i, name in reversed(list(enumerate(tiers))):
        out = F.when(tier == name, i).otherwise(out)
    return out


def inclusion(value):
    """A policy's true, false or review, however it is written, as include, exclude or review; anything else is reviewed."""
    text = F.lower(value.cast("string"))
    return F.when(text.isin("true", "include"), INCLUDE).when(text.isin("false", "exclude"), EXCLUDE).otherwise(REVIEW)
