"""Query of line dedup."""

from . import line_dedup


def op2_line_dedup(spark, sf_dir: str):
    """Every document: doc_id, n_removed, removed_words, spans, text (without repeated runs of 50 words or more)."""
    return line_dedup.report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_line_dedup": op2_line_dedup}
