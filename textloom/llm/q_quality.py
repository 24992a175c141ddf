"""Query of the quality classifier."""

from . import quality


def op9_quality(spark, sf_dir: str):
    """Every document scored: doc_id, held_out, score, predicted."""
    return quality.predict(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op9_quality": op9_quality}
