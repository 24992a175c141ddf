"""Query of the toxicity classifier."""

from . import toxicity


def op4_toxicity(spark, sf_dir: str):
    """Every document scored: doc_id, held_out, score, predicted."""
    return toxicity.predict(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op4_toxicity": op4_toxicity}
