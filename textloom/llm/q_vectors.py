"""Queries of both vector searches and their SQL."""

from . import ann, cover_tree


def op3_ann(spark, sf_dir: str):
    """20 near vectors of each vec_id divisible by 20: query_id, rank, vec_id, score."""
    return ann.neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_top_k(spark, sf_dir: str):
    """The 20 highest integer inner products of each vec_id divisible by 20: query_id, rank, vec_id, score."""
    from pyspark.sql import functions as F

    found = cover_tree.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), value=cover_tree.quantised(64))
    return found.withColumn("score", F.col("score").cast("bigint"))


SQL = {
    "op8_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20"""
}
QUERIES = {"op3_ann": op3_ann, "op8_top_k": op8_top_k}
