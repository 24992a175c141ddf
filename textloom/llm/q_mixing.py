"""Query of source mixing and its SQL."""

from . import mixing


def op7_mixing(spark, sf_dir: str):
    """Every document: doc_id, size, source_size, target, taken."""
    return mixing.mix_by_source(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


#: {docs}: a relation of doc_id, source and text. Targets by water level: the sources of the smallest size for their weight are full first.
MIX_SQL = r"""
sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {docs}),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w, 1.5::DOUBLE * (SELECT sum(size) FROM sizes)::DOUBLE AS total FROM by_source),
sorted AS (SELECT *, coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS full_before,
  sum(w) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS w_left FROM weighed),
level AS (SELECT max((total - full_before) / w_left) FILTER (WHERE (total - full_before) / w_left * w <= 2.0::DOUBLE * source_size) AS l FROM sorted),
targets AS (SELECT source, source_size, CASE WHEN l IS NULL OR l * w > 2.0::DOUBLE * source_size THEN 2.0::DOUBLE * source_size ELSE l * w END AS target FROM weighed, level),
planned AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS whole FROM targets),
ordered AS (SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
  coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY ('0x' || substr(md5('0:' || s.doc_id), 1, 15))::BIGINT, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source),
mix AS (SELECT doc_id, size, source_size, target, (whole + CASE WHEN before + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM ordered)"""

SQL = {"op7_mixing": "WITH " + MIX_SQL.replace("{docs}", "documents").strip() + " SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM mix"}
QUERIES = {"op7_mixing": op7_mixing}
