"""Query of MinHash near-dedup and its SQL."""

from . import near_dedup


def op5_near_dedup(spark, sf_dir: str):
    """Every document: doc_id, n_shingles, component_id, kept; 3-word shingles, links from 85 in 100."""
    return near_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, num=85, den=100)


#: Documents of one set are one node; nodes meet by shared shingles, and links are followed to their end.
SQL = {
    "op5_near_dedup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END) AS s FROM w),
k AS (SELECT min(doc_id) AS k, s, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
g AS (SELECT k, n, unnest(s) AS g FROM k),
often AS (SELECT g FROM g GROUP BY g HAVING count(*) > 1),
r AS (SELECT g.* FROM g SEMI JOIN often USING (g)),
links AS (SELECT a.k AS a, b.k AS b FROM r a JOIN r b ON a.g = b.g AND a.k < b.k AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, x.b FROM reach JOIN both_ways x ON reach.b = x.a),
smallest AS (SELECT k.s, least(k.k, coalesce(min(reach.b), k.k)) AS c FROM k LEFT JOIN reach ON k.k = reach.a GROUP BY k.s, k.k)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id, doc_id = coalesce(c, doc_id) AS kept FROM s LEFT JOIN smallest USING (s)"""
}
QUERIES = {"op5_near_dedup": op5_near_dedup}
