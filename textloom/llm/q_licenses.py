"""Query of licence scans and its SQL."""

from . import licenses


def op1_licenses(spark, sf_dir: str):
    """Every document: doc_id, licences, n_matches, best_dice."""
    return licenses.summary(licenses.scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))


_VALUES = ", ".join("({}, '{}', '{}')".format(i, a, b.replace("'", "''")) for i, (a, b) in enumerate(licenses.TEMPLATES))
_GRAMS = "list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])"

SQL = {
    "op1_licenses": rf"""
WITH n AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS norm FROM documents),
u AS (SELECT r, trim(x) AS x FROM (SELECT r, unnest(string_split(norm, chr(10))) AS x FROM n)
  UNION ALL SELECT r, replace(x, chr(10), ' ') FROM (SELECT r, unnest(regexp_split_to_array(norm, '\n *\n\s*')) AS x FROM n) WHERE contains(trim(x), chr(10))
  UNION ALL SELECT r, replace(norm, chr(10), ' ') FROM n WHERE regexp_matches(norm, '\n *\n')),
g AS (SELECT r, {_GRAMS} AS b FROM (SELECT r, regexp_split_to_array(trim(x), ' +') AS w FROM u) WHERE len(w) > 1),
t AS (SELECT licence, {_GRAMS} AS b FROM (SELECT licence, regexp_split_to_array(trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')), ' +') AS w FROM (VALUES {_VALUES}) v(i, licence, text))),
m AS (SELECT r, licence, 2.0::DOUBLE * len(list_intersect(g.b, t.b)) / (len(g.b) + len(t.b)) AS dice FROM g JOIN t ON len(g.b) BETWEEN len(t.b) * 0.6 AND len(t.b) * 1.6 WHERE 2.0::DOUBLE * len(list_intersect(g.b, t.b)) / (len(g.b) + len(t.b)) >= {licenses.THRESHOLD})
SELECT doc_id, coalesce(string_agg(DISTINCT licence, ',' ORDER BY licence), '') AS licences, count(licence)::BIGINT AS n_matches, coalesce(max(dice), 0.0)::DOUBLE AS best_dice
FROM n LEFT JOIN m USING (r) GROUP BY r, doc_id"""
}
QUERIES = {"op1_licenses": op1_licenses}
