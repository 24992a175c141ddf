"""Queries over the driver's tables, each with its SQL.

`documents` stands for a manifest and its texts: doc_id for a version, source for a source and a work, lang for a
language. Fixtures of rows that the tables don't have are given as values, on both sides.
"""

from pyspark.sql import functions as F

from textloom.functions import boilerplate, markup, scan_quality
from textloom.functions import text as fn
from textloom.operators import acquire, dedup, export, rollup, segment, select, tokens
from textloom.schema import SOURCE_WEIGHTS, TIER_WEIGHTS, TIERS

QUERIES, SQL = {}, {}

#: White space as RE2 spells it.
_S = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_STRIP = rf"^[{_S}]+|[{_S}]+$"


def _canonical(x):
    return rf"replace(lower(regexp_replace(regexp_replace({x}, '[{_S}]+', ' ', 'g'), '{_STRIP}', '', 'g')), 'ß', 'ss')"


def _tokens(x):
    return rf"len(regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_S}]'))::BIGINT"


def _tidy(x):
    in_line = _S.replace(r"\x09-\x0D", r"\x09\x0B-\x0D")
    return rf"regexp_replace(regexp_replace(regexp_replace(nfc_normalize({x}), '[{in_line}]+(\n|$)', '\1', 'g'), '{_STRIP}', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    """documents in the shape of normalized documents."""
    d = table(spark, sf_dir, "documents")
    none = F.lit(None).cast("string")
    title = F.substring(F.split("text", "\n", 2)[0], 1, 40)
    tier = F.when(F.pmod("doc_id", F.lit(5)) < 4, F.try_element_at(F.array(*[F.lit(t) for t in TIERS]), (F.pmod("doc_id", F.lit(5)) + 1).cast("int")))
    return d.select(
        F.col("doc_id").alias("_ord"), F.col("doc_id").cast("string").alias("doc_id"), F.col("doc_id").cast("string").alias("version_id"), F.col("source").alias("work_id"), "source", F.col("doc_id").cast("string").alias("source_id"),
        F.col("lang").alias("language"), F.concat(F.lit("author of "), "source").alias("author"), title.alias("title"), F.when(F.pmod("doc_id", F.lit(3)) == 0, F.col("lang")).otherwise(none).alias("translator"), tier.alias("quality_tier"),
        F.when(F.pmod("doc_id", F.lit(4)) != 0, F.col("lang")).alias("period"), "text",
    )


_TIER_SQL = "[" + ", ".join(f"'{t}'" for t in TIERS) + "][(doc_id % 5 + 1)::INT]"
_DOCS = f"""d AS (SELECT doc_id AS _ord, doc_id::VARCHAR AS version_id, source AS work_id, source, doc_id::VARCHAR AS source_id, lang AS language, 'author of ' || source AS author,
  substr(string_split(text, chr(10))[1], 1, 40) AS title, CASE WHEN doc_id % 3 = 0 THEN lang END AS translator, CASE WHEN doc_id % 5 < 4 THEN {_TIER_SQL} END AS quality_tier, CASE WHEN doc_id % 4 <> 0 THEN lang END AS period, text FROM documents)"""
_RANK = "CASE quality_tier " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TIERS)) + " ELSE 99 END"


# --- selection -------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, source, lang FROM documents WHERE source = 'src1' AND lang = 'en'")
def select_by_source_lang(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("lang").alias("resolution_confidence"))
    return select.selected(rows, "src1", confidence="en").withColumnRenamed("resolution_confidence", "lang")


@query("SELECT doc_id FROM documents WHERE doc_id IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 987654321)")
def id_in_list(spark, sf_dir):
    ids = [str(i) for i in (1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 987654321)]
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("version_id"), F.lit("any").alias("source"), F.lit(select.CONFIDENCE).alias("resolution_confidence"))
    return select.selected(rows, "any", ids).select("doc_id")


@query("SELECT * FROM (VALUES (1::BIGINT), (2), (987654321), (987654322)) v(doc_id) WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def missing_ids(spark, sf_dir):
    asked = spark.createDataFrame([(1,), (2,), (987654321,), (987654322,)], "doc_id bigint")
    return select.missing_ids(asked, table(spark, sf_dir, "documents"), "doc_id")


_MANIFEST = [("v1", "1", "http://a", "pd"), ("v2", "", "http://b", "pd"), ("v3", "0", "http://c", None), ("", None, "http://d", "pd")]
_MANIFEST_SQL = "(VALUES ('v1', '1', 'http://a', 'pd'), ('v2', '', 'http://b', 'pd'), ('v3', '0', 'http://c', NULL), ('', NULL, 'http://d', 'pd')) v(version_id, source_id, source_url, license_rationale)"


@query(" UNION ALL ".join(f"SELECT version_id, '{c}' AS field FROM {_MANIFEST_SQL} WHERE coalesce({c}, '') IN ('', '0')" for c in ("version_id", "source_id", "source_url", "license_rationale")))
def required_field_violations(spark, sf_dir):
    return select.violations(spark.createDataFrame(_MANIFEST, "version_id string, source_id string, source_url string, license_rationale string"))


@query("SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 25")
def first_n_manifest_order(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("doc_id").alias("_ord"))
    return select.first_rows(rows, 25).drop("_ord")


# --- joins -----------------------------------------------------------------------------------------------------------


@query("SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def doc_label_left_join(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "quality", "toxic")


@query("SELECT doc_id, 'left' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'right' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def id_mismatch(spark, sf_dir):
    return select.id_mismatch(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("SELECT conv_id, role, sha256(text) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations) WHERE n = 1")
def last_wins_lookup(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumnRenamed("turn", "_ord")
    return select.last_wins(rows, "conv_id").select("conv_id", "role", F.sha2("text", 256).alias("digest"))


@query("SELECT l.doc_id, d.source FROM labels l LEFT JOIN documents d USING (doc_id) WHERE l.quality = 1")
def scan_gate(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("source_id"), F.col("doc_id").alias("_ord"), F.lit(0.0).alias("ocr_quality_score"), F.when(F.col("quality") == 0, "reject").otherwise("ocr_gold").alias("ocr_quality_class"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), "source")
    return select.scan_gate(docs.join(labels.select("source_id"), "source_id", "left_semi"), labels).select(F.col("source_id").alias("doc_id"), "source")


@query("""WITH works AS (SELECT source AS work_id, max(doc_id)::VARCHAR AS title, min(lang) AS period FROM documents WHERE source <> 'src3' GROUP BY source)
SELECT d.doc_id, w.title, w.period FROM documents d LEFT JOIN works w ON d.source = w.work_id""")
def version_work_join(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    works = d.where("source != 'src3'").groupBy(F.col("source").alias("work_id")).agg(F.max("doc_id").cast("string").alias("title"), F.min("lang").alias("period"), F.lit(None).cast("string").alias("author"), F.lit(None).cast("string").alias("quality_tier"), F.max("doc_id").alias("_ord"))
    versions = d.select("doc_id", F.col("source").alias("work_id"), F.lit("").alias("title"))
    return select.with_works(versions, works).select("doc_id", "title", "period")


# --- dedup -----------------------------------------------------------------------------------------------------------


def _hashed(spark, sf_dir):
    return dedup.with_digests(documents(spark, sf_dir))


_HASHED = _DOCS + f", h AS (SELECT *, sha256(text) AS text_sha256, sha256({_canonical('text')}) AS canonical_text_sha256, {_RANK} AS rank FROM d)"
_KEEPER = _HASHED + ", k AS (SELECT *, first_value(version_id) OVER w AS keeper, row_number() OVER w = 1 AS kept, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM h WINDOW w AS (PARTITION BY text_sha256 ORDER BY rank, author, work_id, source_id, version_id, _ord))"


@query(f"WITH {_KEEPER} SELECT version_id, text_sha256, keeper, kept, group_size FROM k")
def exact_dedup_keeper(spark, sf_dir):
    return dedup.exact_decisions(_hashed(spark, sf_dir)).drop("_ord")


@query(f"WITH {_HASHED} SELECT text_sha256 AS hash, count(*) AS size, string_agg(version_id, ',' ORDER BY rank, author, work_id, source_id, version_id) AS members FROM h GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, sf_dir):
    return dedup.groups(_hashed(spark, sf_dir), "text_sha256").withColumn("members", F.array_join("members", ","))


@query("""WITH f AS (SELECT text FROM documents UNION ALL SELECT upper(text) FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT replace(text, chr(10), '  ') || ' ' FROM documents WHERE doc_id % 10 = 5)
SELECT hash, count(*) AS size, count(DISTINCT text) AS texts FROM (SELECT text, sha256(""" + _canonical("text") + """) AS hash FROM f) GROUP BY hash HAVING count(*) > 1 AND count(DISTINCT text) > 1""")
def canonical_dup_groups(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select("doc_id", "text")
    more = t.where("doc_id % 10 = 0").select(F.upper("text").alias("text")).unionAll(t.where("doc_id % 10 = 5").select(F.concat(F.replace("text", F.lit("\n"), F.lit("  ")), F.lit(" "))))
    return dedup.canonical_review(dedup.with_digests(t.select("text").unionAll(more)))


@query(f"WITH {_KEEPER} SELECT count(*) AS records, count(DISTINCT version_id) AS unique_doc_ids, count(DISTINCT version_id) AS unique_version_ids, 0::BIGINT AS exact_duplicate_hash_groups, count(*) AS records_with_dedup_metadata FROM k WHERE kept")
def dedup_validation(spark, sf_dir):
    return dedup.validation(dedup.deduplicate(documents(spark, sf_dir), separator="\n")[0])


_CLUSTERS = rf""", c AS (SELECT work_id, language, count(*) AS size, count(DISTINCT coalesce(translator, '')) AS translators, count(DISTINCT CASE WHEN title <> '' THEN {_canonical('title')} END) AS titles,
  bool_or(regexp_matches(title, '(?i)\b(vol\.?|volume|part|book)\b')) AS part FROM k WHERE kept GROUP BY work_id, language HAVING count(*) > 1),
r AS (SELECT work_id, language, size, CASE WHEN part AND translators <= 1 THEN 'multi_part_or_volume_candidate' WHEN part THEN 'multi_part_or_volume_with_translator_variance' WHEN translators > 1 THEN 'alternate_translation_or_scope_candidate'
  WHEN titles <= 1 THEN 'alternate_edition_candidate' ELSE 'same_work_alternate_candidate' END AS relation FROM c)"""


@query(f"WITH {_KEEPER}{_CLUSTERS} SELECT * FROM r")
def same_work_clusters(spark, sf_dir):
    hashed = _hashed(spark, sf_dir)
    kept = dedup.exact_decisions(hashed).where("kept").select("_ord")
    return dedup.clusters(hashed.join(kept, "_ord"))


_PARAGRAPHS = f""", n AS (SELECT _ord, count(DISTINCT sha256(c))::INT AS paragraph_hash_count FROM (SELECT _ord, {_canonical('p')} AS c FROM (SELECT _ord, unnest(string_split(text, chr(10))) AS p FROM k WHERE kept)) WHERE length(c) >= 80 GROUP BY _ord),
g AS (SELECT text_sha256, string_agg(version_id, ',' ORDER BY rank, author, work_id, source_id, version_id) AS gone FROM k WHERE NOT kept GROUP BY text_sha256)"""


@query(f"""WITH {_KEEPER}{_CLUSTERS}{_PARAGRAPHS} SELECT version_id, CASE WHEN group_size > 1 THEN 'accepted_exact_duplicate_keeper' ELSE 'accepted_unique' END AS status, k.text_sha256, canonical_text_sha256,
  coalesce(paragraph_hash_count, 0) AS paragraph_hash_count, coalesce(gone, '') AS exact_duplicate_version_ids, relation IS NOT NULL AS same_work_review, relation AS same_work_relation, coalesce(size, 1)::INT AS same_work_cluster_size
  FROM k LEFT JOIN r USING (work_id, language) LEFT JOIN n USING (_ord) LEFT JOIN g ON g.text_sha256 = k.text_sha256 WHERE kept""")
def deduplication_records(spark, sf_dir):
    kept = dedup.deduplicate(documents(spark, sf_dir), separator="\n")[0].select("version_id", "deduplication.*")
    return kept.withColumn("exact_duplicate_version_ids", F.array_join("exact_duplicate_version_ids", ","))


@query(f"WITH {_KEEPER} SELECT version_id, 'exact_duplicate' AS reject_reason, keeper FROM k WHERE NOT kept")
def rejected_duplicates(spark, sf_dir):
    return dedup.deduplicate(documents(spark, sf_dir), separator="\n")[1].select("version_id", "reject_reason", "keeper")


_LINES = _DOCS + f""", p AS (SELECT DISTINCT version_id, work_id, language, sha256(c) AS paragraph_hash FROM (SELECT version_id, work_id, language, {_canonical('p')} AS c FROM (SELECT version_id, work_id, language, unnest(string_split(text, chr(10))) AS p FROM d)) WHERE length(c) >= 80)"""


@query(f"WITH {_LINES} SELECT version_id, count(*) AS n, min(paragraph_hash) AS first_hash FROM p GROUP BY version_id")
def paragraph_hash_count(spark, sf_dir):
    return dedup.paragraph_hashes(documents(spark, sf_dir), separator="\n").groupBy("version_id").agg(F.count("*").alias("n"), F.min("paragraph_hash").alias("first_hash"))


@query(f"""WITH {_LINES}, s AS (SELECT work_id, language, version_id, count(*) AS n FROM p GROUP BY ALL),
x AS (SELECT a.work_id, a.language, a.version_id AS a, b.version_id AS b, count(*) AS common FROM p a JOIN p b ON a.work_id = b.work_id AND a.language = b.language AND a.paragraph_hash = b.paragraph_hash AND a.version_id < b.version_id GROUP BY ALL),
m AS (SELECT x.work_id, x.language, max(common / least(s.n, t.n)) AS m FROM x JOIN s ON s.version_id = a JOIN s t ON t.version_id = b GROUP BY ALL)
SELECT g.work_id, g.language, coalesce(m, 0.0)::DOUBLE AS max_containment FROM (SELECT DISTINCT work_id, language FROM p) g LEFT JOIN m USING (work_id, language)""")
def max_containment(spark, sf_dir):
    return dedup.containment(dedup.paragraph_hashes(documents(spark, sf_dir), ("version_id", "work_id", "language"), "\n"))


@query(f"WITH {_HASHED}, s AS (SELECT DISTINCT source, canonical_text_sha256 AS c FROM h) SELECT a.source AS source_a, b.source AS source_b, count(*) AS shared FROM s a JOIN s b ON a.c = b.c AND a.source < b.source GROUP BY ALL")
def cross_source_overlap(spark, sf_dir):
    return dedup.cross_source_overlap(_hashed(spark, sf_dir))


@query(rf"""WITH t AS (SELECT min(doc_id) AS k, list_filter(regexp_split_to_array(lower(text), '[{_S}]+'), lambda w: w <> '') AS w FROM documents GROUP BY text),
s AS (SELECT DISTINCT k, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM t WHERE len(w) > 0),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k), f AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1), r AS (SELECT * FROM s SEMI JOIN f USING (g)),
x AS (SELECT a.k AS a, b.k AS b, count(*) AS c FROM r a JOIN r b ON a.g = b.g AND a.k < b.k GROUP BY ALL)
SELECT a, b, c / (m.n + o.n - c) AS jaccard FROM x JOIN n m ON m.k = a JOIN n o ON o.k = b WHERE c / (m.n + o.n - c) >= 0.8""")
def near_pairs(spark, sf_dir):
    return dedup.near_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"), hashes=48, rows=3)


# --- scan quality ----------------------------------------------------------------------------------------------------

_COMMON = ", ".join(f"'{w}'" for w in scan_quality.COMMON)
_COUNTS = rf"""q AS (SELECT doc_id, length(text)::BIGINT AS char_count, length(s)::BIGINT AS sample_char_count, len(regexp_extract_all(s, '[ \n\t\r]|[^\p{{C}}\p{{Z}}]'))::BIGINT AS printable, len(regexp_extract_all(s, '\p{{L}}'))::BIGINT AS alpha,
  len(regexp_extract_all(s, '[^\p{{L}}\p{{N}}{_S}.,;:''"!?()\-\[\]{{}}_/&%$#@*+=<>]'))::BIGINT AS weird, len(regexp_extract_all(lower(s), '[a-z]{{2,}}'))::BIGINT AS tokens, len(regexp_extract_all(lower(s), '[a-z]{{25,}}'))::BIGINT AS long_tokens,
  len(list_filter(regexp_extract_all(lower(s), '[a-z]{{2,}}'), lambda t: t IN ({_COMMON})))::BIGINT AS common_hits, len(regexp_extract_all(s, '[A-Za-z]-\n[A-Za-z]'))::BIGINT AS hyphen_breaks, (length(s) - length(replace(s, chr(10), '')) + 1)::BIGINT AS line_count,
  len(list_filter(regexp_split_to_array(s, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: length(regexp_replace(x, '{_STRIP}', '', 'g')) BETWEEN 1 AND 3))::BIGINT AS short_lines
  FROM (SELECT doc_id, text, substr(text, 1, 250000) AS s FROM documents))"""
_SCORE = _COUNTS + """, f AS (SELECT doc_id, char_count, printable / greatest(1, sample_char_count) AS p, alpha / greatest(1, sample_char_count) AS a, weird / greatest(1, sample_char_count) AS w, long_tokens / greatest(1, tokens) AS l,
  common_hits / greatest(1, tokens) AS c, hyphen_breaks / line_count AS h, short_lines / line_count AS s FROM q),
z AS (SELECT doc_id, greatest(0.0::DOUBLE, least(100.0::DOUBLE, round_even(100.0::DOUBLE - greatest(0.0::DOUBLE, 0.97::DOUBLE - p) * 160 - greatest(0.0::DOUBLE, 0.45::DOUBLE - a) * 120 - w * 500 - l * 400 - greatest(0.0::DOUBLE, 0.08::DOUBLE - c) * 250 - h * 60 - s * 40
  - CASE WHEN char_count < 5000 THEN 25.0::DOUBLE ELSE 0.0::DOUBLE END, 2))) AS ocr_quality_score FROM f),
y AS (SELECT *, CASE WHEN ocr_quality_score >= 85 THEN 'ocr_gold' WHEN ocr_quality_score >= 70 THEN 'ocr_silver' WHEN ocr_quality_score >= 50 THEN 'ocr_bronze' ELSE 'reject' END AS ocr_quality_class FROM z)"""


def _scored(spark, sf_dir):
    return scan_quality.scored(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(f"WITH {_COUNTS} SELECT * FROM q")
def ocr_counts(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", *scan_quality.COUNTS)


@query(f"WITH {_SCORE} SELECT doc_id, ocr_quality_class, floor(ocr_quality_score)::BIGINT AS whole_score FROM y")
def ocr_score(spark, sf_dir):
    # whole points: rounding at the last digit differs between engines
    return _scored(spark, sf_dir).select("doc_id", "ocr_quality_class", F.floor("ocr_quality_score").alias("whole_score"))


@query(f"WITH {_SCORE} SELECT c AS ocr_quality_class, count(ocr_quality_class) AS n FROM (VALUES ('ocr_gold'), ('ocr_silver'), ('ocr_bronze'), ('reject')) v(c) LEFT JOIN y ON c = ocr_quality_class GROUP BY c")
def ocr_class_histogram(spark, sf_dir):
    return rollup.class_histogram(_scored(spark, sf_dir))


# --- tokens and roll-ups ---------------------------------------------------------------------------------------------


def _counts(spark, sf_dir):
    return tokens.count_records(documents(spark, sf_dir), also=("_ord",))


_TOKEN_COUNTS = _DOCS + f", t AS (SELECT *, {_tokens('text')} AS token_count FROM d)"


@query(f"WITH {_TOKEN_COUNTS} SELECT version_id AS doc_id, token_count, length(text)::BIGINT AS char_count, 'regex' AS backend FROM t")
def token_count_regex(spark, sf_dir):
    return tokens.count_records(documents(spark, sf_dir)).select("doc_id", "token_count", "char_count", "backend")


@query("WITH " + _TOKEN_COUNTS + " " + " UNION ALL ".join(f"SELECT '{d}' AS dimension, {d} AS key, count(*) AS documents, sum(token_count)::BIGINT AS tokens FROM t GROUP BY {d}" for d in rollup.DIMENSIONS) + " UNION ALL SELECT 'total', NULL, count(*), sum(token_count)::BIGINT FROM t")
def tokens_rollup(spark, sf_dir):
    return rollup.sums(tokens.count_records(documents(spark, sf_dir)))


@query(f"WITH {_TOKEN_COUNTS} SELECT work_id, tokens FROM (SELECT work_id, sum(token_count)::BIGINT AS tokens, min(_ord) AS o FROM t GROUP BY work_id) ORDER BY tokens DESC, o LIMIT 10")
def top10_works(spark, sf_dir):
    return rollup.top(_counts(spark, sf_dir))


@query(f"WITH {_TOKEN_COUNTS} SELECT language, sum(token_count)::BIGINT AS tokens, sum(token_count) / (SELECT sum(token_count) FROM t) AS share FROM t GROUP BY language")
def share_of_total(spark, sf_dir):
    return rollup.shares(tokens.count_records(documents(spark, sf_dir)), "language")


@query(f"WITH {_TOKEN_COUNTS} SELECT period, {', '.join(f'sum(token_count) FILTER (language = {chr(39)}{x}{chr(39)})::BIGINT AS {x}' for x in ('de', 'en', 'es', 'fr'))}, sum(token_count)::BIGINT AS total FROM t GROUP BY period")
def period_pivot(spark, sf_dir):
    return rollup.pivot(tokens.count_records(documents(spark, sf_dir)), "period", "language", ("de", "en", "es", "fr"))


@query("""WITH l AS (SELECT lang, length(text) AS chars, CASE WHEN text = '' THEN 0 ELSE length(text) - length(replace(text, chr(10), '')) + 1 END AS lines FROM documents)
SELECT lang, count(*) AS documents, """ + ", ".join(f"sum({c})::BIGINT AS total_{c}, avg({c}) AS mean_{c}, min({c})::BIGINT AS min_{c}, quantile_cont({c}, 0.25)::DOUBLE AS p25_{c}, quantile_cont({c}, 0.5)::DOUBLE AS median_{c}, quantile_cont({c}, 0.75)::DOUBLE AS p75_{c}, max({c})::BIGINT AS max_{c}" for c in ("chars", "lines")) + " FROM l GROUP BY lang")
def line_statistics(spark, sf_dir):
    return rollup.line_statistics(table(spark, sf_dir, "documents"), ("lang",))


@query("SELECT lang, source, count(*) AS records, sum(length(text))::BIGINT AS chars, sum(octet_length(encode(text)))::BIGINT AS bytes FROM documents GROUP BY lang, source")
def status_profile(spark, sf_dir):
    return rollup.status_profile(table(spark, sf_dir, "documents"), "lang", "source")


@query(f"WITH {_DOCS} SELECT source, quality_tier, count(*) AS n FROM d GROUP BY ALL")
def source_tier_histogram(spark, sf_dir):
    return rollup.histogram(documents(spark, sf_dir), "source", "quality_tier")


@query("SELECT doc_id, length(text)::BIGINT AS chars FROM documents ORDER BY length(text), doc_id LIMIT 10")
def shortest_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", fn.char_count(F.col("text")).alias("chars")).orderBy("chars", "doc_id").limit(10)


_WANTED = [("ethics", "An author", "Ethics", "early", "t1"), ("src1", None, "src1", None, None), ("letters", None, "Letters", None, None)]
_WANTED_SQL = "(VALUES ('ethics', 'An author', 'Ethics', 'early', 't1'), ('src1', NULL, 'src1', NULL, NULL), ('letters', NULL, 'Letters', NULL, NULL)) v(work_id, author, title, period, quality_tier)"


@query(f"""WITH works AS (SELECT DISTINCT source AS work_id, 'author of ' || source AS author, source AS title, NULL::VARCHAR AS period, NULL::VARCHAR AS quality_tier FROM documents UNION ALL SELECT * FROM {_WANTED_SQL})
SELECT * FROM works WHERE work_id NOT IN (SELECT source FROM documents)""")
def coverage_gaps(spark, sf_dir):
    """Works of all documents and some wanted ones, against all documents."""
    d, none = documents(spark, sf_dir), F.lit(None).cast("string")
    works = d.select("work_id", "author", F.col("source").alias("title"), none.alias("period"), none.alias("quality_tier")).distinct()
    return rollup.coverage_gaps(works.unionAll(spark.createDataFrame(_WANTED, works.schema)), d)


@query("SELECT doc_id, length(text)::BIGINT AS chars FROM documents WHERE length(text) < 300")
def short_texts(spark, sf_dir):
    return select.short_texts(table(spark, sf_dir, "documents"), 300).select("doc_id", fn.char_count(F.col("text")).alias("chars"))


@query(f"WITH {_DOCS} SELECT 'by_source' AS kind, source AS key, count(*) AS n FROM d GROUP BY source UNION ALL SELECT 'by_quality_tier', quality_tier, count(*) FROM d GROUP BY quality_tier")
def manifest_summary(spark, sf_dir):
    return export.manifest_summary(documents(spark, sf_dir))


@query("SELECT 'regex' AS backend, 'unicode_words' AS about, count(*) AS documents, count(DISTINCT source) AS work_ids, count(DISTINCT source) AS authors FROM documents")
def tokenizer_and_works(spark, sf_dir):
    """What the first count says of its tokenizer, and how many works and authors there are."""
    counts = _counts(spark, sf_dir)
    about = rollup.tokenizer_of(counts).select("backend", F.lit("unicode_words").alias("about"))
    return about.join(F.broadcast(rollup.distinct_counts(counts)))  # broadcast: one row each


@query("""SELECT license_status, coalesce(include_by_default, 'unknown') AS include_by_default, documents, chars FROM (SELECT CASE WHEN doc_id % 11 <> 0 THEN lang END AS license_status, count(*) AS documents, sum(length(text))::BIGINT AS chars FROM documents GROUP BY 1)
  LEFT JOIN (VALUES ('en', 'true'), ('de', 'review'), ('fr', 'false')) v(license_status, include_by_default) USING (license_status)""")
def licence_summary(spark, sf_dir):
    policy = spark.createDataFrame([("en", "true"), ("de", "review"), ("fr", "false")], "license_status string, include_by_default string")
    rows = table(spark, sf_dir, "documents").select("text", F.when(F.pmod("doc_id", F.lit(11)) != 0, F.col("lang")).alias("license_status"))
    return rollup.licence_summary(rows, policy)


@query("SELECT source AS work_id, count(*) AS documents FROM documents GROUP BY source")
def documents_per_work(spark, sf_dir):
    return rollup.per_work(documents(spark, sf_dir))


@query("SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL OR l.quality <> 0")
def scan_gate_of_all(spark, sf_dir):
    """Documents without a score stay, too."""
    labels = table(spark, sf_dir, "labels")
    scores = labels.select(F.col("doc_id").alias("source_id"), F.col("doc_id").alias("_ord"), F.col("quality").cast("double").alias("ocr_quality_score"), F.when(F.col("quality") == 0, "reject").otherwise("ocr_gold").alias("ocr_quality_class"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"))
    return select.scan_gate(docs, scores).select(F.col("source_id").alias("doc_id"), F.col("ocr_quality_score").cast("int").alias("quality"))


@query(f"WITH {_TOKEN_COUNTS} SELECT 0::BIGINT AS without_count, 0::BIGINT AS without_document, true AS sums_agree, sum(token_count)::BIGINT AS tokens FROM t")
def token_reconciliation(spark, sf_dir):
    counts = tokens.count_records(documents(spark, sf_dir))
    return rollup.reconciled(counts, documents(spark, sf_dir), rollup.sums(counts))


# --- text ------------------------------------------------------------------------------------------------------------


@query(rf"SELECT page_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&[a-zA-Z0-9#]+;', ' ', 'g'), '[{_S}]+', ' ', 'g'), '{_STRIP}', '', 'g')) AS digest FROM pages")
def html_fallback_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(fn.strip_tags(F.col("html")), 256).alias("digest"))


@query(SQL["html_fallback_text"])
def html_body_text(spark, sf_dir):
    """No page of the table parses as XML, so that all take the fallback."""
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(markup.html_text("html"), 256).alias("digest"))


_XHTML = "<html xmlns='http://www.w3.org/1999/xhtml'><head><title>no</title></head><body><script>no</script>%s<p>first<br/>second </p><div><b>bold</b> tail</div></body></html>"
_PAGE_WORDS = rf"regexp_extract_all(regexp_replace(html, '[^a-zA-Z ]', ' ', 'g'), '[a-zA-Z]+')"


@query(rf"SELECT page_id, array_to_string({_PAGE_WORDS}, ' ') || chr(10) || chr(10) || 'first' || chr(10) || 'second ' || chr(10) || chr(10) || 'bold tail' AS text FROM pages")
def xhtml_body_text(spark, sf_dir):
    """Pages of XHTML that parse: a block of each page's words, then blocks, a line end and a tail."""
    words = F.array_join(F.regexp_extract_all(F.regexp_replace("html", "[^a-zA-Z ]", " "), F.lit("[a-zA-Z]+"), F.lit(0)), " ")
    before, after = _XHTML.split("%s")
    page = F.concat(F.lit(before + "<h1>"), words, F.lit("</h1>" + after))
    return table(spark, sf_dir, "pages").select("page_id", markup.html_text(page).alias("text"))


@query("SELECT count(*) AS texts, count(*) FILTER (doc_id % 4 = 0) AS with_markers FROM documents")
def sentinel_found(spark, sf_dir):
    """Every fourth text holds a marker."""
    text = F.when(F.pmod("doc_id", F.lit(4)) == 0, F.concat("text", F.lit("\n*** END OF THE PROJECT GUTENBERG EBOOK X ***"))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("texts"), F.sum((boilerplate.markers_left(text) > 0).cast("bigint")).alias("with_markers"))


@query(rf"""SELECT doc_id, sha256(nfc_normalize(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\n{{3,}}', chr(10) || chr(10), 'g'), '(?m)^[ \t]*[\p{{Nd}}\-—–]+[ \t]*$', '', 'g'),
  '[{_S}]+([.,:;!?])', '\1', 'g'), '([.,:;!?])[{_S}]+', '\1 ', 'g'), ' +', ' ', 'g'), '\n +', chr(10), 'g'), '{_STRIP}', '', 'g'))) AS digest FROM (SELECT doc_id, '12' || chr(10) || replace(text, ' ', '  ') || chr(10) || ' - 7 -' AS t FROM documents)""")
def clean_ocr_text(spark, sf_dir):
    raw = F.concat(F.lit("12\n"), F.replace("text", F.lit(" "), F.lit("  ")), F.lit("\n - 7 -"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(fn.clean_scan(raw), 256).alias("digest"))


@query(rf"SELECT doc_id, doc_id % 2 = 0 AS boilerplate_removed, sha256({_tidy('text')}) AS digest FROM documents")
def scan_headers(spark, sf_dir):
    notice = "The original of tliis book is in\nthe Library.\nhttp://www.archive.org/details/abc123 \n\n"
    raw = F.concat(F.when(F.pmod("doc_id", F.lit(2)) == 0, notice).otherwise(""), F.replace("text", F.lit(" "), F.lit("  ")))
    return table(spark, sf_dir, "documents").select("doc_id", boilerplate.without_scan_headers(raw).alias("b")).select("doc_id", "b.boilerplate_removed", F.sha2("b.text", 256).alias("digest"))


@query(rf"""SELECT doc_id, sha256({_tidy('text')}) AS digest, doc_id % 3 <> 0 AS end_marker_found, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS notices_removed, 2 AS start_line FROM documents""")
def boilerplate_slice(spark, sf_dir):
    raw = F.concat(
        F.lit("\ufeffAbout this book\r\n\r\n*** START OF THIS PROJECT GUTENBERG EBOOK A BOOK ***\r\n\r\n"), F.when(F.pmod("doc_id", F.lit(2)) == 0, "Produced by someone\nand others\n\n\n").otherwise(""), "text",
        F.when(F.pmod("doc_id", F.lit(3)) != 0, "  \n\n*** END OF THE PROJECT GUTENBERG EBOOK A BOOK ***\nTerms").otherwise(""),
    )
    b = table(spark, sf_dir, "documents").select("doc_id", boilerplate.between_markers(raw).alias("b"))
    return b.select("doc_id", F.sha2("b.text", 256).alias("digest"), "b.end_marker_found", "b.notices_removed", "b.start_line")


@query("SELECT count(*) AS texts, 0::BIGINT AS with_markers FROM documents")
def sentinel_check(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("texts"), F.sum((boilerplate.markers_left(F.col("text")) > 0).cast("bigint")).alias("with_markers"))


@query()
def chunks(spark, sf_dir):
    return segment.segment(table(spark, sf_dir, "documents"), segment.Window(200, 400, 50)).drop("text")


# --- export ----------------------------------------------------------------------------------------------------------

_WEIGHTS = "CASE source " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in SOURCE_WEIGHTS.items()) + " ELSE 0.5::DOUBLE END"
_TIERS = "CASE quality_tier " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in TIER_WEIGHTS.items()) + " ELSE 0.5::DOUBLE END"
_RENAMED = _TOKEN_COUNTS.replace("d AS (SELECT doc_id AS _ord", "d0 AS (SELECT doc_id AS _ord").replace("FROM documents)", "FROM documents), d AS (SELECT * REPLACE (CASE source WHEN 'src1' THEN 'project_gutenberg' WHEN 'src2' THEN 'lane_b' ELSE source END AS source) FROM d0)")


def _export(spark, sf_dir):
    d = documents(spark, sf_dir)
    renamed = d.withColumn("source", F.when(F.col("source") == "src1", "project_gutenberg").when(F.col("source") == "src2", "lane_b").otherwise(F.col("source")))
    parts = renamed.where("_ord % 2 = 0"), renamed.where("_ord % 2 = 1").withColumn("training_eligibility", F.when(F.col("_ord") % 7 == 0, "retrieval_only").otherwise("training_candidate"))
    return export.union(*parts)


@query(f"WITH {_RENAMED} SELECT version_id AS doc_id, {_WEIGHTS} AS source_weight, {_TIERS} AS tier_weight, {_WEIGHTS} * {_TIERS} AS sampling_weight FROM t WHERE NOT (_ord % 2 = 1 AND _ord % 7 = 0)")
def training_union_weights(spark, sf_dir):
    return export.weighted(export.without_retrieval_only(_export(spark, sf_dir)), otherwise=0.5).select("doc_id", "source_weight", "tier_weight", "sampling_weight")


@query("SELECT 'retrieval_only' AS reason, count(*) AS n FROM documents WHERE doc_id % 2 = 1 AND doc_id % 7 = 0 HAVING count(*) > 0")
def retrieval_only_excluded(spark, sf_dir):
    return export.skipped(_export(spark, sf_dir))


@query(f"""WITH {_RENAMED}, w AS (SELECT *, sum(token_count) OVER (ORDER BY {_RANK}, {_WEIGHTS} DESC, version_id) AS cumulative_tokens FROM t)
SELECT version_id AS doc_id, token_count, cumulative_tokens::BIGINT AS cumulative_tokens FROM w WHERE cumulative_tokens - token_count < 100000 AND cumulative_tokens <= 150000""")
def token_budget_pilot(spark, sf_dir):
    weighted = export.weighted(_export(spark, sf_dir), otherwise=0.5)
    counts = weighted.select("doc_id", "quality_tier", "source_weight", fn.token_count(F.col("text")).alias("token_count"))
    return export.budget(counts, 100_000, 150_000).select("doc_id", "token_count", "cumulative_tokens")


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de')")
def licence_gate(spark, sf_dir):
    policy = spark.createDataFrame([("en", "true"), ("de", "review"), ("fr", "false")], "license_status string, include_by_default string")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("license_status"))
    return select.licence_gate(rows, policy, review=True).select("doc_id", F.col("license_status").alias("lang"))


@query("""SELECT doc_id::VARCHAR AS version_id, f AS format, CASE f WHEN 'txt' THEN 'https://www.gutenberg.org/cache/epub/' || doc_id || '/pg' || doc_id || '.txt' ELSE 'https://www.gutenberg.org/ebooks/' || doc_id || '.epub.noimages' END AS url,
  'raw/pg_' || doc_id || '_' || doc_id AS folder, doc_id || '.' || f AS filename FROM documents, (VALUES ('txt'), ('epub')) v(f) WHERE source = 'src1'""")
def acquisition_plan(spark, sf_dir):
    return acquire.plan(documents(spark, sf_dir).where("source = 'src1'"), "project_gutenberg")
