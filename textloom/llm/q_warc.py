"""Query of the WARC operator and its SQL."""

from . import warc


def op6_warc(spark, sf_dir: str):
    """Every page written as a record and read back: page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, captured_at."""
    index = warc.archive_and_index(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at")


SQL = {
    "op6_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, coalesce(url, '') AS url FROM pages),
h AS (SELECT *, octet_length(encode(payload))::BIGINT AS payload_bytes, sha1(payload) AS h FROM p),
d AS (SELECT *, translate(upper(list_aggregate([lpad(to_base(('0x' || substr(h, 1 + 5 * i, 5))::BIGINT, 32), 4, '0') FOR i IN range(8)], 'string_agg', '')),
  '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first,
  regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^#]*)', ['authority', 'rest']) AS u FROM h),
k AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_replace(u.authority, '^.*@', '')), '^www[0-9]*\.', ''), ':(80|443)?$', '') AS host FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to,
  array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN starts_with(u.rest, '/') THEN u.rest ELSE '/' || u.rest END AS url_key,
  strftime(make_timestamp((1704067200 + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured_at FROM k"""
}
QUERIES = {"op6_warc": op6_warc}
