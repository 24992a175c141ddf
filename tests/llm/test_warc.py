import base64
import gzip
import hashlib
import io
import random

from textloom.llm import warc

PAGES = "page_id bigint, url string, html string"


def test_round_trip(spark, clashing, tmp_path):
    rows = [
        (5, "http://www.A.example.com/x?y=1#z", "<p>é</p>"), (2, "https://b.example.com", "<p>é</p>"), (9, "http://a.example.com/x?y=1", "<p>é</p>"), (1, None, None), (3, "u", ""), (4, "bad\r\nurl here", "WARC/1.0\r\nContent-Length: 3\r\n\r\n"),
        (6, "http://c.example.com:8080/", "x" * 300_000), (7, "//h", "line\r\nline\n\n"), (None, "http://n", "<p>é</p>"), (None, "http://m", "only null"), (8, "http://r", "again"), (8, "http://r", "again"),
    ]
    pages = clashing(spark.createDataFrame(rows, PAGES), "digest", "bytes", "first", "record", "n")
    path = str(tmp_path / "w")
    got = warc.archive_and_index(pages, path=path).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    first = {h: min((i for i in ids if i is not None), default=None) for h, ids in groups.items()}
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        f = first[h or ""]
        revisit = f is not None and len(groups[h or ""]) > 1 and i != f
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    # the offsets lead to the records
    for r in got:
        with gzip.open(f"{path}/{r.run}") as f:
            f.seek(r.offset)
            assert next(warc.parse(io.BytesIO(f.read(r.length))))[2]["warc-record-id"] == r.record_id
    order = sorted(got, key=lambda r: r.capture_order)
    assert [(r.url_key, r.captured_at, r.record_id) for r in order] == sorted((r.url_key, r.captured_at, r.record_id) for r in got)


def test_small_payloads_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], PAGES)
    got = {r.page_id: r.record_type for r in warc.archive_and_index(pages, least=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.archive_and_index(spark.createDataFrame([], PAGES)).collect() == []


def test_hot_payloads_and_long_pages(spark, monkeypatch, tmp_path):
    """A third of all pages are empty, and some are longer than the payloads that share archives."""
    monkeypatch.setattr(warc, "LEAST_HOT", 20)
    rows = [(i, f"http://h/{i}", "" if i % 3 == 0 else f"<p>{i // 2}</p>" if i % 3 == 1 else "é" * (40 * (i % 50))) for i in range(300)] + [(1000, "http://h/long", "x" * 3_000_000)]
    path = str(tmp_path / "w")
    pages = spark.createDataFrame(rows, PAGES)
    warc.write_archives(pages, path, archives=((100, 50), (2000, 4)))
    got = {r.page_id: r for r in warc.merge_index(warc.stage(warc.read_archives(spark, path), "runs", spark)).collect()}
    assert len(got) == 301
    first = {}
    for i, _, h in rows:
        first.setdefault(h, i)
        assert (got[i].record_type, got[i].refers_to, got[i].payload_bytes) == (("response", None) if first[h] == i else ("revisit", first[h])) + (len(h.encode()),)
    of_run = {}
    for r in got.values():
        of_run.setdefault(r.run, []).append(r.payload_bytes)
    assert all(len(x) <= (50 if max(x) <= 100 else 4 if max(x) <= 2000 else 1) for x in of_run.values())


def test_merge_over_ranges(spark):
    rng = random.Random(1)
    pages = spark.createDataFrame([(i, f"http://h{rng.randint(0, 3)}.example.com/{rng.choice('ab')}", str(i)) for i in range(500)], PAGES).repartition(5)
    got = sorted(warc.archive_and_index(pages).collect(), key=lambda r: r.capture_order)
    key = [(r.url_key, r.captured_at, r.record_id) for r in got]
    assert key == sorted(key) and len(set(r.capture_order for r in got)) == 500 and len({r.run for r in got}) > 1


def test_loser_tree():
    rng = random.Random(2)
    for k in range(0, 9):
        runs = [sorted((rng.randint(0, 20), i) for i in range(rng.randint(0, 15))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_url_key():
    assert warc.url_key("https://user@www.Example.COM:443/A?b#c") == "com,example)/A?b"
    assert warc.url_key("http://x.org") == "org,x)/" and warc.url_key("") == "" and warc.url_key("No/Scheme#f") == "no/scheme"
