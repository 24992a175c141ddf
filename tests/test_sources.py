import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from textloom.functions import markup
from textloom.plans import normalize
from textloom.schema import VERSIONS, WORKS
from textloom.sources import files, jsonl, parquet, policies
from textloom.streaming import incremental


def test_jsonl(spark, tmp_path):
    p = str(tmp_path / "a.jsonl")
    (tmp_path / "a.jsonl").write_text('{"version_id": "v1", "text": "é"}\n\n{"version_id": "", "text": "x"}\n{"version_id": "v3"}\nnot json\n')
    schema = "version_id string, text string"
    problems = {r.line: r.problem for r in jsonl.problems(spark, p, schema).collect()}
    assert problems == {'{"version_id": "", "text": "x"}': "no version_id", '{"version_id": "v3"}': "no key text", "not json": "not a JSON object"}
    with pytest.raises(Exception):
        jsonl.read(spark, p, schema).collect()
    rows = jsonl.read(spark, p, schema, "PERMISSIVE").orderBy("_ord").collect()
    assert [r.version_id for r in rows] == ["v1", "", "v3", None]
    out = str(tmp_path / "out")
    jsonl.write(spark.createDataFrame([("b", None, 1)], "z string, a string, _ord int"), out)
    assert [json.loads(r.value) for r in spark.read.text(out).collect()] == [{"a": None, "z": "b"}] and spark.read.text(out).first().value.startswith('{"a"')
    jsonl.write_rejected(spark.createDataFrame([("v", "short"), ("w", "dup")], "version_id string, reject_reason string"), str(tmp_path / "rej"))
    assert {x.name for x in (tmp_path / "rej").iterdir() if x.is_dir()} == {"reject_reason=short", "reject_reason=dup"}
    with pytest.raises(ValueError):
        jsonl.checked_paths("a/b/", "a/b")


def test_required_values_of_json_lines(spark, tmp_path):
    something, nothing = ['"0"', '"v"', "7", "0.5", "true", "[0]", '{"a":0}', '"false"', '"[]"', '" "'], ['""', "0", "0.0", "-0", "0e3", "false", "null", "[]", "{}"]
    (tmp_path / "a.jsonl").write_text("".join(f'{{"version_id":{v},"text":"x"}}\n' for v in something + nothing) + '{"text":"x"}\n{"version_id":"0"}\n')
    problems = [(r.line, r.problem) for r in jsonl.problems(spark, str(tmp_path / "a.jsonl"), "version_id string, text string").collect()]
    assert problems == [*[(f'{{"version_id":{v},"text":"x"}}', "no version_id") for v in nothing], ('{"text":"x"}', "no version_id"), ('{"version_id":"0"}', "no key text")]
    assert jsonl.problems(spark, str(tmp_path / "a.jsonl"), "version_id string, text string", required=()).count() == 1


LAYOUT = '<document xmlns="urn:x"><page><block><par><line>{}</line><line>{}</line></par><par><line/></par></block></page><par><line>{}</line></par></document>'


def glyphs(text):
    return "".join(f'<charParams wordStart="{"true" if i == 0 else "false"}">{c}</charParams>' for w in text.split("_") for i, c in enumerate(w))


def test_layout_text():
    xml = LAYOUT.format(glyphs("ab_cd"), "<charParams> </charParams>" + glyphs("e"), glyphs("f")).encode()
    assert markup.layout_text(io.BytesIO(xml)) == "ab cd\n e\n\nf"
    assert markup.file_text("x_abbyy.gz", gzip.compress(xml)) == "ab cd\n e\n\nf"
    odd = b'<document><charParams/><charParams wordStart="true">a</charParams><line/><par><line><charParams> </charParams></line></par><charParams wordStart="true">b </charParams><charParams wordStart="true">c</charParams></document>'
    assert markup.layout_text(io.BytesIO(odd)) == " a\n \n\nb  c"
    assert markup.file_text("x.gz", gzip.compress(b"plain \xff")) == "plain �" and markup.file_text("x.gz", b"broken") == "" and markup.file_text("x.pdf", b"x") == ""
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a.xml", "no")
        f.writestr("b.txt", "yes")
    assert markup.file_text("x_txt.zip", z.getvalue()) == "yes"


def epub(items, spine=None, folder="epub"):
    z = io.BytesIO()
    at = f"{folder}/" if folder else ""
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("META-INF/container.xml", f'<container xmlns="urn:c"><rootfiles><rootfile full-path="{at}content.opf"/></rootfiles></container>')
        manifest = "".join(f'<item id="i{n}" href="{h}"/>' for n, (h, _, _) in enumerate(items))
        order = "".join(f'<itemref idref="i{n}"/>' for n in (spine or range(len(items))))
        f.writestr(f"{at}content.opf", f'<package xmlns="urn:o"><manifest>{manifest}</manifest><spine>{order}<itemref idref="none"/></spine></package>')
        for href, where, body in items:
            if where is not None:
                f.writestr(where + href, f"<html><body>{body}</body></html>")
    return z.getvalue()


def test_epub():
    items = [("text/titlepage.xhtml", "epub/", "no"), ("text/one.xhtml", "epub/", "<p>e\u0301</p>"), ("text/two.xhtml", "", "<p>bare</p>"), ("text/gone.xhtml", None, ""), ("text/empty.xhtml", "epub/", " ")]
    got = markup.epub_text(epub(items, [1, 0, 2, 3, 4]))
    assert got == {"text": "é\n\nbare", "spine_items_total": 4, "spine_items_accepted": 2, "spine_items_skipped": 1, "spine_items_failed": 1, "skipped_filenames": ["titlepage.xhtml"]}


def test_files(spark, tmp_path):
    for folder, name, data in [("a", "x_djvu.txt", b"\xef\xbb\xbfhi\xff"), ("a", "x_abbyy.gz", b""), ("b", "y_abbyy.gz", gzip.compress(b"gz text")), ("b", "y_txt.zip", b"bad zip"), ("c", "z.epub", epub([("o.xhtml", "", "<p>b</p>")], folder="")), ("c", "bad.epub", b"no")]:
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(data)
    root = str(tmp_path)
    assert {(r.source_id, r.text) for r in files.texts(spark, root).collect()} == {("a", "hi�"), ("b", "gz text")}
    assert {r.source_id: r.path.rpartition("/")[2] for r in files.candidates(spark, root).collect()} == {"a": "x_djvu.txt", "b": "y_txt.zip"}
    assert {r.source_id: r.text for r in files.candidate_texts(spark, root).collect()}["b"] == ""
    books = {r.path.rpartition("/")[2]: r for r in files.books(spark, root).collect()}
    assert books["z.epub"].text == "b" and books["z.epub"].error is None and books["bad.epub"].text is None and "BadZipFile" in books["bad.epub"].error
    f = files.fingerprints(files.binary(spark, root, "*.epub")).where(F.col("path").endswith("bad.epub")).first()
    assert f.byte_count == 2 and len(f.sha256) == 64
    missing = files.missing_files(spark.createDataFrame([("v", "nowhere")], "version_id string, raw_path string"), files.binary(spark, root))
    assert missing.count() == 1


def test_policies(spark):
    text = 'license_statuses:\n  pd:\n    include_by_default: true\n    description: "Public: yes"\n\n  other:\n    include_by_default: "review"\n  no:\n    include_by_default: false\n'
    assert {r.license_status: r.include_by_default for r in policies.licences(spark, text).collect()} == {"pd": "include", "other": "review", "no": "exclude"}
    s = policies.sources(spark, "# c\nsources:\n  a:\n    priority: 1\n    acquisition_methods:\n      - \"m\"\n      - n\n    notes: null\n").first()
    assert (s.source, s.priority, s.acquisition_methods, s.notes) == ("a", 1, ["m", "n"], None)
    assert {tuple(r) for r in policies.authors(spark, "authors:\n  ancient:\n    - Thales\n    - 'O''Brien'\n  late: []\n").collect()} == {("ancient", "Thales"), ("ancient", "O'Brien")}
    with pytest.raises(ValueError):
        policies.parse("a:\n  b: 1\n c: 2\n")


@pytest.fixture
def manifests(spark):
    v = dict(source="s", source_url="http://u", license_rationale="r", resolution_confidence="high", acquisition_method="internet_archive_api_discovery")
    names = [x.split()[0] for x in VERSIONS.split(", ")]
    row = lambda **k: tuple({**v, **k}.get(n) for n in names)
    versions = spark.createDataFrame([row(version_id="v1", work_id="w", source_id="1", source="internet_archive"), row(version_id="v2", work_id=None, source_id="2", title="Own", source="internet_archive"), row(version_id="v3", source_id="3", source="internet_archive")], VERSIONS).withColumn("_ord", F.monotonically_increasing_id())
    works = spark.createDataFrame([("w", "Author", "Title", "ancient", "t1", "ok", ["s"])], WORKS).withColumn("_ord", F.lit(0))
    side = spark.createDataFrame([("v1", "2026-01-01", [("txt", "http://raw"), ("djvu_txt", "http://djvu")])], "version_id string, acquired_at_utc string, artifacts array<struct<format:string,source_url:string>>")
    return versions, works, side


def test_normalize(spark, manifests):
    raw = "*** START OF THE PROJECT GUTENBERG EBOOK X ***\nBody  here\n*** END OF THE PROJECT GUTENBERG EBOOK X ***"
    texts = spark.createDataFrame([("v1", "p1", "h1", raw), ("v2", "p2", "h2", "nothing")], "version_id string, raw_path string, raw_sha256 string, raw string")
    docs, rejected = normalize.marked_texts(*manifests, texts)
    d = docs.collect()
    assert len(d) == 1 and len(docs.columns) == 25 and (d[0].doc_id, d[0].title, d[0].author, d[0].text, d[0].raw.source_artifact_url) == ("v1__full_text", "Title", "Author", "Body  here", "http://raw")
    assert d[0].normalization.text_line_count == 1 and {(r.version_id, r.reject_reason) for r in rejected.collect()} == {("v2", "missing_start_marker"), ("v3", "missing_raw_text")}
    docs, rejected = normalize.scanned_texts(*manifests, texts)
    assert {r.version_id: r.text for r in docs.collect()}["v2"] == "nothing" and docs.where("version_id = 'v1'").first().raw.source_artifact_url == "http://djvu" and rejected.count() == 1
    books = spark.createDataFrame([("v1", "p", "h", "Book", 1, 1, 0, 0, [], None), ("v2", "p", "h", None, None, None, None, None, None, "BadZipFile")], "version_id string, raw_path string, raw_sha256 string, text string, spine_items_total int, spine_items_accepted int, spine_items_skipped int, spine_items_failed int, skipped_filenames array<string>, error string")
    docs, rejected = normalize.book_texts(*manifests, books)
    assert [r.text for r in docs.collect()] == ["Book"] and {r.reject_reason for r in rejected.collect()} == {"BadZipFile", "missing_raw_text"}
    assert normalize.totals(normalize.marked_texts(*manifests, texts)[0]).first().records == 1


def test_resolved_scans(spark, manifests):
    scores = spark.createDataFrame([(0, "1", 40.0, "reject"), (1, "2", 60.0, "ocr_bronze")], "_ord int, source_id string, ocr_quality_score double, ocr_quality_class string")
    texts = spark.createDataFrame([("1", "x" * 200), ("2", "word . " * 20), ("3", "y" * 99)], "source_id string, text string")
    docs, rejected = normalize.resolved_scans(manifests[0], scores, texts)
    d = docs.first()
    assert docs.count() == 1 and d.training_eligibility == "retrieval_only" and d.text.startswith("word. word.") and len(docs.columns) == 17
    assert {(r.version_id, r.reject_reason) for r in rejected.collect()} == {("v1", "scan_class_reject"), ("v3", "short_or_missing_text")}


def test_incremental(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "doc_id bigint, text string"
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], schema).write.json(src)
    run = lambda: incremental.run_once(incremental.new_texts(incremental.arrivals(spark, src, schema)), out, check)
    run()
    spark.createDataFrame([(4, "b"), (5, "c")], schema).write.mode("append").json(src)
    run()
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_parquet_by_schema_in_order(spark, tmp_path):
    path = str(tmp_path / "counts")
    rows = spark.createDataFrame([("b", 2, "x"), ("a", 1, None), (None, 3, "y")], "doc_id string, token_count int, other string")
    parquet.write(rows, path, "token_count BIGINT, doc_id STRING, about STRING", order=("doc_id",))
    out = parquet.read(spark, path, "token_count BIGINT, doc_id STRING, about STRING")
    assert out.dtypes == [("token_count", "bigint"), ("doc_id", "string"), ("about", "string")]
    assert [tuple(r) for r in out.withColumn("at", F.struct("_metadata.file_name", F.monotonically_increasing_id())).orderBy("at").drop("at").collect()] == [(3, None, None), (1, "a", None), (2, "b", None)]
    parquet.write(rows.limit(0), str(tmp_path / "none"), "doc_id STRING")
    assert parquet.read(spark, str(tmp_path / "none"), "doc_id STRING").count() == 0
