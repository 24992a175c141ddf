import json

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as fn
from textloom.operators import acquire, dedup, export, reports, rollup, segment, select, tokens
from textloom.schema import TIERS

RECORD = "_ord bigint, version_id string, work_id string, source string, source_id string, author string, title string, translator string, language string, quality_tier string, text string, doc_id string"


def records(spark, rows):
    """rows: dicts of what differs."""
    base = dict(work_id="w", source="s", source_id="1", author="a", title="T", translator=None, language="en", quality_tier=TIERS[0], text="t")
    full = [{**base, "version_id": f"v{i}", **r, "_ord": i} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple({**r, "doc_id": r["version_id"]}[c.split()[0]] for c in RECORD.split(", ")) for r in full], RECORD)


def test_keeper_order(spark):
    df = records(spark, [dict(quality_tier=TIERS[1]), dict(quality_tier=None), dict(author="b"), dict(work_id="x"), dict(source_id="2"), dict(version_id="v9"), dict(version_id="v3", text="alone"), dict(text=None), dict(text="")])
    got = {r.version_id: (r.keeper, r.kept, r.group_size) for r in dedup.exact_decisions(dedup.with_digests(df)).collect()}
    assert got["v9"] == ("v9", True, 6) and got["v3"] == ("v3", True, 1) and got["v0"] == ("v9", False, 6)
    assert got["v7"][1] and not got["v8"][1]
    assert [r.members for r in dedup.groups(dedup.with_digests(df), "text_sha256").where("size = 6").collect()] == [["v9", "v4", "v3", "v2", "v0", "v1"]]


def test_repeated_version_ids_are_rows_of_their_own(spark):
    df = records(spark, [dict(version_id="same"), dict(version_id="same")])
    kept, rejected = dedup.deduplicate(df)
    assert kept.count() == 1 and rejected.count() == 1
    kept2 = dedup.deduplicate(kept.drop("deduplication"))[0]
    assert kept2.count() == 1


def test_deduplicate(spark):
    p, q = "p " * 60, "q " * 60
    df = records(spark, [dict(text=f"{p}\n\n{q}"), dict(text=f"{p}\n \n{q}\n\nshort"), dict(text="x", work_id="o"), dict(text="x", work_id="o"), dict(text="X", work_id=None), dict(text=p, language=None)])
    kept, rejected = dedup.deduplicate(df)
    d = {r.version_id: r.deduplication for r in kept.collect()}
    assert sorted(d) == ["v0", "v1", "v2", "v4", "v5"] and [r.version_id for r in rejected.collect()] == ["v3"] and rejected.first().keeper == "v2"
    assert d["v2"].status == "accepted_exact_duplicate_keeper" and d["v2"].exact_duplicate_version_ids == ["v3"] and d["v2"].same_work_cluster_size == 1
    assert d["v0"].paragraph_hash_count == 2 and d["v0"].same_work_relation == "alternate_edition_candidate" and d["v0"].same_work_cluster_size == 2 and d["v4"].same_work_relation is None
    v = dedup.validation(kept).first()
    assert (v.records, v.unique_version_ids, v.exact_duplicate_hash_groups, v.records_with_dedup_metadata) == (5, 5, 0, 5)
    assert kept.count() + rejected.count() == df.count()
    assert dedup.canonical_review(dedup.with_digests(df)).count() == 1


def test_paragraphs_and_containment(spark):
    a, b, c = "a" * 79, "B " * 40 + "b", "c" * 100
    df = records(spark, [dict(text=f"{a}\n\n{b}\n\n{b}"), dict(text=f"{b.lower()}\n\n{c}"), dict(text=a), dict(text=c + "\n\n" + "d" * 90, work_id="z"), dict(text="e" * 90, work_id="z")])
    h = dedup.paragraph_hashes(df, ("version_id", "work_id", "language"))
    assert {r.version_id: r["count"] for r in h.groupBy("version_id").count().collect()} == {"v0": 1, "v1": 2, "v3": 2, "v4": 1}
    assert {r.work_id: r.max_containment for r in dedup.containment(h).collect()} == {"w": 1.0, "z": 0.0}


@pytest.mark.parametrize(
    "rows, relation",
    [
        ([dict(title="Works, Vol. 1"), dict(title="Works, Vol. 2")], "multi_part_or_volume_candidate"),
        ([dict(title="Part One"), dict(translator="x")], "multi_part_or_volume_with_translator_variance"),
        ([dict(translator="x"), dict(translator=None)], "alternate_translation_or_scope_candidate"),
        ([dict(title="The  WORK"), dict(title="the work"), dict(title=None)], "alternate_edition_candidate"),
        ([dict(title="One"), dict(title="Two"), dict(translator="")], "same_work_alternate_candidate"),
    ],
)
def test_relations(spark, rows, relation):
    assert [r.relation for r in dedup.clusters(records(spark, rows)).collect()] == [relation]
    assert dedup.clusters(records(spark, [dict(work_id=""), dict(work_id=None)])).collect() == []


def test_near_pairs(spark):
    w = [f"w{i}" for i in range(200)]
    df = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(w[:195] + ["x"] * 5)), (3, " ".join(w[:100])), (4, " ".join(w)), (5, None), (6, "")], "doc_id bigint, text string")
    assert [(r.a, r.b) for r in dedup.near_pairs(df).collect()] == [(1, 2)]


def test_near_pairs_in_blocks(spark):
    """All links, once each, wherever blocks part a group: against brute force; white space and capitals don't count."""
    import random

    rng = random.Random(4)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(80)] for _ in range(3)]
    texts = []
    for i in range(90):
        w = list(base[i % 3])
        for _ in range(rng.randrange(4)):
            w[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
        texts.append(("\u2003" if i % 2 else " ").join(w).upper() if i % 5 == 0 else "  ".join(w))
    texts += ["a b c", "A\tb c", " ", None, "a b d", texts[0]]
    sets = []
    for t in dict.fromkeys(t for t in texts if t):
        w = t.lower().split()
        if w:
            sets.append((texts.index(t), {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}))
    want = sorted((a, b, len(s & t) / len(s | t)) for i, (a, s) in enumerate(sets) for b, t in sets[i + 1 :] if len(s & t) / len(s | t) >= 0.8)
    assert len(want) > 100 and (90, 91, 1.0) in want
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for limits in ({}, {"block_sets": 7}, {"block_shingles": 500}, {"block_sets": 1}):
        got = dedup.near_pairs(df, hashes=96, rows=3, **limits)
        assert sorted(map(tuple, got.collect())) == want, limits
    joins = [x for x in ("CartesianProduct", "BroadcastNestedLoopJoin") if x in got._jdf.queryExecution().toString()]
    assert not joins and dedup.near_pairs(df.limit(0)).collect() == []


def test_selection(spark):
    df = spark.createDataFrame([(0, "v1", "s", "high"), (1, "v2", "s", "low"), (2, "v3", "s", "high"), (3, "v4", "t", "high"), (4, "v5", "s", None)], "_ord int, version_id string, source string, resolution_confidence string")
    ids = lambda d: [r.version_id for r in d.orderBy("_ord").collect()]
    assert ids(select.selected(df, "s")) == ["v1", "v3"] and ids(select.selected(df, "s", ["v3", "v9"])) == ["v3"] and ids(select.selected(df, "s", limit=1)) == ["v1"] and ids(select.selected(df, "s", limit=0)) == []
    with pytest.raises(ValueError):
        select.selected(df, "s", limit=-1)
    assert [r.version_id for r in select.missing_ids(spark.createDataFrame([("v1",), ("v9",)], "version_id string"), df).collect()] == ["v9"]


def test_lookups(spark):
    works = spark.createDataFrame([(0, "w1", "Old", "A"), (1, "w1", "New", "B"), (2, None, "None's", "C")], "_ord int, work_id string, title string, author string")
    versions = spark.createDataFrame([("v1", "w1", ""), ("v2", "w1", "Own"), ("v3", None, None), ("v4", "w9", None)], "version_id string, work_id string, title string")
    got = {r.version_id: (r.title, r.author) for r in select.with_works(versions, works, ("author",)).collect()}
    assert got == {"v1": ("New", "B"), "v2": ("Own", "B"), "v3": ("None's", "C"), "v4": (None, None)}
    scores = spark.createDataFrame([(0, "a", 90.0, "ocr_gold"), (1, "a", 10.0, "reject"), (2, "b", 60.0, "ocr_bronze")], "_ord int, source_id string, ocr_quality_score double, ocr_quality_class string")
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string")
    gated = select.scan_gate(docs, scores).select("source_id", select.scan_tier(F.col("ocr_quality_class")), select.eligibility(F.col("ocr_quality_class"))).collect()
    assert sorted(map(tuple, gated)) == [("b", TIERS[3], "retrieval_only"), ("c", TIERS[0], "training_candidate")]
    assert select.long_enough(spark.createDataFrame([("x" * 99,), ("x" * 100,), (None,)], "text string")).count() == 1


def test_licence_gate(spark):
    policy = spark.createDataFrame([("pd", "true"), ("maybe", "review"), ("no", "false")], "license_status string, include_by_default string")
    docs = spark.createDataFrame([("pd",), ("maybe",), ("no",), ("unknown",), (None,)], "license_status string")
    assert [r[0] for r in select.licence_gate(docs, policy).collect()] == ["pd"] and select.licence_gate(docs, policy, review=True).count() == 2


def test_rollup_golden_and_nulls(spark):
    # sums of a published table of counts by language
    rows = [("w1", "de", None, 549_240), ("w2", "en", "p", 4_696_403), ("w3", "es", "p", 494_188), ("w4", "fr", None, 407_038)]
    counts = spark.createDataFrame([(i, *r, "s", "a", "t") for i, r in enumerate(rows)], "_ord int, work_id string, language string, period string, token_count bigint, source string, author string, quality_tier string")
    s = {(r.dimension, r.key): r.tokens for r in rollup.sums(counts).collect()}
    assert s["total", None] == 6_146_869 and s["period", None] == 956_278 and s["language", "en"] == 4_696_403
    for d in rollup.DIMENSIONS:
        assert sum(v for (k, _), v in s.items() if k == d) == 6_146_869
    assert [tuple(r) for r in rollup.top(counts, n=2).collect()] == [("w2", 4_696_403), ("w1", 549_240)]
    empty = {r.dimension: r.tokens for r in rollup.sums(counts.limit(0)).collect()}
    assert empty == {"total": 0}


def test_top_ties_keep_first_seen(spark):
    counts = spark.createDataFrame([(i, f"w{9 - i}", 5) for i in range(9)], "_ord int, work_id string, token_count int")
    assert [r.work_id for r in rollup.top(counts, n=3).collect()] == ["w9", "w8", "w7"]


def test_tokens(spark):
    df = records(spark, [dict(text="one two, three"), dict(text=None), dict(text="")])
    out = tokens.count_records(df, counted_at_utc="now").orderBy("doc_id").collect()
    assert [(r.token_count, r.char_count) for r in out] == [(4, 14), (0, 0), (0, 0)] and len(out[0]) == 23 and out[0].backend == "regex"
    split = tokens.Tokenizer("own", "split", lambda: lambda t: len(t.split()))
    assert [r.token_count for r in tokens.count_records(df, split).orderBy("doc_id").collect()] == [3, 0, 0]
    t = rollup.tokenizer_of(tokens.count_records(df, split).withColumn("_ord", F.lit(0))).first()
    assert t.backend == "own" and t.tokenizer == "split" and rollup.tokenizer_of(tokens.count_records(df.limit(0)).withColumn("_ord", F.lit(0))).collect() == []
    assert tokens.context_of(5, 10) == 5 and tokens.context_of(0, 10) == 10 and tokens.context_of(None, 1e30) is None and tokens.revision_of(None, "", "r") == "r"


def test_rank_file(spark):
    public = pytest.importorskip("public_tokenizers")
    t = tokens.rank_file(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    assert tokens.count_records(records(spark, [dict(text="hello world")]), t).first().token_count == 2


def test_chunks(spark):
    para = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    text = "Chapter I\n\n" + para(30, "a") + "\n\n" + para(30, "b") + "\n \n" + "Chapter 2\n\n" + para(130, "c") + "\n\n" + para(5, "d")
    w = segment.Window(40, 60, 10)
    got = segment.chunks(text, w)
    assert all(a < b and len(segment._TOKEN.findall(text[a:b])) <= 62 for a, b, *_ in got)
    assert [m for *_, m in got].count("token_window") == 3 and got[0][4] == "Chapter I" and got[-1][4] == "Chapter 2"
    covered = set()
    for a, b, *_ in got:
        covered.update(range(a, b))
    assert {m.start() for m in segment._TOKEN.finditer(text)} <= covered
    df = spark.createDataFrame([(1, text), (2, None), (3, " \n\n ")], "doc_id bigint, text string")
    out = segment.segment(df, w).orderBy("chunk_index").collect()
    assert [(r.char_start, r.char_end) for r in out] == [(a, b) for a, b, *_ in got] and out[0].chunk_id == "1__000000" and len({r.chunk_id for r in out}) == len(out)
    segment.register(spark)
    df.createOrReplaceTempView("chunk_docs")
    assert spark.sql("SELECT d.doc_id, c.text FROM chunk_docs d, LATERAL chunk_text(d.text, 40, 60, 10) c").count() == len(got)
    with pytest.raises(ValueError):
        segment.Window(10, 5)


def test_export(spark):
    a = spark.createDataFrame([("d1", "project_gutenberg", TIERS[0], 60), ("d2", "lane_b", TIERS[1], 50)], "doc_id string, source string, quality_tier string, token_count int")
    b = spark.createDataFrame([("d3", "other", None, 70, "retrieval_only"), ("d4", "internet_archive", TIERS[2], 40, None)], "doc_id string, source string, quality_tier string, token_count int, training_eligibility string")
    u = export.union(a, b)
    assert export.without_retrieval_only(u).count() == 3 and [tuple(r) for r in export.skipped(u).collect()] == [("retrieval_only", 1)]
    w = export.weighted(u)
    assert {r.doc_id: r.sampling_weight for r in w.collect()} == pytest.approx({"d1": 1.0, "d2": 0.48, "d3": 0.0, "d4": 0.48})
    assert [(r.doc_id, r.cumulative_tokens) for r in export.budget(w, 100, 1000).orderBy("cumulative_tokens").collect()] == [("d1", 60), ("d2", 110)]
    assert [r.doc_id for r in export.budget(w, 100, 100).collect()] == ["d1"] and export.budget(w.limit(0), 5, 9).collect() == []
    found, missing = export.with_texts(u, spark.createDataFrame([("d1", "t")], "doc_id string, text string"))
    assert found.count() == 1 and missing.count() == 3 and {(r.kind, r.key): r.n for r in export.manifest_summary(u).collect()}["by_source", "other"] == 1


def test_acquire(spark, tmp_path):
    v = spark.createDataFrame([("v1", "12"), ("v2", "a/b")], "version_id string, source_id string")
    p = acquire.plan(v, "project_gutenberg")
    assert p.count() == 4 and p.where("format = 'txt' AND version_id = 'v1'").first().url == "https://www.gutenberg.org/cache/epub/12/pg12.txt"
    book = acquire.plan(v, "standard_ebooks").where("version_id = 'v2'").first()
    assert book.url == "https://standardebooks.org/ebooks/a/b/downloads/a_b.epub?source=download" and book.folder == "raw/se_a_b_v2"
    with pytest.raises(ValueError):
        acquire.plan(v, "internet_archive", ["epub"])
    present = p.select("folder", "filename").limit(1)
    assert acquire.to_fetch(p, present).count() == 3 and acquire.to_fetch(p, present, overwrite=True).count() == 4
    assert tuple(acquire.audit(p, present).first()) == (4, 2, 1, 3)

    class Response:
        status, headers = 200, {"Content-Type": "text/plain", "Content-Length": "3"}

        def __init__(self):
            self.left = [b"abc", b""]

        def read(self, n):
            return self.left.pop(0)

        __enter__ = lambda self: self
        __exit__ = lambda self, *a: None

    rows = [dict(version_id="v1", format="txt", url="http://x", folder=str(tmp_path / "f"), filename="a.txt")]
    assert acquire.fetch(rows, pause=0, opener=lambda *a, **k: Response())[0]["status"] == "downloaded"
    assert acquire.fetch(rows, pause=0)[0]["status"] == "skipped_existing"

    def broken(*a, **k):
        raise OSError("down")

    assert acquire.fetch(rows, pause=0, overwrite=True, opener=broken)[0]["status"] == "failed"
    out = spark.createDataFrame([("downloaded", 3), ("failed", None)], "status string, byte_count bigint")
    assert {r.status: r.bytes for r in acquire.outcomes(out).collect()} == {"downloaded": 3, "failed": 0}


def test_sidecar_and_flags(spark, tmp_path):
    from textloom.sources import files

    acquire.write_sidecar({"version_id": "v1", "source_id": "1", "language": "en"}, [{"format": "txt", "status": "downloaded", "byte_count": 3}], str(tmp_path / "pg_1_v1"), "2026-01-01")
    r = files.sidecars(spark, str(tmp_path)).first()
    assert r.version_id == "v1" and r.artifacts[0].byte_count == 3 and r.manifest_record.language == "en"
    df = spark.createDataFrame([(1, "x" * 9), (2, None), (3, "x" * 10)], "_dedup_a int, text string")
    assert sorted(r[0] for r in select.short_texts(df, 10).collect()) == [1, 2] and select.without_internal(df).columns == ["text"]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", "x\ny"), (2, "a", ""), (3, "b", "é"), (4, None, None)], "doc_id int, source string, text string")
    p = {r.source: (r.records, r.chars, r.bytes) for r in rollup.status_profile(df, "source").collect()}
    assert p == {"a": (2, 3, 3), "b": (1, 1, 2), None: (1, 0, 0)}
    s = rollup.line_statistics(df.where("text IS NOT NULL")).first()
    assert (s.documents, s.total_chars, s.median_chars, s.max_lines) == (3, 4, 1.0, 2)
    counts = df.select("source", F.col("doc_id").alias("token_count"))
    assert {r.source: r.share for r in rollup.shares(counts, "source").collect()} == {"a": 0.3, "b": 0.3, None: 0.4}
    assert rollup.per_work(df.withColumnRenamed("source", "work_id")).count() == 3


def test_reports(spark):
    df = records(spark, [dict(title="a|b"), dict(), dict(text="other\nline", title=None)])
    kept, rejected = dedup.deduplicate(df)
    hashed = dedup.with_digests(df)
    text = reports.dedup_report("Report", "2026-01-01T00:00:00Z", 3, kept, rejected, dedup.groups(hashed, "text_sha256"), dedup.canonical_review(hashed), dedup.clusters(kept), dedup.validation(kept))
    assert "- Removed records: 1" in text and "2026-01-01\n" in text and "| v0, v1 |" in text
    assert reports.escape("a|b\nc") == r"a\|b c" and reports.escape(None) == ""
    counts = tokens.count_records(df).withColumn("_ord", F.lit(1))
    out = json.loads(reports.token_summary(rollup.sums(counts), rollup.top(counts), rollup.tokenizer_of(counts)))
    assert out["documents"] == 3 and out["by_period"] == {"null": 4} and out["top_10_works"] == [["w", 4]]
    assert "- reject: 0" in reports.scan_summary(rollup.class_histogram(spark.createDataFrame([("ocr_gold",)], "ocr_quality_class string")))


def test_plans_stay_in_the_jvm(spark):
    """No Python where SQL functions do, and no text in a shuffle that decides duplicates."""
    df = records(spark, [dict()])
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan(tokens.count_records(df)) and "Python" not in plan(df.select(fn.strip_tags(F.col("text"))))
    assert "Window" not in plan(dedup.exact_decisions(dedup.with_digests(df)))
