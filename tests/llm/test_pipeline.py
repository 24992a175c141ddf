import random

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, make_docs, tmp_path):
    from conftest import prose

    rng, rows, labels = random.Random(6), [], []
    for d in range(240):
        t, good = prose(d, rng.randint(30, 90)), d % 4 != 0
        if not good:
            t = " ".join(w.upper() + "!!" for w in t.split())
        rows.append((d, t, f"s{d % 3}"))
        labels.append((d, int(good), 0))
    copy = rows[1][1]
    near = copy.split(" ")
    near[10] = "changed"
    rows += [(900, copy, "s0"), (901, " ".join(near), "s1"), (902, None, "s1"), (903, "", None)]
    docs = make_docs(rows)
    sf = str(tmp_path / "sf")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    kept = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, kept, sf)
        assert out.columns == docs.columns, name
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        if name == "quality classifier":
            ids = {r.doc_id for r in kept.collect()}
            assert len([d for d, good, _ in labels if good and d not in ids]) <= 3 and len([d for d, good, _ in labels if not good and d in ids]) <= 3
    ids = {r.doc_id for r in kept.collect()}
    assert not {900, 901} <= ids and 900 not in ids
    final = corpus_pipeline.run(spark, sf).collect()
    assert final and all(r.n_tokens == len(r.ids) for r in final)
    assert [n for n, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None


def test_no_documents_and_odd_ones(spark, make_docs, tmp_path):
    """Empty tables give no rows; null, empty, repeated and very long texts, null ids and labels pass all stages."""
    from conftest import prose

    def run(rows, labels):
        sf = str(tmp_path / f"sf{len(rows)}")
        make_docs(rows).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        return corpus_pipeline.run(spark, sf).collect()

    assert run([], []) == []
    rows = [(d, prose(d, 60), None if d % 5 == 0 else "a") for d in range(40)] + [(None, None), (None, prose(1, 60)), (3, prose(3, 60)), (50, ""), (51, prose(51, 30_000)), (52, " \n "), (None, prose(60, 60))]
    out = run(rows, [(d, 1, None) for d in range(40)] + [(None, 0, 1), (41, None, None)])
    texts = {r.ids_sha256 for r in out}
    assert len(texts) == 44 and all(r.n_tokens == len(r.ids) for r in out) and max(r.n_tokens for r in out) > 30_000
