import random
import zlib

import numpy as np
import pytest
from conftest import prose

from textloom.llm import _labels, quality, toxicity

BAD = ["zorkwit", "grubface", "slimeball", "nobhead"]


def toxic_corpus(n=600):
    rng, rows, labels = random.Random(1), [], []
    for d in range(n):
        w = prose(d, rng.randint(20, 120)).split(" ")
        y = d % 5 == 0
        if y:
            for _ in range(3 + len(w) // 15):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        rows.append((d, " ".join(w)))
        labels.append((d, 1, int(y)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, make_docs, clashing):
    rows, labels = toxic_corpus()
    docs = clashing(make_docs(rows + [(9000, None), (9001, ""), (None, "plain words here"), (5, rows[6][1]), (9002, (BAD[0] + " ") * 30_000)]), "score", "held_out", "y")
    got = toxicity.predict(docs, spark.createDataFrame(labels + [(None, 1, 1), (7, None, None)], "doc_id bigint, quality int, toxic int")).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    y = {d: t for d, _, t in labels}
    held = [(r.predicted, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y and r.doc_id != 5]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert next(r for r in got if r.doc_id == 9002).predicted == 1


def test_toxicity_of_beginnings_in_a_rarer_language():
    """Toxic words of one language are always the same; those of the other begin alike, with pieces that its ordinary words hold too."""
    rng = random.Random(3)
    pieces = ["ach", "lich", "keit", "ung", "sch", "ver", "ein", "ber", "heit", "ge", "te", "st"]

    def word(start=""):
        return start + "".join(rng.choice(pieces) for _ in range(rng.randint(1, 3)))

    texts, y, rare = [], [], []
    for d in range(1500):
        label, other = int(d % 8 == 0), d % 5 == 0
        w = [word() for _ in range(150)] if other else prose(d, 150).split(" ")
        for _ in range(6 * label):
            w.insert(rng.randrange(len(w)), word("achlich") if other else rng.choice(BAD))
        texts.append(" ".join(w))
        y.append(label)
        rare.append(other)
    model = toxicity.train(texts[:1000], y[:1000])
    got = [(model.scorer()(t) >= 0.7, label, other) for t, label, other in zip(texts[1000:], y[1000:], rare[1000:])]
    for other in (False, True):
        assert np.mean([p for p, label, o in got if label and o == other]) >= 0.7
    assert np.mean([p for p, label, _ in got if not label]) < 0.02


def test_toxicity_scores_against_plain_code():
    """Scores, ratios and calibration again from the dictionaries alone, a document and a window at a time."""
    import zstandard

    rows, labels = toxic_corpus(200)
    texts, y = [t for _, t in rows], [t for _, _, t in labels]
    model = toxicity.train(texts, y)

    def length(content, window):
        shape = zstandard.ZstdCompressionParameters(window_log=17, hash_log=17, chain_log=17, search_log=4, min_match=4, strategy=zstandard.STRATEGY_BTOPT, write_checksum=0, write_content_size=0, write_dict_id=0)
        return len(zstandard.ZstdCompressor(compression_params=shape, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress(window))

    def plain(text):
        w = [x[:5].upper() + x[5:] for x in "".join(c for c in text.lower() if c.isalnum() or c.isspace()).split()]
        total, at = 0.0, 0
        while True:
            window = (" " + " ".join(w[at : at + 8]) + " ").encode()
            d = length(model.ordinary, window) - length(model.toxic, window)
            total += model.ratio[min(max(d, toxicity.LOW), toxicity.HIGH) - toxicity.LOW]
            at += 4
            if at >= len(w) - 4:
                return total

    score = model.scorer()
    for t in (*texts[:12], "", "one", "a b c d e", texts[5] * 30):
        x = plain(t)
        below, above = max((k for k in model.knots if k <= x), default=model.knots[0]), min((k for k in model.knots if k >= x), default=model.knots[-1])
        a, b = (float(model.values[list(model.knots).index(k)]) for k in (below, above))
        assert score(t) == pytest.approx(a if below == above else a + (b - a) * (x - below) / (above - below) if below <= x <= above else float(np.interp(x, model.knots, model.values)))
    # the toxic dictionary is trained on nothing but words of toxic documents
    known = {w for t, label in zip(texts, y) if label for w in toxicity.words(t)}
    assert {w for t, label in zip(texts, y) if label for w in toxicity.passages(t, {"ZORKW"}).decode().lower().split()} <= known


def test_toxicity_learns_from_one_row_of_a_repeated_doc_id(spark, make_docs):
    rows, labels = toxic_corpus(60)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    one, many = (toxicity.fit(make_docs(r), table) for r in (rows, rows + rows[:20] * 3))
    assert one.ordinary == many.ordinary and one.toxic == many.toxic and np.allclose(one.ratio, many.ratio)


def test_models_without_labels(spark, make_docs):
    docs, none = make_docs([(1, "a b"), (2, None)]), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in toxicity.predict(docs, none).collect()} == {0.0}
    assert {r.score for r in quality.predict(docs, none).collect()} == {0.5}
    assert toxicity.predict(make_docs([]), none).collect() == [] and quality.predict(make_docs([]), none).collect() == []
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in quality.predict(docs, one).collect() + toxicity.predict(docs, one).collect())


@pytest.fixture(scope="module")
def quality_corpus():
    rng, rows, labels = random.Random(2), [], []
    for d in range(600):
        t = prose(d, rng.randint(5, 150))
        kind = d % 6
        if kind == 0:
            t = " ".join(w + rng.choice(("***", "&&&", "###")) for w in t.split())
        elif kind == 1:
            t = " ".join(w.upper() + "!!" for w in t.split())
        rows.append((d, t))
        labels.append((d, int(kind > 1), 0))
    return rows, labels


def test_quality_on_held_out_rows(spark, make_docs, clashing, quality_corpus):
    rows, labels = quality_corpus
    docs = clashing(make_docs(rows + [(9000, None), (9001, ""), (None, "plain words"), (9002, "x " * 200_000)]), "x", "score", "bin")
    got = quality.predict(docs, spark.createDataFrame(labels + [(None, 0, 0), (8, None, None)], "doc_id bigint, quality int, toxic int")).collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    y = {d: q for d, q, _ in labels}
    assert np.mean([r.predicted == y[r.doc_id] for r in got if r.held_out and r.doc_id in y]) > 0.97


def test_quality_against_plain_code(spark, make_docs, quality_corpus):
    """The normal equations, both folds' weights and the calibration once more, over all rows at once."""
    rows, labels = quality_corpus
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    measured = quality.measure(make_docs(rows)).persist()
    model = quality.fit(measured, table)
    x = {d: np.array(quality.statistics(t)) for d, t in rows}
    every = np.array(list(x.values()))
    assert np.allclose(model.mean, every.mean(0)) and np.allclose(model.scale, np.where(every.std(0) > 1e-9, every.std(0), 1))
    fold = {r.doc_id: r.f for r in spark.range(600).selectExpr("id doc_id", "pmod(xxhash64(id), 2) f").collect()}
    some = [(d, q) for d, q, _ in labels if zlib.crc32(str(d).encode()) % 3 != 1]
    p, y, f = model.features(np.array([x[d] for d, _ in some])), np.array([q for _, q in some], float), np.array([fold[d] for d, _ in some])

    def ridge(of):
        penalty = quality.PENALTY * of.sum() * np.eye(p.shape[1])
        penalty[0, 0] = 1e-9 * of.sum()
        return np.linalg.solve(p[of].T @ p[of] + penalty, p[of].T @ y[of])

    assert np.allclose(p @ model.weights, p @ ridge(f >= 0), atol=1e-6)
    raw = np.where(f == 0, p @ ridge(f == 1), p @ ridge(f == 0))
    bins = np.round(raw / quality.STEP) * quality.STEP
    knots, values = _labels.isotonic(bins, y)
    want = {d: np.clip(np.interp(model.features(v[None]) @ ridge(f >= 0), knots, values), 0, 1)[0] for d, v in x.items()}
    got = {r.doc_id: r.score for r in quality.score(measured, model).collect()}
    assert np.mean([abs(got[d] - want[d]) < 1e-3 for d in x]) > 0.98  # a row on a bin's edge may fall to either side


def test_quality_keep(spark, make_docs, quality_corpus):
    rows, labels = quality_corpus
    docs, table = make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    kept = quality.keep(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.predict(docs, table).collect() if r.predicted}


def test_labels_are_never_inputs(spark, make_docs, quality_corpus):
    """Scores depend on the text alone: the same text under other ids, languages and sources scores the same."""
    rows, labels = quality_corpus
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = make_docs(rows)
    model = quality.fit(quality.measure(docs).persist(), table)
    other = make_docs([(d + 10**6, t, "other") for d, t in rows])
    a = {r.doc_id: r.score for r in quality.score(quality.measure(docs), model).collect()}
    b = {r.doc_id - 10**6: r.score for r in quality.score(quality.measure(other), model).collect()}
    assert a == b


def test_isotonic():
    x, y = np.array([0.0, 1, 2, 3, 4]), np.array([0.0, 1, 0, 1, 1])
    knots, values = _labels.isotonic(x, y)
    assert np.all(np.diff(values) >= 0) and np.allclose(np.interp([0, 1, 2, 3, 4], knots, values), [0, 0.5, 0.5, 1, 1])


def test_statistics_of_odd_texts():
    for t in (None, "", " ", "\n", "é", "x" * 10**6, "\ud800"):
        s = quality.statistics(t)
        assert len(s) == len(quality.STATISTICS) and np.all(np.isfinite(s))
