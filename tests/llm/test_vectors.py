import numpy as np
import pytest

from textloom.llm import ann, cover_tree

VECTORS = "vec_id bigint, embedding array<float>, label int"
ODD = [(10_000, None, 0), (10_020, [], 0), (10_040, [1.0, None, 2.0], 0), (10_060, [float("nan")] * 8, 0), (10_080, [float("inf")] + [0.0] * 7, 0), (None, [1.0] * 8, 0), (10_100, [1.0, 2.0], 0)]


def rows(seed, n, dim=8, clusters=5, equal=0):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(clusters, dim))
    x = c[rng.integers(0, clusters, n)] + 0.4 * rng.normal(size=(n, dim))
    x[:equal] = x[0]
    return x.astype(np.float32)


def brute(x, k, value=lambda x: x):
    v = value(x.astype(float))
    out = set()
    for q in range(0, len(x), 20):
        s = v @ v[q]
        order = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-s[i], i))[:k]
        out |= {(q, r + 1, i, int(s[i])) for r, i in enumerate(order)}
    return out


@pytest.mark.parametrize("how", [{}, {"block": 40, "query_block": 3}])
@pytest.mark.parametrize("equal", [0, 120])
def test_top_k_equals_brute_force(spark, clashing, how, equal):
    x = rows(1, 400, equal=equal)
    df = clashing(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)] + ODD, VECTORS), "v", "d", "q", "dim", "score", "rank")
    got = cover_tree.top_k(df, 20, value=cover_tree.quantised(64), **how).collect()
    assert {(r.query_id, r["rank"], r.vec_id, int(r.score)) for r in got if r.query_id < 10_000} == brute(x, 20, lambda x: np.floor(64 * x))
    assert not [r for r in got if r.query_id >= 10_000 and r.query_id != 10_100]


def check_tree(root, x, leaf):
    for node in (todo := [root]):
        d = np.sqrt(((x[node.points] - node.center) ** 2).sum(1))
        assert d.max(initial=0) <= node.radius + 1e-6
        if node.children:
            assert sorted(p for c in node.children for p in c.points) == sorted(node.points) and all(len(c.points) for c in node.children)
            assert 2 <= len(node.children) <= cover_tree.CHILDREN
            todo.extend(node.children)
        else:
            assert len(node.points) <= leaf or not np.ptp(x[node.points], axis=0).any()


@pytest.mark.parametrize("dim, clusters, equal", [(3, 40, 0), (64, 1, 0), (64, 1, 900), (2, 1, 3000)])
def test_every_leaf_is_small(dim, clusters, equal):
    """Also where all points lie about equally apart."""
    x = rows(3, 3000, dim=dim, clusters=clusters, equal=equal).astype(float)
    check_tree(cover_tree.build(x, 16), x, 16)
    scales = np.concatenate([x[:50] * 10.0**-i for i in range(40)])  # a level for each scale
    check_tree(cover_tree.build(scales, 4), scales, 4)


def test_tree_prunes():
    x = rows(3, 3000, dim=3, clusters=40).astype(float)
    stats, q = {}, np.arange(0, 3000, 20)
    scores, ids = cover_tree.search(x[q], q, x, np.arange(3000), 5, stats=stats)
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    assert np.allclose(scores, -np.sort(-s, 1)[:, :5]) and stats["pairs"] < 0.5 * len(q) * 3000
    low = scores[:, 4].copy()
    again, _ = cover_tree.search(x[q], q, x, np.arange(3000), 5, low, stats := {})
    assert np.allclose(scores, again)


def test_top_k_sends_queries_to_balls_within_reach(spark, monkeypatch):
    """On clustered vectors most pairs of balls and queries are never sent."""
    x = rows(11, 4000, dim=4, clusters=25)
    seen, plain = [], cover_tree.stage
    monkeypatch.setattr(cover_tree, "stage", lambda df, label, spark=None: (seen.append((label, out := plain(df, label, spark))), out)[1])
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    got = cover_tree.top_k(df, 20, value=cover_tree.quantised(64), block=200, query_block=40, sample=1000).collect()
    assert {(r.query_id, r["rank"], r.vec_id, int(r.score)) for r in got} == brute(x, 20, lambda x: np.floor(64 * x))
    table = dict(seen)
    whole = table["cover-dealt"].select("d").distinct().count() * 200
    assert table["cover-visits"].select("d", "vec_id").distinct().count() < 0.5 * whole


@pytest.mark.parametrize("search", [lambda df: cover_tree.top_k(df, 3, sample=40), lambda df: ann.neighbours(df, 3)])
def test_each_length_is_searched_apart(spark, search):
    rng = np.random.default_rng(2)
    x = [rng.normal(size=8 if i % 40 else 5 if i % 3 else 2).tolist() for i in range(400)]
    got = {}
    for r in search(spark.createDataFrame([(i, v, 0) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label int")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    right = 0
    for q in range(0, 400, 20):
        want = sorted((i for i in range(400) if i != q and len(x[i]) == len(x[q])), key=lambda i: (-np.dot(x[i], x[q]), i))[:3]
        assert len(got[q]) == len(want)
        right += [got[q][i + 1] for i in range(len(want))] == want
    assert right >= 18


def test_top_k_of_few(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (20, [1.0, 1.0], 0), (1, [0.0, 0.0], 0)], VECTORS)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in cover_tree.top_k(few, 5).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 1.0), (0, 2, 1, 0.0), (20, 1, 0, 1.0), (20, 2, 1, 0.0)]
    assert cover_tree.top_k(spark.createDataFrame([], VECTORS)).collect() == [] and cover_tree.top_k(spark.createDataFrame([(0, [1.0], 0)], VECTORS)).collect() == []


@pytest.mark.parametrize("equal", [0, 700])
def test_ann_recall(spark, clashing, equal):
    x = rows(5, 2000, dim=16, clusters=12, equal=equal)
    df = clashing(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)] + ODD + [(10_120, [0.0] * 16, 0)], VECTORS), "list", "piece", "code", "low", "v")
    got = ann.neighbours(df, 20, list_rows=64, piece=100, queries=30).collect()
    want, found = {}, {}
    s = x.astype(float) @ x.astype(float).T
    for q in range(0, 2000, 20):
        want[q] = {i for i in sorted((i for i in range(2000) if i != q), key=lambda i: (-s[q, i], i))[:20]}
    for r in got:
        assert abs(r.score - s[r.query_id, r.vec_id]) < 1e-9 and r.vec_id != r.query_id
        found.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    assert set(found) == set(want) and np.mean([len(want[q] & {v for _, v in found[q].values()}) / 20 for q in want]) >= 0.9
    for ranks in found.values():
        assert sorted(ranks) == list(range(1, 21)) and [ranks[i] for i in sorted(ranks)] == sorted(ranks.values(), key=lambda x: (-x[0], x[1]))


def test_ann_of_few(spark):
    assert ann.neighbours(spark.createDataFrame([], VECTORS)).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.5, 0.0], 0), (2, [2.0, 0.0], 0)], VECTORS)
    assert [(r.query_id, r.vec_id, r.score) for r in ann.neighbours(few).orderBy("rank").collect()] == [(0, 2, 2.0), (0, 1, 0.5)]


def test_ann_recall_on_rows_beyond_the_sample(spark, monkeypatch):
    """Lists don't outgrow the sample that they are fitted on."""
    sizes, plain = [], ann.fit
    monkeypatch.setattr(ann, "fit", lambda x, lists, **how: (sizes.append((len(x), lists, len(how["measured"]))), plain(x, lists, **how))[1])
    x = np.random.default_rng(7).normal(size=(6000, 16)).astype(np.float32)
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    found = {}
    for r in ann.neighbours(df, 20, list_rows=8, sample=800).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    s = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(s, -np.inf)
    recall = np.mean([len(found[q] & set(np.argsort(-s[q])[:20].tolist())) / 20 for q in range(0, 6000, 20)])
    assert sizes == [(800, 20, 200)] and recall >= 0.9, (sizes, recall)


def test_ann_goes_on_where_lists_are_short(spark):
    """A query in a list of few rows has all its ranks although one list is visited."""
    x = rows(9, 400, dim=4, clusters=3)
    x[:5] = np.array([50.0, 0, 0, 0]) + 0.01 * x[:5]
    got = ann.neighbours(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS), 20, probes=1, list_rows=50).collect()
    assert sorted(r["rank"] for r in got if r.query_id == 0) == list(range(1, 21))
