import hashlib
import random
from collections import defaultdict

import pytest

from textloom.llm import mixing


def brute(rows, seed=0):
    sizes, of = defaultdict(int), defaultdict(list)
    for d, t, s in rows:
        sizes[s] += (n := len((t or "").split()))
        of[s].append((int(hashlib.md5((f"{seed}:{d}" if d is not None else str(seed)).encode()).hexdigest()[:15], 16), d is not None, d or 0, n))
    targets = mixing.water_level(dict(sizes), mixing.cyclic_weights(sizes), 1.5 * sum(sizes.values()))
    out = []
    for s, docs in of.items():
        whole = int(targets[s] // sizes[s]) if sizes[s] else 0
        rest, before = targets[s] - whole * sizes[s], 0
        for _, known, d, n in sorted(docs):
            out.append((d if known else None, n, sizes[s], targets[s], n * (whole + (before + n / 2 <= rest))))
            before += n
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(make_docs, clashing, seed):
    rng = random.Random(seed)
    rows = [(d, " ".join("w" for _ in range(rng.choice((0, 1, 5, 50, 300)))), rng.choice(["a", "a", "a", "b", "é", "", None, "z"])) for d in range(400)] + [(7, "twice", "a"), (None, "no id", "b"), (500, None, "b")]
    docs = clashing(make_docs(rows), "size", "pattern", "copies", "target", "taken", "rest", "whole")
    got = [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mixing.mix_by_source(docs).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    taken, target = defaultdict(int), {}
    for r in mixing.mix_by_source(docs).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 300 for s in target)


def test_water_level():
    sizes = {"a": 100, "b": 100, "c": 100, None: 0}
    t = mixing.water_level(sizes, {"a": 3, "b": 1, "c": 2, None: 3}, 450)
    assert t[None] == 0 and t["a"] == 200 and abs(sum(t.values()) - 450) < 1e-9 and all(t[s] <= 2 * sizes[s] for s in sizes)
    assert mixing.water_level({}, {}, 0) == {}


def least_cost(supply, members, quota, copies):
    """Greatest flow and its least cost, trying all ways of whole units."""
    best = {}

    def go(patterns, left, flow, cost):
        if not patterns:
            best[flow] = min(cost, best.get(flow, cost))
            return
        p, rest = patterns[0], patterns[1:]

        def spread(sources, amount, left):
            if not sources:
                yield amount, left
                return
            for x in range(min(left[sources[0]], supply[p] * copies - amount) + 1):
                yield from spread(sources[1:], amount + x, {**left, sources[0]: left[sources[0]] - x})

        for amount, after in spread(members[p], 0, left):
            go(rest, after, flow + amount, cost + sum(k // supply[p] + 1 for k in range(amount)))

    go(sorted(supply), quota, 0, 0)
    return max(best), best[max(best)]


def test_flow_is_the_cheapest_of_the_greatest():
    rng = random.Random(4)
    for _ in range(25):
        supply = {p: rng.randint(1, 3) for p in "PQR"}
        members = {p: sorted(rng.sample("abc", rng.randint(1, 3))) for p in supply}
        quota = {s: rng.randint(0, 5) for s in "abc"}
        sent = mixing.flow(supply, members, quota)
        total = sum(sum(x.values()) for x in sent.values())
        cost = sum(k // supply[p] + 1 for p in sent for k in range(round(sum(sent[p].values()))))
        assert (round(total), cost) == least_cost(supply, members, quota, 2)
        assert all(sum(sent[p].get(s, 0) for p in sent) <= quota[s] + 1e-9 for s in quota)


def test_overlapping_sources(spark):
    rows = [(d, ["a", "b"] if d % 3 == 0 else ["a"] if d % 3 == 1 else ["b"], 10) for d in range(300)] + [(1000, None, 5), (1001, [], 5)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, sources array<string>, size bigint"), {"a": 1000.0, "b": 2500.0}).collect()
    total = sum(r.size * r.copies for r in out)
    assert abs(total - 3500) <= 30 and all(0 <= r.copies <= 2 for r in out) and len(out) == 302
    assert all(r.copies == 0 for r in out if r.doc_id >= 1000)


def test_mixed_rows(make_docs):
    docs = make_docs([(d, "w " * (d % 7), "ab"[d % 2]) for d in range(60)])
    copies = {r.doc_id: r.copies for r in mixing.mix_by_source(docs).collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert dict(got) == {d: c for d, c in copies.items() if c}
    assert mixing.mix_by_source(make_docs([])).collect() == [] and mixing.mixed(make_docs([])).collect() == []


@pytest.mark.parametrize("same_text", [False, True])
def test_many_rows_of_one_id(make_docs, monkeypatch, same_text):
    """Of rows that share a doc_id, null here, some are taken and some are not, and the source's words come near its target."""
    monkeypatch.setattr(mixing, "LEAST_HOT", 50)
    docs = make_docs([(None, "same old words" if same_text else f"text {d} is here", "a") for d in range(400)] + [(d, "one two three four", "ab"[d % 2]) for d in range(800)])
    out = mixing.mix_by_source(docs).collect()
    assert len(out) == 1200
    taken, target = defaultdict(int), {}
    for r in out:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 4 for s in target)
    assert len({r.copies for r in out if r.doc_id is None}) == 2
    assert sorted((r.source, r.copies) for r in out) == sorted((r.source, r.copies) for r in mixing.mix_by_source(docs).collect())
