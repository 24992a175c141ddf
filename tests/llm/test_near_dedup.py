import random
import re

import numpy as np
import pytest
from conftest import prose  # noqa: F401  of this folder

from textloom.llm import _words, near_dedup
from textloom.llm.components import components


def shingles(text, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and den * both >= num * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            smallest[find(i)] = min(d, smallest.get(find(i), d))
    return sorted(((d, len(sets[i]), smallest.get(find(i)), d == smallest.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def edited(text, rng, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.random():.6f}"
    return " ".join(w)


def corpus():
    rng = random.Random(1)
    texts = [None, "", " \n\t", "one", "ONE", "one two", "one two three", "One  two\nthree", "é É", "É é"]
    for s in range(6):
        base = prose(s, 120)
        texts += [base, base, base.upper()] + [edited(base, rng, n) for n in (1, 2, 3, 4, 5, 6, 8, 12) for _ in range(3)]
    # a chain: each links to the next
    w = prose(77, 200).split()
    texts += [" ".join(w[i * 4 : i * 4 + 100]) for i in range(12)]
    rng.shuffle(texts)
    return [(i * 3 % 1009, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("how", [dict(words=3, num=85, den=100), dict(words=5, num=80, den=100), dict(words=3, num=85, den=100, block_sets=4), dict(words=3, num=85, den=100, block_shingles=150)])
def test_equals_brute_force(make_docs, clashing, how):
    rows = corpus() + [(None, "one two three"), (None, "quite alone here"), (0, "same id another text")]
    docs = clashing(make_docs(rows), "node", "grp", "chunks", "component", "kept", "s1", "row", "n", "bands", "h")
    got = sorted((tuple(r) for r in near_dedup.near_duplicates(docs, **how).collect()), key=str)
    want = [(d, n, c, d == c) for d, n, c, _ in brute(rows, how["words"], how["num"], how["den"])]
    assert got == sorted(want, key=str)


def test_large_group_of_near_copies(make_docs):
    """A group larger than a block: all are found, and no task gets more than two blocks."""
    rng, base = random.Random(5), prose(9, 150)
    rows = [(i, edited(base, rng, rng.choice((0, 1, 2, 3)))) for i in range(300)]
    got = sorted((tuple(r) for r in near_dedup.near_duplicates(make_docs(rows), words=3, num=85, den=100, block_sets=16).collect()), key=str)
    assert got == sorted(brute(rows, 3, 85, 100), key=str)


def sets_of(spark, texts, block, chunks=None):
    rows = []
    for i, t in enumerate(texts):
        x = near_dedup.Shingler(3)(t)
        rows.append((i, 0, len(x), len(texts), chunks or -(-len(texts) // block), x.tobytes()))
    return near_dedup.stage(spark.createDataFrame(rows, "node bigint, grp bigint, n bigint, size bigint, chunks int, body binary"), "sets")


def test_near_copies_are_read_once(spark):
    """A group of near copies is one component after the first pass, so that nothing is left for the second."""
    rng, base = random.Random(3), prose(31, 150)
    sets = sets_of(spark, [edited(base, rng, rng.choice((1, 2))) for _ in range(400)], 32)
    of = near_dedup.confirmed(sets, sets, 85, 100, 32, 500_000)
    assert {tuple(r) for r in of.collect()} == {(i, 0) for i in range(400)}
    assert near_dedup._apart(sets, of.select(near_dedup.F.col("node").alias("a"), near_dedup.F.col("component").alias("b")), 32, 500_000).collect() == []


def test_components_across_blocks(spark):
    """A chain, two clusters and texts alone in one group, its first set alone, in blocks of a few sets."""
    rng, w = random.Random(4), prose(55, 400).split()
    texts = [prose(56, 100)] + [" ".join(w[i * 4 : i * 4 + 100]) for i in range(60)] + [prose(100 + i, 60) for i in range(20)]
    texts += [edited(prose(s, 120), rng, 1) for s in (61, 62) for _ in range(30)]
    for block in (4, 16):
        sets = sets_of(spark, texts, block)
        got = {r.node: r.component for r in near_dedup.confirmed(sets, sets, 85, 100, block, 500_000).collect()}
        want = {d: c for d, _, c, _ in brute(list(enumerate(texts)), 3, 85, 100)}
        assert {i: got.get(i, i) for i in range(len(texts))} == want


def test_deduplicate_keeps_columns(make_docs):
    rows = [(5, prose(1, 90)), (2, prose(1, 90)), (9, prose(2, 90)), (None, prose(1, 90)), (11, None), (12, "")]
    docs = make_docs(rows)
    out = near_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 9, 11, 12]
    assert near_dedup.near_duplicates(make_docs([])).collect() == []


def test_words_are_byte_runs():
    rng = random.Random(0)
    old, seen = _words.PIECE, {}
    try:
        for _words.PIECE in (7, 50, 1 << 18):
            for _ in range(400):
                t = "".join(rng.choice("abCé \t\n\x0b\x1c\x85\xa0 Z") for _ in range(rng.randint(0, 120)))
                data = _words.lowered(t)
                h, start, stop = _words.words(data)
                found = t.encode().lower().split()
                assert [bytes(data[a:b]) for a, b in zip(start, stop)] == found
                for w, x in zip(found, h.tolist()):
                    assert seen.setdefault(w, x) == x
    finally:
        _words.PIECE = old
    assert len(set(seen.values())) == len(seen)


def test_bands_and_signature():
    assert near_dedup.bands_for(0.85) >= 30
    s = near_dedup.Signer(4)
    x = np.unique(np.random.default_rng(0).integers(0, 2**63, 5000, dtype=np.uint64))
    assert len(s.signature(x)) == 4 * near_dedup.ROWS and s.bands(x) == s.bands(x[::-1])


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in root}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_one_of_null_and_repeated_ids_stays(make_docs):
    a, b = prose(1, 300), prose(2, 300)
    near = a.replace(a.split()[150], "other", 1)
    docs = make_docs([(None, a), (None, near), (None, b), (7, b + " end"), (7, prose(3, 40)), (9, prose(4, 50)), (9, prose(4, 50) + " x"), (11, None), (None, ""), (12, prose(5, 60_000)), (13, prose(5, 60_000) + " more")])
    out = sorted((r.doc_id or 0, len(r.text or "")) for r in near_dedup.deduplicate(docs).collect())
    assert len(out) == 7 and [d for d, _ in out] == [0, 0, 7, 7, 9, 11, 12]
    assert near_dedup.deduplicate(make_docs([])).collect() == []
