import random
import re

import pytest
from conftest import prose

from textloom.llm import line_dedup


def spaced(text):
    """(start, stop, form) of words, plainly."""
    return [(w.start(), w.end(), w.group().lower()) for w in re.finditer(rb"[^\x20\x09-\x0D]+", (text or "").encode())]


def brute(rows, window):
    """Words that lie in a window of so many words whose first place is another one."""
    seen, gone = {}, {}
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        forms = [f for *_, f in spaced(text)]
        gone[d] = set()
        for i in range(len(forms) - window + 1):
            first = seen.setdefault(tuple(forms[i : i + window]), (d, i))
            if first != (d, i):
                gone[d].update(range(max(i, first[1] + window) if first[0] == d else i, i + window))
    return gone


def corpus(seed):
    rng, out = random.Random(seed), []
    passages = [prose(1000 + seed * 10 + k, n) for k, n in enumerate((51, 60, 75, 100, 140))]
    for d in range(40):
        parts = [prose(seed * 100 + d * 7 + k, rng.randint(3, 40)) for k in range(3)]
        for p in rng.sample(passages, rng.choice((0, 0, 1, 2))):
            parts.insert(rng.randint(0, 3), p)
        if d % 3 == 0:
            # in the middle of a sentence, a line and a passage
            own, p = prose(seed * 100 + d, 60).split(" "), rng.choice(passages).split(" ")
            cut = rng.randint(0, 12)
            parts.append(" ".join(own[:7] + p[cut : cut + rng.randint(49, 55)] + own[7:]))
        parts.insert(rng.randint(0, len(parts)), "A short common line.")
        out.append((d, rng.choice(("\n", "\n\n", ". ")).join(parts)))
    return out + [(100, out[3][1]), (101, out[4][1] + "\n" + prose(5, 20)), (102, None), (103, ""), (104, "word"), (105, "w. " * 40)]


def check(rows, report):
    got, want = {r.doc_id: r for r in report.collect()}, brute(rows, line_dedup.WINDOW)
    for d, text in rows:
        all_, r = spaced(text), got[d]
        gone = {i for i, (a, b, _) in enumerate(all_) if any(s.start <= a and b <= s.stop for s in r.spans)}
        assert gone == want[d] and r.removed_words == len(gone) and r.n_removed == len(r.spans), d
        assert r.text == text or [f for *_, f in spaced(r.text)] == [f for i, (*_, f) in enumerate(all_) if i not in gone]
    return want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force_over_documents(make_docs, clashing, seed):
    rows = corpus(seed)
    want = check(rows, line_dedup.report(clashing(make_docs(rows), "h", "units", "start", "stop", "key", "runs", "after", "print", "of", "n")))
    assert sum(map(bool, want.values())) > 15


def test_passages_in_the_middle_of_sentences(make_docs):
    """Blocks around a passage differ in every document, and its exact copies of one document in none."""
    p = prose(1, 70).replace(".", "").split(" ")
    rows = [(d, " ".join(prose(10 + d, 31).split(" ")[:-3] + p[d % 9 :] + prose(50 + d, 20).split(" "))) for d in range(30)]
    rows += [(100 + d, rows[d % 3][1]) for d in range(30)]
    want = check(rows, line_dedup.report(make_docs(rows)))
    assert want[0] == set() and all(len(want[d]) >= 61 for d in range(9, 30))


def test_one_passage_in_a_third_of_all_rows(make_docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT", 0.0)
    monkeypatch.setattr(line_dedup, "LEAST_HOT", 20)
    p = prose(1, 120)
    rows = [(d, prose(100 + d, 25) + (" " + p if d % 3 == 0 else "")) for d in range(600)]
    check(rows, line_dedup.report(make_docs(rows)))


def test_within_a_document(make_docs):
    p = prose(1, 60)
    rows = [(1, p + "\n" + prose(2, 20) + "\n" + p), (2, "ha. " * 200), (3, prose(4, 40_000))]
    got = check(rows, line_dedup.report(make_docs(rows)))
    assert len(got[1]) == 60 and len(got[2]) == 150 and not got[3]


def test_deduplicate(make_docs):
    p = prose(1, 80)
    docs = make_docs([(7, p), (3, p), (None, p), (4, prose(2, 30) + "\n" + p), (8, None), (9, " "), (3, p)])
    out = {r.doc_id: r for r in line_dedup.deduplicate(docs).collect()}
    assert set(out) == {3, 4, 8, 9} and out[4].text == prose(2, 30).rstrip() and out[4].n_chars == len(out[4].text)
    assert line_dedup.deduplicate(docs).count() == 5 and line_dedup.deduplicate(docs, drop_empty=False).count() == 7
    assert line_dedup.report(make_docs([])).collect() == []


def test_full_filter_only_costs_time(make_docs, monkeypatch):
    """Where the bit map is full, all blocks and windows are joined and the result is the same."""
    monkeypatch.setattr(line_dedup, "_filter", lambda often: __import__("numpy").full((line_dedup.SEGMENTS, line_dedup.SEGMENT_BITS // 8), 255, "uint8"))
    rows = corpus(1)
    check(rows, line_dedup.report(make_docs(rows)))
