import re

from conftest import prose

from textloom.llm import licenses


def grams(text):
    w = re.sub(r"[\W_]+", " ", text.lower()).split()
    return set(zip(w, w[1:]))


def brute(text):
    lines = (text or "").split("\n")
    units = lines + [p for p in re.split(r"\n[^\w\n]*\n\s*", text or "") if "\n" in p.strip()]
    if re.search(r"\n[^\w\n]*\n", text or ""):
        units.append(text)
    found = set()
    for u in units:
        a = grams(u)
        for name, t in licenses.TEMPLATES:
            b = grams(t)
            if a and 2 * len(a & b) / (len(a) + len(b)) >= licenses.THRESHOLD:
                found.add(name)
    return ",".join(sorted(found))


def test_equals_brute_force(make_docs, clashing):
    mit = licenses.TEMPLATES[5][1].split()
    wrapped = "\n".join(" ".join(mit[i : i + 9]) for i in range(0, len(mit), 9))
    texts = [None, "", "one", "All rights reserved.", "ALL  RIGHTS, reserved!", "rights all reserved", prose(1, 60) + "\nReleased under the MIT License.", "x\n\n" + wrapped + "\n\n" + prose(2, 30), wrapped, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.",
             "This work is licensed under the GNU General Public License version 2", prose(3, 20_000), "\n" * 50, "reserved " * 3000]
    docs = clashing(make_docs(list(enumerate(texts)) + [(None, "All rights reserved."), (3, "nothing")]), "unit", "units", "matches", "norm", "licence", "dice", "words")
    got = sorted(((r.doc_id, r.licences) for r in licenses.summary(licenses.scan(docs)).collect()), key=str)
    assert got == sorted([(i, brute(t)) for i, t in enumerate(texts)] + [(None, "proprietary"), (3, "")], key=str)


def test_matches(make_docs):
    m = licenses.scan(make_docs([(1, "a\nReleased under the MIT License.\n\nmore\nlines")])).first().matches
    assert ("line", 1, "MIT", 1.0) in [tuple(x) for x in m]
    assert licenses.scan(make_docs([])).collect() == []
    assert licenses.scan(make_docs([(1, "x")]), templates=[("none", "word")]).first().matches == []


def test_bounds():
    for n in range(1, 60):
        low, high = licenses.bounds(n)
        sizes = [m for m in range(1, 200) if 2 * min(m, n) / (m + n) >= licenses.THRESHOLD]
        assert (low, high) == (min(sizes), max(sizes))
