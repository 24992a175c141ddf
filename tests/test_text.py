import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from textloom.functions import boilerplate, markup, scan_quality
from textloom.functions import text as fn


def apply(spark, column, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.x for r in df.select("i", column.alias("x")).orderBy("i").collect()]


ODD = ["", " ", "plain text", "Straße ß", "SS", "ﬁne ﬂy", "a\u00a0b", "ＦＵＬＬ width", "İstanbul", "e\u0301te", "x\u2028y\u3000z", "tab\tend \n", "naïve café—x_1 ²", "🙂 emoji", "\x1c\x1d", "ab\x85cd", "ÀÉ\u0327"]


def random_texts(n=200):
    rng = random.Random(1)
    return ["".join(rng.choice("ab .,;!?\n\t\r\f-—12ßé\u00a0\u2028Ａ﷐ﬁ") for _ in range(rng.randint(0, 60))).replace("\ufdd0", "") for _ in range(n)]


@pytest.mark.parametrize("name", ["canonical", "nfc", "tidy", "clean", "tokens", "lines", "strip"])
def test_as_python(spark, name):
    def tidy(t):
        lines = [x.rstrip() for x in unicodedata.normalize("NFC", t.replace("\f", "\n")).split("\n")]
        return re.sub(r"\n{3,}", "\n\n", "\n".join(lines).strip())

    def clean(t):
        t = re.sub(r"(?m)^[ \t]*[\d\-—–]+[ \t]*$", "", re.sub(r"\n{3,}", "\n\n", t))
        t = re.sub(r"([.,:;!?])\s+", r"\1 ", re.sub(r"\s+([.,:;!?])", r"\1", t))
        return unicodedata.normalize("NFC", re.sub(r"\n +", "\n", re.sub(" +", " ", t)).strip())

    c = F.col("text")
    ours, theirs = {
        "canonical": (fn.canonical(c), lambda t: re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t)).strip().casefold()),
        "nfc": (fn.nfc(c), lambda t: unicodedata.normalize("NFC", t)),
        "tidy": (fn.tidy(c), tidy),
        "clean": (fn.clean_scan(c), clean),
        "tokens": (fn.token_count(c), lambda t: len(re.findall(r"\w+|[^\w\s]", t))),
        "lines": (fn.line_count(c), lambda t: t.count("\n") + 1 if t else 0),
        "strip": (fn.strip(c), str.strip),
    }[name]
    # combining marks are no letters for the JVM's class, nor for Python's \w
    texts = ODD + random_texts()
    assert apply(spark, ours, texts) == [theirs(t) for t in texts]
    assert apply(spark, ours, [None]) == [None]


@pytest.mark.parametrize("column", [fn.nfc, fn.canonical, boilerplate.between_markers, boilerplate.without_scan_headers, fn.clean_scan, markup.html_text, markup.text_of_epub])
def test_few_texts_at_a_time_go_to_python(spark, column):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(n) for n in names]
    try:
        for asked, held in (("10000", 500), ("-1", 500), ("7", 7)):
            spark.conf.set(names[0], asked)
            spark.conf.set(names[1], "67108864b")
            column(F.col("text"))
            assert [int(spark.conf.get(n)) for n in names] == [held, 2 << 20]
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def test_five_tokens(spark):
    assert apply(spark, fn.token_count(F.col("text")), ["naïve café—x_1 ²"]) == [5]


START, END = "*** START OF THE PROJECT GUTENBERG EBOOK X ***", "*** END OF THE PROJECT GUTENBERG EBOOK X ***"
STARS = "*" * 25 + "\nnotice\n" + "*" * 25 + "\n\n"


def test_between_markers(spark):
    cases = {
        f"head\n{START}\nbody\n{END}\ntail": ("body", True, 0, 2, 4),
        f"{START}\nbody": ("body", False, 0, 1, None),
        "no marker": (None, False, None, None, None),
        f"a\r\n\r\n{START.replace('THE', 'THIS')}\r\nb\r\n\r\n\r\n\r\nc \r\n{END}": ("b\n\nc", True, 0, 2, 8),
        f"\ufeff{START}\nProduced by me\nand you\n\n\nE-text prepared by her\n\n{STARS}text": ("text", False, 3, 1, None),
        f"{START}\n{STARS}Produced by me\n\nbody\n\n{END}": ("body", True, 2, 1, 8),
        f"{START.lower()}\nx": ("x", False, 0, 1, None),
    }
    got = apply(spark, boilerplate.between_markers(F.col("text")), list(cases))
    for r, (text, end, removed, first, last) in zip(got, cases.values()):
        assert (r.text, r.end_marker_found, r.notices_removed, r.start_line) == (text, end, removed, first), r
        assert (r.end_line is None) == (last is None)
    assert got[0].end_line == 4


def test_scan_headers(spark):
    scan = "This is a digital copy of a book that was kept\non shelves\nat jhttp : //books . qooqle . com/\n\n"
    library = "The original of tliis book is in\nthe Library\nhttp://www.archive.org/details/abc\n\n"
    got = apply(spark, boilerplate.without_scan_headers(F.col("text")), [scan + library + "a  b \n\n\n\nc", library + "x", scan + "y", "plain", "x\n" + library])
    assert [(r.text, r.scan_notice_removed, r.library_header_removed) for r in got[:4]] == [("a b\n\nc", True, True), ("x", False, True), ("y", True, False), ("plain", False, False)]
    assert not got[4].boilerplate_removed


def test_markers_left(spark):
    assert apply(spark, boilerplate.markers_left(F.col("text")), ["clean", START, START + END]) == [0, 1, 2]


def page(body):
    return f'<html xmlns="http://www.w3.org/1999/xhtml"><head><title>no</title></head><body>{body}</body></html>'


def test_body_text(spark):
    cases = {
        page("<section><p>One  two</p><p>three<br/>four</p>tail</section>"): "One two\n\nthree\nfour\n\ntail",
        page("a<script>no</script>b<style>no</style>c"): "abc",
        "<body><p>plain</p></body>": "plain",
        "<p>not <b>closed &nbsp; here": "not closed here",
        "<root>only</root>": "only",
        page("<em>in<strong>line</strong></em> text"): "inline text",
    }
    assert [markup.body_text(x) for x in cases] == list(cases.values())
    assert apply(spark, markup.html_text("text"), [*cases, None]) == [*cases.values(), None]
    deep = "<body>" + "<i>" * 5000 + "x" + "</i>" * 5000 + "</body>"
    assert markup.body_text(deep) == "x"


def score(text):
    """The score, character by character."""
    s = text[:250_000]
    toks = re.findall(r"[A-Za-z]{2,}", s.lower())
    n, k, lines = max(1, len(s)), max(1, len(toks)), s.count("\n") + 1
    raw = 100 - max(0, 0.97 - sum(c.isprintable() or c in "\n\t\r" for c in s) / n) * 160 - max(0, 0.45 - sum(map(str.isalpha, s)) / n) * 120
    raw -= sum(not (c.isalnum() or c.isspace() or c in ".,;:'\"!?()-[]{}_/&%$#@*+=<>") for c in s) / n * 500 + sum(len(t) > 24 for t in toks) / k * 400
    raw -= max(0, 0.08 - sum(t in scan_quality.COMMON for t in toks) / k) * 250 + len(re.findall(r"[A-Za-z]-\n[A-Za-z]", s)) / lines * 60
    raw -= sum(0 < len(x.strip()) < 4 for x in s.splitlines()) / lines * 40 + (25 if len(text) < 5000 else 0)
    return max(0.0, min(100.0, round(raw, 2)))


def test_scan_score(spark):
    rng = random.Random(3)
    good = "the and of to in that is it for as with this is good text. "
    texts = ["", good * 90, good * 84, (good * 90)[:4999], (good * 90)[:5000], good * 100 + "x" * 25 + " " + "y" * 24, "co-\noperate " * 500, "a\u2028bc\u2028\x0bd\n" * 400, "�§¤" * 2000]
    texts += ["".join(rng.choice("the and a\n.-§é1 ") for _ in range(rng.randint(0, 9000))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r for r in scan_quality.scored(df).orderBy("i").collect()]
    assert [r.ocr_quality_score for r in got] == pytest.approx([score(t) for t in texts], abs=0.0101)
    assert got[0].ocr_quality_score == 0.0 and got[0].ocr_quality_class == "reject"
    null = scan_quality.scored(spark.createDataFrame([(1, None)], "i int, text string")).first()
    assert null.ocr_quality_class == "reject" and null.char_count == 0


def test_classes(spark):
    df = spark.createDataFrame([(85.0,), (84.99,), (70.0,), (69.99,), (50.0,), (49.99,)], "v double")
    assert [r[0] for r in df.select(scan_quality.class_of(F.col("v"))).collect()] == ["ocr_gold", "ocr_silver", "ocr_silver", "ocr_bronze", "ocr_bronze", "reject"]
