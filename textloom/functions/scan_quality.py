"""How well a scanned text was recognised: shares of characters, words and lines, and a score of these."""

from pyspark.sql import functions as F

from .text import SPACE, SPACES

#: Characters that are looked at; the count of characters is of the whole text.
SAMPLE = 250_000
# Common words and ordinary punctuation.
COMMON = "the and of to in that is it for as with was not be by on this which or from are his have at but all one their more an he were we has there can what when so if".split()
PUNCTUATION = r""".,;:'"!?()\-\[\]{}_/&%$#@*+=<>"""
CLASSES = ((85, "ocr_gold"), (70, "ocr_silver"), (50, "ocr_bronze"))
COUNTS = ("char_count", "sample_char_count", "printable", "alpha", "weird", "tokens", "long_tokens", "common_hits", "hyphen_breaks", "line_count", "short_lines")
RATIOS = ("printable_ratio", "alpha_ratio", "weird_char_ratio", "long_token_ratio", "common_word_ratio", "hyphen_break_rate", "short_line_ratio")


def prepared(text) -> dict:
    """Columns that counts() reads several times."""
    s = F.substring(text, 1, SAMPLE)
    return {"__sample": s, "__words": F.regexp_extract_all(F.lower(s), F.lit("[a-z]{2,}"), F.lit(0))}


def counts(text, s, words) -> dict:
    """Integers that all ratios are made of. s, words: columns of prepared()."""
    of = lambda pattern: F.regexp_count(s, F.lit(pattern)).cast("bigint")
    # a match for each run of them instead of each character
    within = lambda chars: F.length(s) - F.length(F.regexp_replace(s, f"{chars}+", ""))
    lines = F.split(s, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]")
    short = F.filter(lines, lambda x: F.length(F.regexp_replace(x, rf"\A{SPACE}+|{SPACE}+\z", "")).between(1, 3))
    return {
        "char_count": F.length(text).cast("bigint"),
        "sample_char_count": F.length(s).cast("bigint"),
        "printable": (F.length(s) - within(r"[[\p{C}\p{Z}]&&[^ \n\t\r]]")).cast("bigint"),
        "alpha": within(r"\p{L}").cast("bigint"),
        "weird": of(rf"[^\p{{L}}\p{{N}}{SPACES}{PUNCTUATION}]"),
        "tokens": F.size(words).cast("bigint"),
        "long_tokens": F.size(F.filter(words, lambda t: F.length(t) >= 25)).cast("bigint"),
        "common_hits": F.size(F.filter(words, lambda t: t.isin(COMMON))).cast("bigint"),
        "hyphen_breaks": of(r"[A-Za-z]-\n[A-Za-z]"),
        "line_count": (F.length(s) - F.length(F.replace(s, F.lit("\n"), F.lit(""))) + 1).cast("bigint"),
        "short_lines": F.size(short).cast("bigint"),
    }


def ratios(c) -> dict:
    """c: columns by COUNTS."""
    over = lambda a, b: c[a].cast("double") / F.greatest(c[b], F.lit(1))
    return {
        "printable_ratio": over("printable", "sample_char_count"),
        "alpha_ratio": over("alpha", "sample_char_count"),
        "weird_char_ratio": over("weird", "sample_char_count"),
        "long_token_ratio": over("long_tokens", "tokens"),
        "common_word_ratio": over("common_hits", "tokens"),
        "hyphen_break_rate": over("hyphen_breaks", "line_count"),
        "short_line_ratio": over("short_lines", "line_count"),
    }


def score(c, r):
    """From 0 to 100, to two digits, half to even."""
    zero = F.lit(0.0)
    raw = (
        F.lit(100.0)
        - F.greatest(zero, 0.97 - r["printable_ratio"]) * 160
        - F.greatest(zero, 0.45 - r["alpha_ratio"]) * 120
        - r["weird_char_ratio"] * 500
        - r["long_token_ratio"] * 400
        - F.greatest(zero, 0.08 - r["common_word_ratio"]) * 250
        - r["hyphen_break_rate"] * 60
        - r["short_line_ratio"] * 40
        - F.when(c["char_count"] < 5000, 25.0).otherwise(0.0)
    )
    return F.greatest(zero, F.least(F.lit(100.0), F.bround(raw, 2)))


def class_of(value):
    out = F.lit("reject")
    for least, name in reversed(CLASSES):
        out = F.when(value >= least, name).otherwise(out)
    return out


def scored(df, text: str = "text"):
    """df with COUNTS, RATIOS to four digits, ocr_quality_score and ocr_quality_class. A null text counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns(prepared(whole))
    df = df.withColumns(counts(whole, F.col("__sample"), F.col("__words"))).drop("__sample", "__words")
    c = {n: F.col(n) for n in COUNTS}
    r = ratios(c)
    df = df.withColumns({**{n: F.bround(x, 4) for n, x in r.items()}, "ocr_quality_score": score(c, r)})
    return df.withColumn("ocr_quality_class", class_of(F.col("ocr_quality_score")))
