"""Removal of the notices that archives put before and after a text."""

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import on_texts
from .text import SPACE, tidy, unix_lines

# The archives' own notices.
START = rf"(?imud)^{SPACE}*\*\*\*{SPACE}*START OF (?:THE|THIS) PROJECT GUTENBERG EBOOK.*?\*\*\*{SPACE}*$"
END = rf"(?imud)^{SPACE}*\*\*\*{SPACE}*END OF (?:THE|THIS) PROJECT GUTENBERG EBOOK.*?\*\*\*{SPACE}*$"
CREDIT = r"(?is)\A\s*(?:Produced by|E-text prepared by|This etext was produced by)\b.*?(?:\n\s*\n)+"
ASTERISKS = r"(?s)\A\s*\*{20,}\s*\n.*?\n\s*\*{20,}\s*(?:\n\s*)*"
BOOK_SCAN = (
    rf"(?s)\A{SPACE}*This is a digital copy of a book.*?"
    rf"(?:at{SPACE}+j?https?://(?:books{SPACE}*\.{SPACE}*google|www{SPACE}*\.{SPACE}*google).*?\n"
    rf"|at{SPACE}+j?http{SPACE}*:{SPACE}*//books{SPACE}*\.{SPACE}*qoo[a-z]*{SPACE}*\..*?\n){SPACE}*"
)
LIBRARY = rf"(?s)\A{SPACE}*The original of (?:this|tli[ei]s) book.*?https?://www\.archive\.org/details/[^{SPACE[1:-1]}]+{SPACE}*\n{SPACE}*"


def _drop_notices(text: str) -> dict:
    n, patterns = 0, [re.compile(p) for p in (ASTERISKS, CREDIT)]
    while found := next((m for p in patterns if (m := p.match(text))), None):
        text, n = text[found.end() :], n + 1
    return {"text": text, "removed": n}


@on_texts
@F.pandas_udf(T.StructType().add("text", T.StringType()).add("removed", T.IntegerType()))
def _leading_notices(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_drop_notices(t) if t is not None else {"text": None, "removed": None} for t in s], columns=["text", "removed"])


def _lines(text):
    return F.regexp_count(text, F.lit("\n"))


def between_markers(raw):
    """struct<text, start_marker_found, end_marker_found, notices_removed, start_line, end_line> of a text between its start and end markers.

    Without a start marker text is null: the caller puts such rows aside. Without an end marker the text goes to its
    end. Credits and asterisk notices at its start are removed, over and over, and counted; then it is tidied.
    """
    text = unix_lines(raw)
    halves = F.split(text, START, 2)
    rest = F.split(halves[1], END, 2)
    found = F.size(halves) == 2
    body = F.when(found, rest[0])
    # only bodies that begin with a notice go to Python
    has_notice = F.regexp_like(body, F.lit(CREDIT)) | F.regexp_like(body, F.lit(ASTERISKS))
    dropped = _leading_notices(F.when(has_notice, body))
    start = _lines(halves[0])
    end = start + (_lines(text) - start - _lines(halves[1])) + _lines(rest[0]) + 1
    return F.struct(
        tidy(F.coalesce(dropped["text"], body)).alias("text"),
        found.alias("start_marker_found"),
        F.coalesce(found & (F.size(rest) == 2), F.lit(False)).alias("end_marker_found"),
        F.when(found, F.coalesce(dropped["removed"], F.lit(0))).alias("notices_removed"),
        F.when(found, start + 1).alias("start_line"),
        F.when(found & (F.size(rest) == 2), end).alias("end_line"),
    )


def without_scan_headers(raw):
    """struct<text, boilerplate_removed, scan_notice_removed, library_header_removed>: a scanning notice, then a library's header, at the start only."""
    text = unix_lines(raw)
    scan = F.regexp_like(text, F.lit(BOOK_SCAN))
    after = F.regexp_replace(text, BOOK_SCAN, "")
    library = F.regexp_like(after, F.lit(LIBRARY))
    return F.struct(tidy(F.regexp_replace(after, LIBRARY, ""), single_spaces=True).alias("text"), (scan | library).alias("boilerplate_removed"), scan.alias("scan_notice_removed"), library.alias("library_header_removed"))


def markers_left(text):
    """How many of the notices' tell-tale strings a text still has."""
    signs = ("*** START OF", "*** END OF", "This etext was produced by", "This is a digital copy of a book", "The original of this book is in")
    return sum((F.contains(text, F.lit(s)).cast("int") for s in signs), F.lit(0))
