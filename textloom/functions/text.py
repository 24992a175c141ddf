"""Column functions on text. Built-in functions wherever these agree with Python's semantics on every character.

White space, letters and digits are spelt out as classes, as the JVM's shorthands differ from Python's. Normal forms
and case folding have no built-in function: these run as Arrow functions.
"""

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import on_texts

#: White space as Python's str.isspace() has it, without and with the brackets of a class; then without the line feed.
SPACES = r"\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
SPACE = f"[{SPACES}]"
SPACE_IN_LINE = r"[\x09\x0B-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
WORD = r"[\p{L}\p{N}_]"
#: A word, or one other character that isn't white space.
TOKEN = rf"{WORD}+|[^\p{{L}}\p{{N}}_{SPACES}]"


def unless_ascii(text):
    """text, or null where it is ASCII alone."""
    return F.when(F.regexp_like(text, F.lit(r"[^\x00-\x7F]")), text)


def _arrow(name, function):
    """A function of strings as an Arrow function; null stays null."""

    def of(s: pd.Series) -> pd.Series:
        return s.map(function, na_action="ignore")

    of.__name__ = name
    return on_texts(F.pandas_udf(of, T.StringType()))


_nfc = _arrow("nfc", lambda t: t if t.isascii() else unicodedata.normalize("NFC", t))
_canonical = _arrow("canonical", lambda t: " ".join(unicodedata.normalize("NFKC", t).split()).casefold())


def nfc(text):
    """Normal form C. text is often the end of a chain of steps: it is named once, so that these run once, and all rows go to the Arrow function."""
    return _nfc(text)


def strip(text):
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def strip_line_ends(text):
    return F.regexp_replace(text, rf"{SPACE_IN_LINE}++(?=\n|\z)", "")


def canonical(text):
    """Normal form KC, runs of white space as one space, none at the ends, then case-folded."""
    plain = F.lower(strip(F.regexp_replace(text, rf"{SPACE}+", " ")))
    return F.coalesce(_canonical(unless_ascii(text)), plain)


def unix_lines(text):
    """Line ends as line feeds, byte order marks deleted."""
    return F.replace(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), F.lit("\ufeff"), F.lit(""))


def few_blank_lines(text):
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def tidy(text, single_spaces: bool = False):
    """Form feeds as line feeds, NFC, no white space at line ends and both ends of the text, one blank line at most; single_spaces: runs of spaces as one."""
    text = strip_line_ends(nfc(F.replace(text, F.lit("\f"), F.lit("\n"))))
    if single_spaces:
        text = F.regexp_replace(text, "  +", " ")
    return few_blank_lines(strip(text))


def clean_scan(text):
    """A scanned text without lines of page numbers, with white space before and after punctuation made regular, in NFC.

    The steps' order matters: white space after punctuation, line ends included, becomes one space.
    """
    text = few_blank_lines(text)
    text = F.regexp_replace(text, r"(?md)^[ \t]*[\p{Nd}\-—–]+[ \t]*$", "")
    text = F.regexp_replace(text, rf"{SPACE}+([.,:;!?])", "$1")
    text = F.regexp_replace(text, rf"([.,:;!?]){SPACE}+", "$1 ")
    text = F.regexp_replace(F.regexp_replace(text, " +", " "), r"\n +", "\n")
    return nfc(strip(text))


def char_count(text):
    return F.length(text).cast("bigint")


def line_count(text):
    """Line feeds and one, 0 for an empty text."""
    return F.when(text == "", F.lit(0)).otherwise(F.regexp_count(text, F.lit("\n")) + 1).cast("bigint")


def token_count(text):
    return F.regexp_count(text, F.lit(TOKEN)).cast("bigint")


def strip_tags(html):
    """Markup that can't be parsed: tags and entities as spaces, white space as single spaces."""
    text = F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), "&[a-zA-Z0-9#]+;", " ")
    return strip(F.regexp_replace(text, rf"{SPACE}+", " "))


def paragraphs(text, separator: str = rf"\n{SPACE}*\n+"):
    return F.split(text, separator)


def truthy(*columns):
    """The first of the columns that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def slug(text):
    return F.replace(text, F.lit("/"), F.lit("_"))
