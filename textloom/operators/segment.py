"""Chunks of documents for retrieval and training, with where they come from.

Headings cut a document into sections, and chunks never cross one; within a section, paragraphs are packed up to a
number of tokens. A paragraph longer than that is cut into overlapping windows of tokens.
"""

import re
from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

_TOKEN = re.compile(r"\w+|[^\w\s]")
_PARAGRAPH = re.compile(r"\n\s*\n+")
#: Headings: a level and a number or title, alone on their line.
_HEADING = re.compile(r"(?im)^[ \t]*(?:(book|part|volume|chapter|section)[ \t]+(?:[ivxlcdm]+|\d+)\b[^\n]{0,80})$")


@dataclass(frozen=True)
class Window:
    """Tokens of a chunk: least and most; overlap: of windows of a paragraph that is longer than most."""

    least: int = 800
    most: int = 1500
    overlap: int = 150

    def __post_init__(self):
        if not 0 <= self.overlap < self.most or self.least > self.most:
            raise ValueError("overlap must be below most, and least not above it")


def chunks(text: str | None, window: Window = Window()) -> list[tuple[int, int, int, int, str | None, str]]:
    """(start, stop, first paragraph, last paragraph, heading, method) of each chunk: offsets of characters and paragraphs counted from 0.

    Without overlap the chunks of packed paragraphs are disjoint, and all tokens are in some chunk. An empty text has none.
    """
    text, out = text or "", []
    spans, at = [], 0
    for m in [*_PARAGRAPH.finditer(text), None]:
        stop = m.start() if m else len(text)
        if text[at:stop].strip():
            spans.append((at, stop))
        at = m.end() if m else stop
    heading, pack = None, []  # of (paragraph, start, stop, tokens)

    def flush():
        if pack:
            out.append((pack[0][1], pack[-1][2], pack[0][0], pack[-1][0], heading, "paragraphs"))
            pack.clear()

    for i, (a, b) in enumerate(spans):
        if found := _HEADING.match(text[a:b].strip("\n")):
            flush()
            heading = found.group().strip()
        tokens = [(a + m.start(), a + m.end()) for m in _TOKEN.finditer(text[a:b])]
        if pack and sum(p[3] for p in pack) + len(tokens) > window.most:
            flush()
        if len(tokens) > window.most:
            for k in range(0, len(tokens), window.most - window.overlap):
                part = tokens[k : k + window.most]
                out.append((part[0][0], part[-1][1], i, i, heading, "token_window"))
                if k + window.most >= len(tokens):
                    break
            continue
        pack.append((i, a, b, len(tokens)))
        if sum(p[3] for p in pack) >= window.least:
            flush()
    flush()
    return out


_CHUNK = "chunk_index int, char_start int, char_end int, first_paragraph int, last_paragraph int, heading string, method string, token_count int, text string"


class ChunkText:
    """chunk_text(text, least, most, overlap) in SQL, with LATERAL."""

    def eval(self, text: str, least: int, most: int, overlap: int):
        for i, (a, b, p, q, heading, method) in enumerate(chunks(text, Window(least, most, overlap))):
            yield i, a, b, p, q, heading, method, len(_TOKEN.findall(text[a:b])), text[a:b]


def register(spark) -> None:
    spark.udtf.register("chunk_text", udtf(ChunkText, returnType=_CHUNK))


def segment(documents, window: Window = Window(), keys=("doc_id",)):
    """A row for each chunk: chunk_id, the document's keys, offsets and text. Documents without text have none.

    documents' other columns can be joined by key afterwards; only keys and text go to Python.
    """
    import pyarrow as pa

    schema = ", ".join([f"{k} {dict(documents.dtypes)[k]}" for k in keys]) + ", " + _CHUNK
    names = [x.split()[0] for x in _CHUNK.split(", ")]
    kinds = {"int": pa.int32(), "string": pa.string()}

    def run(batches):
        for batch in batches:
            rows, at = [], []
            for i, text in enumerate(batch.column(len(keys))):
                text = text.as_py()
                for n, (a, b, p, q, heading, method) in enumerate(chunks(text, window)):
                    at.append(i)
                    rows.append((n, a, b, p, q, heading, method, len(_TOKEN.findall(text[a:b])), text[a:b]))
            if rows:
                columns = [pa.array(c, kinds[x.split()[1]]) for c, x in zip(zip(*rows), _CHUNK.split(", "))]
                yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(at)) for k in range(len(keys))] + columns, [*keys, *names])

    out = documents.select(*keys, "text").mapInArrow(run, schema)
    return out.withColumn("chunk_id", F.concat_ws("__", F.col(keys[0]).cast("string"), F.lpad(F.col("chunk_index").cast("string"), 6, "0")))
