"""Token counts by a pluggable tokenizer."""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import text as fn


@dataclass(frozen=True)
class Tokenizer:
    """What counts tokens, and what a count record says of it. loader: makes the counting function, once in each worker; None for the built-in pattern."""

    backend: str = "regex"
    tokenizer: str = r"\w+|[^\w\s]"
    loader: Callable[[], Callable[[str], int]] | None = None
    target_family: str | None = None
    model_id: str | None = None
    tokenizer_version: str | None = None
    processor_revision: str | None = None
    context_length: int | None = None
    add_special_tokens: bool = False
    plain_text_tokenization: bool = True
    chat_template_applied: bool = False
    enable_thinking: bool | None = None

    def count(self, text):
        text = F.coalesce(text, F.lit(""))
        if self.loader is None:
            return fn.token_count(text)
        loader = self.loader

        @F.pandas_udf(T.LongType())
        def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            count = loader()
            for s in batches:
                yield s.map(count)

        return counted(text)


def rank_file(path: str, pattern: str, name: str = "own") -> Tokenizer:
    """Byte-level BPE by a file of ranks, read on the driver and sent with the function: it has the vocabulary's size."""
    import base64

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}

    def loader():
        import tiktoken

        encode = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda t: len(encode(t))

    return Tokenizer("tiktoken", name, loader)


def transformers(model_id: str, revision: str | None = None, context_length: int | None = None, target_family: str | None = None, local_files_only: bool = True, trust_remote_code: bool = False) -> Tokenizer:
    """A processor's tokenizer, or else a tokenizer of that name, without special tokens. Needs the transformers package where it runs."""
    how = {"revision": revision, "local_files_only": local_files_only, "trust_remote_code": trust_remote_code}

    def load():
        from transformers import AutoProcessor, AutoTokenizer

        try:
            found = AutoProcessor.from_pretrained(model_id, **how)
            return getattr(found, "tokenizer", None) or found
        except (ImportError, OSError, ValueError):
            return AutoTokenizer.from_pretrained(model_id, **how)

    def loader():
        tokenizer = load()
        return lambda t: len(tokenizer.encode(t, add_special_tokens=False))

    return Tokenizer("transformers", model_id, loader, target_family, model_id, None, revision, context_of(context_length, None))


def context_of(explicit: int | None, model_max: float | None) -> int | None:
    """A positive explicit length, or else the model's own if that is a real one."""
    if explicit is not None and explicit > 0:
        return explicit
    return int(model_max) if model_max is not None and 0 < model_max < 1e9 else None


def revision_of(explicit: str | None, *found: str | None) -> str | None:
    """The revision asked for, or the first that the loaded parts name."""
    return next((r for r in (explicit, *found) if r), None)


def count_records(documents, tokenizer: Tokenizer = Tokenizer(), counted_at_utc: str | None = None, also=()):
    """A row of token_count and char_count for each document, with its own keys and the tokenizer's columns. also: other columns to carry."""
    keys = [F.col(c) if c in documents.columns else F.lit(None).cast("string").alias(c) for c in ("doc_id", "work_id", "version_id", "author", "title", "period", "language", "source", "quality_tier")]
    kinds = {"context_length": "int", "add_special_tokens": "boolean", "plain_text_tokenization": "boolean", "chat_template_applied": "boolean", "enable_thinking": "boolean"}
    about = [F.lit(getattr(tokenizer, c)).cast(kinds.get(c, "string")).alias(c) for c in ("target_family", "backend", "model_id", "tokenizer", "tokenizer_version", "processor_revision", *kinds)]
    return documents.select(*keys, *about, tokenizer.count(F.col("text")).alias("token_count"), F.coalesce(fn.char_count(F.col("text")), F.lit(0)).alias("char_count"), F.lit(counted_at_utc).cast("string").alias("counted_at_utc"), *also)
