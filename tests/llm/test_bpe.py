import hashlib
import random

import pytest

from textloom.llm import bpe

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    alphabet = "abc  \n\t'sé漢字🙂1２.,!—  " + "the and of "
    return [None, "", " ", "\n\n  x", "it's we'll don't", "a" * 20_000, "ab " * 30_000, "<|endoftext|>"] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(150)]


@pytest.mark.parametrize("limits", [{}, {"block_chars": 500, "pack_chars": 100, "buckets": 7}, {"block_words": 20, "buckets": 1}])
def test_equals_the_library(make_docs, clashing, ranks, library, limits):
    rows = list(enumerate(texts())) + [(None, "null id"), (3, "same id again")]
    docs = clashing(make_docs(rows), "block", "bucket", "ids", "keys")
    got = sorted(((r.doc_id, tuple(r.ids)) for r in bpe.encode(docs, ranks, tokenizers.PATTERN, **limits).collect()), key=str)
    assert got == sorted(((i, tuple(library.encode_ordinary(t or ""))) for i, t in rows), key=str)


def test_round_trip_and_digests(make_docs, ranks, library):
    rows = list(enumerate(texts()))
    encoded = bpe.encode(make_docs(rows), ranks, tokenizers.PATTERN).persist()
    decoded = {r.doc_id: bytes(r.bytes) for r in bpe.decode(encoded, ranks).collect()}
    assert decoded == {i: (t or "").encode() for i, t in rows}
    want = {(i, len(ids := library.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows}
    assert {tuple(r) for r in bpe.digests(encoded, ranks).collect()} == want
    assert {tuple(r) for r in bpe.encode_digests(make_docs(rows), ranks, tokenizers.PATTERN).collect()} == want


def test_empty_table_and_null_ids(spark, make_docs, ranks):
    assert bpe.encode_digests(make_docs([]), ranks, tokenizers.PATTERN).collect() == []
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert {r.n_tokens for r in bpe.digests(none, ranks).collect()} == {0}
    assert {bytes(r.bytes) for r in bpe.decode(none, ranks).collect()} == {b""}
