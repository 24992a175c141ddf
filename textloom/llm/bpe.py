"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Documents are split into pre-tokens, which keep their positions as indexes into a dictionary of their block (the
documents of a task, up to a size). Only the blocks' dictionaries are shuffled: words meet by a bucket of their hash,
each distinct word is encoded once in its bucket, and its ids return to the blocks that asked for it, where documents
are put together again by position. A frequent word is thus one entry in a block however often it occurs, and no key
holds more rows than there are blocks.
"""

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ._store import narrow, partitions, stage

#: Texts of a block, in characters, and distinct words of a block, at most (one document more).
BLOCK_CHARS, BLOCK_WORDS = 32_000_000, 600_000
#: Characters of one packed row of positions, at most (one document more).
PACK_CHARS = 1_000_000
#: Hash buckets in which distinct words meet, at least: few, for words sorted in a bucket of a block then pack well. Bytes of a corpus to a bucket beyond that.
BUCKETS, BUCKET_BYTES = 512, 128 << 20
#: Effort of compression, for numbers and for words.
EFFORT, WORD_EFFORT = 9, 12
#: Levels of frequency in a block.
LEVELS = 7
#: Between words: a byte that UTF-8 never has.
SEPARATOR = b"\xff"


def load_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 token and rank per line. Of the vocabulary's size, whatever the corpus."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _pack(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=EFFORT).compress(np.ascontiguousarray(a.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(b: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_positions(at: np.ndarray, code: np.ndarray) -> list[bytes]:
    """A byte for each of the block's most frequent words, and the index apart for the rest."""
    import zstandard

    short = code[at]
    return [zstandard.ZstdCompressor(level=EFFORT).compress(short.tobytes()), _pack(at[short == 255])]


def _unpack_positions(short: bytes, rest: bytes, top: np.ndarray) -> np.ndarray:
    import zstandard

    short = np.frombuffer(zstandard.ZstdDecompressor().decompress(short), np.uint8)
    at = np.concatenate([top, np.zeros(256 - len(top), np.uint32)])[short]
    at[short == 255] = _unpack(rest)
    return at.astype(np.int64)


_BLOCKS = "block bigint, bucket int, keys array<bigint>, lens array<int>, top array<int>, body array<binary>"
_BLOCKS_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.list_(pa.int64())), ("lens", pa.list_(pa.int32())), ("top", pa.list_(pa.int32())), ("body", pa.list_(pa.binary()))])


def _block(number: int, docs: list, words: dict[str, int], buckets: int, pack_chars: int):
    """Rows of a block. Its words are numbered by level (of their count's size, frequent first), bucket and bytes.

    With a bucket: the bucket's words, and as lens how many are of each level. Without: documents' keys, pre-tokens of
    each, and the packed numbers of these.
    """
    import xxhash
    import zstandard

    count = np.bincount(np.concatenate([d[1] for d in docs]), minlength=len(words))
    level = LEVELS - 1 - np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64), LEVELS - 1)
    by = sorted((xxhash.xxh3_64_intdigest(b := w.encode()) % buckets, level_, b, i) for (w, i), level_ in zip(words.items(), level.tolist()))
    words.clear()
    order = np.array([i for _, _, _, i in by], np.int64)
    number_of = np.empty(len(by), np.uint32)
    number_of[order[np.argsort(level[order], kind="stable")]] = np.arange(len(by), dtype=np.uint32)
    top = number_of[np.argsort(-count, kind="stable")[:255]]
    code = np.full(len(by), 255, np.uint8)
    code[top] = np.arange(len(top), dtype=np.uint8)
    zip_, rows, k = zstandard.ZstdCompressor(level=WORD_EFFORT), [], 0
    while k < len(docs):
        first, chars = k, 0
        while k < len(docs) and (k == first or chars + docs[k][2] <= pack_chars):
            chars += docs[k][2]
            k += 1
        some = docs[first:k]
        rows.append({"block": number, "bucket": None, "keys": [d[0] for d in some], "lens": [len(d[1]) for d in some], "top": top.tolist(), "body": _pack_positions(number_of[np.concatenate([d[1] for d in some])], code)})
    yield pa.RecordBatch.from_pylist(rows, _BLOCKS_ARROW)
    ends = np.flatnonzero(np.diff([x[0] for x in by], prepend=-1, append=-1)).tolist()
    for some in (list(zip(ends, ends[1:]))[k : k + 128] for k in range(0, len(ends), 128)):
        yield pa.RecordBatch.from_pylist([{"block": number, "bucket": by[a][0], "keys": None, "lens": np.bincount([x[1] for x in by[a:b]], minlength=LEVELS).tolist(), "top": None, "body": [zip_.compress(SEPARATOR.join(x[2] for x in by[a:b]))]} for a, b in some], _BLOCKS_ARROW)


def _blocks(pattern: str, buckets: int, block_chars: int, block_words: int, pack_chars: int):
    def run(batches):
        import regex
        from pyspark import TaskContext

        split = regex.compile(pattern).findall
        number, docs, words, chars = TaskContext.get().partitionId() << 32, [], {}, 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                found = split(text)
                for w in set(found).difference(words):
                    words[w] = len(words)
                docs.append((key, np.fromiter(map(words.__getitem__, found), np.uint32, len(found)), len(text)))
                chars += len(text) + 16
                if chars > block_chars or len(words) > block_words:
                    yield from _block(number, docs, words, buckets, pack_chars)
                    number, docs, words, chars = number + 1, [], {}, 0
        if docs:
            yield from _block(number, docs, words, buckets, pack_chars)

    return run


def _encoder(ranks):
    """Rows of words of one task's buckets, which come bucket by bucket: the ids of each word, each distinct word encoded once."""

    def run(batches):
        import tiktoken
        import zstandard

        # a word is one match, whatever the pattern that it was split by
        encode = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks.value, special_tokens={}).encode_ordinary
        unzip, known, last = zstandard.ZstdDecompressor(), {}, None
        for batch in batches:
            out = []
            for block, bucket, lens, body in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if bucket != last:
                    known, last = {}, bucket
                ids, sizes = [], []
                for w in unzip.decompress(body[0]).split(SEPARATOR):
                    got = known.get(w)
                    if got is None:
                        got = known[w] = encode(w.decode())
                    ids += got
                    sizes.append(len(got))
                out.append({"block": block, "bucket": bucket, "lens": lens, "sizes": _pack(np.array(sizes, np.uint32)), "ids": _pack(np.array(ids, np.uint32))})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("lens", pa.list_(pa.int32())), ("sizes", pa.binary()), ("ids", pa.binary())]))

    return run


def _buckets(docs) -> int:
    """As many as the corpus wants, by the size that its plan states; a plan that knows no size states exabytes."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(BUCKETS, size // BUCKET_BYTES) if size < 1 << 60 else BUCKETS


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of runs of the given starts and sizes, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _reassemble(documents: pa.Table, words: pa.Table) -> pa.Table:
    """One block: the documents' positions against the ids of its words, which come by bucket and are numbered by level first."""
    words = words.sort_by("bucket")
    sizes, ids = ([_unpack(x) for x in words[n].to_pylist()] or [np.zeros(0, np.uint32)] for n in ("sizes", "ids"))
    ids, sizes = np.concatenate(ids).astype(np.int32), np.concatenate(sizes).astype(np.int64)
    level = np.repeat(np.tile(np.arange(LEVELS), words.num_rows), np.array(words["lens"].to_pylist(), np.int64).ravel())
    order = np.argsort(level, kind="stable")
    starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
    keys, out = [], []
    for key, lens, top, body in zip(*(documents[n].to_pylist() for n in ("keys", "lens", "top", "body"))):
        at = _unpack_positions(*body, np.array(top, np.uint32))
        flat = ids[_spread(starts[at], sizes[at])]
        ends = np.concatenate([[0], np.cumsum(sizes[at])])[np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)]
        keys.append(pa.array(key, pa.int64()))
        out.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)))
    return pa.table({"doc_id": pa.chunked_array(keys, pa.int64()), "ids": pa.chunked_array(out, pa.list_(pa.int32()))})


def encode(docs, ranks: dict[bytes, int], pattern: str, buckets: int | None = None, block_chars: int = BLOCK_CHARS, block_words: int = BLOCK_WORDS, pack_chars: int = PACK_CHARS, finish=None, schema: str = "doc_id bigint, ids array<int>"):
    """(doc_id, ids array<int>): each match of pattern in a whole text, encoded by ranks; no special tokens.

    A null or empty text gives no ids. Rows with a null or repeated doc_id give a row each. Other columns don't matter.
    buckets: in which distinct words meet; without it, as many as the corpus wants. A task holds a block's documents and
    words, or the distinct words of a bucket. ranks goes to the executors once: it has the vocabulary's size. finish, if given, turns each block's table of these
    columns into one of the given schema, in the process that made it.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(ranks)
    rows = narrow(docs, doc_id="bigint", text="string")
    rows = rows.mapInArrow(_blocks(pattern, buckets or _buckets(rows), block_chars, block_words, pack_chars), _BLOCKS)
    rows = stage(rows, "bpe-blocks", spark)
    words = rows.where(F.col("bucket").isNotNull()).select("block", "bucket", "lens", "body").repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")
    words = words.mapInArrow(_encoder(sent), "block bigint, bucket int, lens array<int>, sizes binary, ids binary")
    documents = rows.where(F.col("bucket").isNull()).select("block", "keys", "lens", "top", "body")
    return documents.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(lambda d, w: finish(_reassemble(d, w)) if finish else _reassemble(d, w), schema)


def _joined(table: pa.Array, ids: pa.Array, ends: np.ndarray):
    """For each run of ids, the bytes of the table's entries one after the other."""
    got = pc.take(table, ids)
    at = np.frombuffer(got.buffers()[1], np.int64)[got.offset : got.offset + len(got) + 1] if len(got) else np.zeros(1, np.int64)
    data = memoryview(got.buffers()[2] or b"") if len(got) else memoryview(b"")
    cut = at[ends].tolist()
    return [data[a:b] for a, b in zip(cut, cut[1:])]


def _ids_of(column: pa.Array):
    """Flat ids and the ends of each row's; a null row has none."""
    lens = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return pc.list_flatten(column), np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)


def _token_table(ranks: dict[bytes, int]) -> pa.Array:
    by = {i: b for b, i in ranks.items()}
    return pa.array([by.get(i) for i in range(max(by, default=-1) + 1)], pa.large_binary())


def decode(encoded, ranks: dict[bytes, int]):
    """(doc_id, bytes): the ids of each row looked up in the token-byte table, which has the vocabulary's size. Null ids give no bytes; an id outside of the table is an error."""
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        table = _token_table(sent.value)
        for batch in batches:
            flat, ends = _ids_of(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bytes(x) for x in _joined(table, flat, ends)], pa.binary())], ["doc_id", "bytes"])

    return narrow(encoded, doc_id="bigint", ids="array<int>").mapInArrow(run, "doc_id bigint, bytes binary")


_DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
_tables: dict[int, tuple[pa.Array, pa.Array]] = {}


def _digest(ranks, some):
    """Of rows (doc_id, ids), a few hundred at a time: how many ids, digests of their text and of the bytes decoded from them."""
    from hashlib import sha256

    if id(ranks) not in _tables:
        table = _token_table(ranks)
        _tables[id(ranks)] = table, pa.array([b"%d," % i for i in range(len(table))], pa.large_binary())
    table, numbers = _tables[id(ranks)]
    for batch in some:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            flat, ends = _ids_of(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(ends), pa.int64()), pa.array([sha256(x[:-1]).hexdigest() for x in _joined(numbers, flat, ends)], pa.string()), pa.array([sha256(x).hexdigest() for x in _joined(table, flat, ends)], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def digests(encoded, ranks: dict[bytes, int]):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encode()'s rows; the bytes are decoded from the ids by the token-byte table, as in decode()."""
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)
    return narrow(encoded, doc_id="bigint", ids="array<int>").mapInArrow(lambda batches: _digest(sent.value, batches), _DIGESTS)


def encode_digests(docs, ranks: dict[bytes, int], pattern: str, with_ids: bool = False, **how):
    """digests(encode(docs, ...)), each block's ids digested where they are made. with_ids: a column ids as well."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    empty = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def finish(table):
        out = pa.Table.from_batches(_digest(sent.value, table.to_batches()), empty)
        return out.append_column("ids", table["ids"]) if with_ids else out

    return encode(docs, ranks, pattern, finish=finish, schema=_DIGESTS + ", ids array<int>" * with_ids, **how)
