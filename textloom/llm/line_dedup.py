"""Repeated passages, by winnowing.

Lines hold passages within longer ones, so that what is hashed is a line's words, in order: grams of so many words.
Of the grams in each window that of the smallest hash is a fingerprint, so that equal windows have equal fingerprints,
and a window of the least length that counts has one for certain. The windows around one fingerprint are its block.
Places of repeated fingerprints meet by the content of their blocks; a block that occurred earlier is a repeated run,
whole. Of blocks that are the first of their content but share their fingerprint with others, the windows meet one by
one, which finds where a run begins and ends, to the word. Blocks and windows that overlap extend a run both ways.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ._store import drop, narrow, never_empty, partitions, stage
from ._words import Prefix, lowered, mix, words

#: Words of a run that is removed, at least, and of a gram.
WINDOW, GRAM = 50, 25
#: A bit map: segments, and bits of each. Of a fixed size; where it is too small for a corpus, more blocks and windows are joined in vain.
SEGMENTS, SEGMENT_BITS = 64, 1 << 20
#: Keys with more than this share of all places, and so many, are joined by broadcast: there are 1 / HOT of them at most.
HOT, LEAST_HOT = 1 / 4096, 1000


class Batch:
    """Words of several texts, one after the other: ends[i] is where those of text i end."""

    def __init__(self, texts: list[str | None], window: int = WINDOW, gram: int = GRAM):
        datas = [lowered(t) for t in texts]
        joined = np.concatenate([x for d in datas for x in (d, [10])] or [np.zeros(0)]).astype(np.uint8)
        self.hashes, start, _ = words(joined)
        self.ends = np.searchsorted(start, np.cumsum([len(d) + 1 for d in datas]))
        self.text = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))
        self.begins = np.concatenate([[0], self.ends])
        self.hash, self.window, self.gram = Prefix(self.hashes), window, gram

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprint, key, start, stop): of each place where a fingerprint was chosen, the words of all windows that chose it. A window's fingerprint is its gram of the smallest hash, the last of equal ones."""
        n, none = len(self.hashes), np.zeros(0, np.int64)
        if n < self.window:
            return none.astype(np.uint64), none.astype(np.uint64), none, none
        at = np.arange(n - self.gram + 1)
        value = self.hash(at, at + self.gram)
        wide, chosen = self.window - self.gram + 1, at
        # the smallest of 1, 2, 4 ... grams from each on, and of as many as a window has
        size = 1
        while size < wide:
            by = min(size, wide - size)
            a, b = chosen[:-by], chosen[by:]
            chosen = np.where(value[b] <= value[a], b, a)
            size += by
        starts = np.flatnonzero(np.arange(len(chosen)) + self.window <= self.ends[self.text[: len(chosen)]])
        if not len(starts):
            return none.astype(np.uint64), none.astype(np.uint64), none, none
        picked = chosen[starts]
        first = np.concatenate([[True], picked[1:] != picked[:-1]])
        last = np.append(first[1:], True)
        start, stop, picked = starts[first], starts[last] + self.window, picked[first]
        return value[picked], mix(self.hash(start, stop) + (picked - start).astype(np.uint64)), start, stop


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values))


_PLACES = "doc_id bigint, h bigint, prints array<bigint>, keys array<bigint>, starts array<int>, sizes array<int>"


def _places(window: int, gram: int):
    """All blocks of each text."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            b = Batch(batch.column(2).to_pylist(), window, gram)
            prints, key, start, stop = b.blocks()
            ends = np.searchsorted(start, b.ends)
            columns = (prints.view(np.int64), key.view(np.int64), (start - b.begins[b.text[start]]).astype(np.int32), (stop - start).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(_lists(c, ends) for c in columns)], [x.split()[0] for x in _PLACES.split(", ")])

    return run


def _bits(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each fingerprint, and its two bits there."""
    other = mix(prints)
    return (prints % np.uint64(SEGMENTS)).astype(np.int64), np.stack([x % np.uint64(SEGMENT_BITS) for x in (other, other >> np.uint64(32))]).astype(np.int64)


def _filter(often) -> np.ndarray:
    """A bit map of the numbers in a column print, segment by segment; each is made by one task, and the driver gets a map of fixed size."""

    def run(batches):
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            segment, bits = _bits(batch.column(0).to_numpy().view(np.uint64))
            for s in np.unique(segment).tolist():
                maps.setdefault(s, np.zeros(SEGMENT_BITS, bool))[bits[:, segment == s].ravel()] = True
        if maps:
            yield pa.RecordBatch.from_arrays([pa.array(list(maps), pa.int32()), pa.array([np.packbits(m).tobytes() for m in maps.values()], pa.binary())], ["segment", "bits"])

    # unsigned remainder, as SEGMENTS is a power of 2
    rows = often.repartition(min(SEGMENTS, partitions(often.sparkSession)), F.col("print").bitwiseAND(SEGMENTS - 1)).mapInArrow(run, "segment int, bits binary").collect()
    out = np.zeros((SEGMENTS, SEGMENT_BITS // 8), np.uint8)
    for r in rows:
        out[r.segment] = np.frombuffer(r.bits, np.uint8)
    return out


def _known(map_: np.ndarray, prints: np.ndarray) -> np.ndarray:
    segment, bits = _bits(prints)
    return (map_[segment, bits >> 3] >> (7 - (bits & 7)).astype(np.uint8) & 1).all(0)


def _rows(batch, texts: np.ndarray, start: np.ndarray, stop: np.ndarray, **columns):
    """A batch of places: given columns, doc_id, h, and start and stop within the text."""
    at = pa.array(texts)
    return pa.RecordBatch.from_arrays([*(pa.array(v) for v in columns.values()), batch.column(0).take(at), batch.column(1).take(at), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], [*columns, "doc_id", "h", "start", "stop"])


def _repeated(sent):
    """Blocks, a row each, whose fingerprint the bit map has."""

    def run(batches):
        for batch in batches:
            text = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(2)).to_numpy())
            prints, keys, starts, sizes = (batch.column(i).flatten().to_numpy() for i in range(2, 6))
            keep = _known(sent.value, prints.view(np.uint64))
            yield _rows(batch, text[keep], starts[keep], starts[keep] + sizes[keep], key=keys[keep], print=prints[keep])

    return run


def _place(key: np.ndarray, doc: pa.Array, h: pa.Array, start: np.ndarray) -> np.ndarray:
    """A number for a block at a place; a null doc_id counts as 0, as h tells texts apart."""
    ids, own = (x.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) for x in (doc, h))
    return mix(mix(key.view(np.uint64) ^ mix(ids)) ^ mix(own + start.astype(np.uint64)))


def _opened(sent):
    """Of the first blocks of their content, the places of those whose fingerprint the bit map has."""

    def run(batches):
        for batch in batches:
            keep = np.flatnonzero(_known(sent.value, batch.column(1).to_numpy().view(np.uint64)))
            at = pa.array(keep)
            key, doc, h, start = (batch.column(i).take(at) for i in (0, 2, 3, 4))
            yield pa.RecordBatch.from_arrays([pa.array(_place(key.to_numpy(), doc, h, start.to_numpy()).view(np.int64))], ["print"])

    return run


def _windows(shared, places, window: int, gram: int):
    """The windows, one by one, of blocks whose fingerprint and place the bit maps have."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            b = Batch(batch.column(2).to_pylist(), window, gram)
            prints, key, start, stop = b.blocks()
            keep = np.flatnonzero(_known(shared.value, prints))
            at = pa.array(b.text[start[keep]])
            keep = keep[_known(places.value, _place(key[keep], batch.column(0).take(at), batch.column(1).take(at), start[keep] - b.begins[b.text[start[keep]]]))]
            count = stop[keep] - window - start[keep] + 1
            ends = np.cumsum(count)
            each = np.repeat(start[keep] - (ends - count), count) + np.arange(count.sum())
            text = b.text[each]
            own = each - b.begins[text]
            yield _rows(batch, text, own, own + window, key=b.hash(each, each + window).view(np.int64))

    return run


_ORDER = "struct(doc_id is null as none, doc_id, h, start, stop)"


def _firsts(places, *more):
    """(key, of, n, ...): the first place of each key, and how many it has."""
    return places.groupBy("key").agg(F.min(F.expr(_ORDER)).alias("of"), F.count("*").alias("n"), *more)


def _later(places, firsts):
    """(doc_id, h, start, stop) of the places that aren't the first of their key. places is a stored table. In the document of the first one only what lies after it."""
    most = max(LEAST_HOT, int(places.count() * HOT))
    several = firsts.where("n > 1")
    # broadcast: more than a share HOT of the places each, so 1 / HOT keys at most
    hot = F.broadcast(never_empty(several.where(F.col("n") > most).select("key", F.col("of").alias("hot")), 0))
    # rows that have met then, by a key of their own, none; merge: else a small side would be broadcast, and a larger input would be another plan
    rest = several.where(F.col("n") <= most).select(F.col("key").alias("other"), F.col("of").alias("rest")).hint("merge")
    own = F.when(F.col("hot").isNull(), F.col("key")).otherwise(F.xxhash64("doc_id", "h", "start"))
    both = places.join(hot, "key", "left").withColumn("own", own).join(rest, F.col("own") == F.col("other"), "left").withColumn("of", F.coalesce("hot", "rest")).where("of IS NOT NULL")
    same = F.col("doc_id").eqNullSafe(F.col("of.doc_id")) & (F.col("h") == F.col("of.h"))
    begin = F.when(same, F.greatest("start", F.col("of.stop"))).otherwise(F.col("start"))
    return both.where(~(same & (F.col("start") == F.col("of.start")))).select("doc_id", "h", begin.alias("start"), "stop").where("start < stop")


def repeated_runs(docs, window: int = WINDOW, gram: int = GRAM):
    """(doc_id, h, runs array<struct<start, stop>>): runs of words that occur in a document of a smaller doc_id, or earlier in the same one.

    h is xxhash64 of the text: rows of one doc_id and different texts are documents in order of h, and rows equal in
    both are one document. A null doc_id comes after all others. Every run of window words or more that occurred
    before is found, and nothing else. Within one document a run doesn't reach into the earlier one that stays.
    """
    spark = docs.sparkSession
    texts = narrow(docs, doc_id="bigint", text="string").select("doc_id", F.xxhash64("text").alias("h"), "text")

    def bit_map(column):
        return spark.sparkContext.broadcast(_filter(column))

    places = stage(texts.mapInArrow(_places(window, gram), _PLACES), "line-places", spark)
    often = places.select(F.explode("prints").alias("print")).groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    blocks = stage(places.mapInArrow(_repeated(bit_map(often)), "key bigint, print bigint, doc_id bigint, h bigint, start int, stop int"), "line-blocks", spark)
    drop(places)
    first = stage(_firsts(blocks, F.first("print").alias("print")), "line-first-blocks", spark)
    # a fingerprint of several contents: there windows are compared, of the first block of each
    shared = bit_map(first.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print"))
    opened = first.select("key", "print", "of.doc_id", "of.h", "of.start").mapInArrow(_opened(shared), "print bigint")
    windows = stage(texts.mapInArrow(_windows(shared, bit_map(opened), window, gram), "key bigint, doc_id bigint, h bigint, start int, stop int"), "line-windows", spark)
    later = _later(blocks, first).unionByName(_later(windows, stage(_firsts(windows).where("n > 1"), "line-first-windows", spark)))
    return later.groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "stop")).alias("runs"))


def cut(text: str, runs: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]], int]:
    """The text without the words of the runs and the white space after them; the spans of bytes that went; how many words they had."""
    data = text.encode("utf-8", "replace")
    start = words(lowered(text))[1]
    edge = np.zeros(len(start) + 1, np.int64)
    for a, b in runs:
        edge[a] += 1
        edge[b] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    start = np.append(start, len(data))
    ends = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    spans = [(int(start[a]), int(start[b])) for a, b in zip(ends[::2], ends[1::2])]
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    out = (b"".join(kept) + data[at:]).decode("utf-8", "replace")
    return (out.rstrip() if spans and at == len(data) else out), spans, int(gone.sum())


def _with_runs(docs, window: int, gram: int):
    names = {c.lower(): c for c in docs.columns}
    runs = repeated_runs(docs, window, gram).select(F.col("doc_id").alias("__doc_id"), F.col("h").alias("__h"), F.col("runs").alias("__runs"))
    same = docs[f"`{names['doc_id']}`"].cast("bigint").eqNullSafe(F.col("__doc_id")) & (F.xxhash64(docs[f"`{names['text']}`"].cast("string")) == F.col("__h"))
    # merge: else a few runs would be broadcast, and the same step would be another one on a larger input
    return docs.join(runs.hint("merge"), same, "left"), names


def report(docs, window: int = WINDOW, gram: int = GRAM):
    """(doc_id, n_removed, removed_words, spans array<struct<start, stop>>, text) of every row: how many spans of the original text (in bytes) repeat earlier runs, their words, and the text without them.

    A null or empty text has no words and keeps its value; repeated rows and ties: see repeated_runs(); very long texts are read whole.
    """
    rows, _ = _with_runs(narrow(docs, doc_id="bigint", text="string"), window, gram)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            for text, runs in zip(batch.column(1), batch.column(2).to_pylist()):
                new, spans, size = cut(text.as_py(), [(r["start"], r["stop"]) for r in runs]) if runs else (text.as_py(), [], 0)
                out.append((len(spans), size, [{"start": a, "stop": b} for a, b in spans], new))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(zip(*out), kinds))], ["doc_id", "n_removed", "removed_words", "spans", "text"])

    return rows.select("doc_id", "text", "__runs").mapInArrow(run, "doc_id bigint, n_removed bigint, removed_words bigint, spans array<struct<start:int,stop:int>>, text string")


def deduplicate(docs, window: int = WINDOW, gram: int = GRAM, drop_empty: bool = True):
    """docs, with all their columns, without repeated runs; n_chars, if there is one, counts the new text. drop_empty: rows of which nothing is left go (rows that had no words stay)."""
    rows, names = _with_runs(docs, window, gram)
    at, chars, n = docs.columns.index(names["text"]), docs.columns.index(names["n_chars"]) if "n_chars" in names else None, len(docs.columns)

    def run(batches):
        for batch in batches:
            found = batch.column(n)
            changed = [i for i, r in enumerate(found.is_valid().to_pylist()) if r]
            if not changed:
                yield pa.RecordBatch.from_arrays(batch.columns[:n], names=batch.schema.names[:n])
                continue
            texts, keep = batch.column(at).to_pylist(), np.ones(batch.num_rows, bool)
            counts = batch.column(chars).to_pylist() if chars is not None else None
            for i in changed:
                texts[i], _, _ = cut(texts[i], [(r["start"], r["stop"]) for r in found[i].as_py()])
                keep[i] = bool(texts[i].strip()) or not drop_empty
                if counts:
                    counts[i] = len(texts[i])
            columns = list(batch.columns[:n])
            columns[at] = pa.array(texts, columns[at].type)
            if counts:
                columns[chars] = pa.array(counts, columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:n]).filter(pa.array(keep))

    return rows.select(*[docs[f"`{c}`"] for c in docs.columns], "__runs").mapInArrow(run, docs.schema)
