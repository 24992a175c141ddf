"""Toxicity by compression distance.

Two zstandard dictionaries are trained apart: one on windows of ordinary documents, one on the passages of toxic
documents, in any language, whose words begin as words do in significantly more toxic documents than ordinary ones.
A toxic document is ordinary text with toxic passages in it: so a window is compressed with the ordinary dictionary
alone, and with both. Ordinary text is as long under either, and shorter under both only for what toxic text repeats.
The first letters of words are upper case, so that a beginning isn't found inside of words. A document's score sums the
log likelihood ratios of its windows' length differences, over its whole text, and is calibrated by isotonic regression.
Ratios and calibration come from documents whose fold the toxic dictionary of that fold hasn't seen.
"""

import math
import re
from collections import Counter
from dataclasses import dataclass
from statistics import NormalDist
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ._labels import held_out, isotonic, training_labels
from ._store import narrow, stage

#: Labelled documents to learn from, at most, of each label (those of the smallest hash of their doc_id).
TOXIC_ROWS, ORDINARY_ROWS = 2_000, 4_000
#: Characters of all these texts, at most: the driver holds them.
TRAINING_CHARS = 20_000_000
#: Words of a window, of which each is in two; bytes of either dictionary, at most.
WINDOW, TOXIC_BYTES, ORDINARY_BYTES = 8, 8_192, 32_768
#: Folds of the documents to learn from; those of one text are in one.
FOLDS = 3
#: Letters at the start of a word that are upper case; letters of a beginning, at least; documents that have it, at least.
MARKED, LEAST, DOCUMENTS = 5, 3, 5
#: Beginnings that would pass by chance, on average; one is left out if a longer one is in so large a share of its documents.
CHANCE, COVERED = 0.01, 0.5
#: Differences in length are counted from LOW to HIGH, and beyond as these.
LOW, HIGH = -2, 10

_NOT_WORDS = re.compile(r"[^\w\s]+")


def words(text: str | None) -> list[str]:
    return _NOT_WORDS.sub("", (text or "").lower()).split()


def marked(word: str) -> str:
    return word[:MARKED].upper() + word[MARKED:]


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """Overlapping windows of a whole text, their words marked(); one, empty, for a text without words."""
    w, half = [marked(x) for x in words(text)], max(1, size // 2)
    return [(" " + " ".join(w[i : i + size]) + " ").encode("utf-8", "replace") for i in range(0, max(1, len(w) - half), half)]


def _content(samples: list[bytes], size: int) -> bytes:
    """The content of a dictionary trained on the samples; where they are too few to train on, their own ends."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


class _Lengths:
    """Compressed lengths under a dictionary of raw content."""

    def __init__(self, content: bytes):
        import zstandard

        shape = zstandard.ZstdCompressionParameters(window_log=17, hash_log=17, chain_log=17, search_log=4, min_match=4, strategy=zstandard.STRATEGY_BTOPT, write_checksum=0, write_content_size=0, write_dict_id=0)
        own = {}
        if len(content) >= 8:
            own["dict_data"] = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own["dict_data"].precompute_compress(compression_params=shape)
        self.compress = zstandard.ZstdCompressor(compression_params=shape, **own).compress


def _differences(ordinary: _Lengths, toxic: _Lengths, some: list[bytes]) -> np.ndarray:
    a, b = ordinary.compress, toxic.compress
    return np.clip(np.fromiter((len(a(w)) - len(b(w)) for w in some), np.int64, len(some)), LOW, HIGH) - LOW


@dataclass
class Model:
    """ordinary, toxic: dictionaries. ratio: log likelihood ratio of each difference. knots, values: calibration."""

    ordinary: bytes
    toxic: bytes
    ratio: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def scorer(self):
        a, b = _Lengths(self.ordinary), _Lengths(self.toxic)
        return lambda text: float(np.interp(self.ratio[_differences(a, b, windows(text))].sum(), self.knots, self.values))


def _fold(text: str | None) -> int:
    return crc32((text or "").encode("utf-8", "replace")) % FOLDS


class _Beginnings:
    """How many documents of each label and fold have a word of each beginning. Only beginnings that enough toxic ones have are counted."""

    def __init__(self, texts: list[str | None], y: list[int], folds: list[int]):
        self.documents = Counter(zip(folds, y))
        found, seen = [], {0: set(), 1: set()}
        for t, label in zip(texts, y):
            # between the same neighbours once, or a text's copies would make all its words significant
            w = ["", *(marked(x) + " " for x in words(t)), ""]
            new = {hash(x): x[1] for x in zip(w, w[1:], w[2:])}
            found.append({x for h, x in new.items() if h not in seen[label]})
            seen[label].update(new)
        del seen
        self.enough, counted, size = min(DOCUMENTS, sum(y)), set(), LEAST
        while True:
            # a longer one is in no more documents
            some = Counter(b for f, label in zip(found, y) if label for b in {w[:size] for w in f if len(w) >= size and (size == LEAST or w[: size - 1] in counted)})
            some = {b for b, n in some.items() if n >= self.enough}
            if not some:
                break
            counted |= some
            size += 1
        self.count = {k: Counter() for k in self.documents}
        for f, fold, label in zip(found, folds, y):
            self.count[fold, label].update({w[:k] for w in f for k in range(LEAST, len(w) + 1)} & counted)

    def significant(self, without: int | None = None) -> set[str]:
        """Beginnings that set toxic documents apart, of all folds but one. Of a beginning and a longer one in nearly as many documents the longer one counts."""
        total, often = Counter(), {0: Counter(), 1: Counter()}
        for (fold, label), n in self.documents.items():
            if fold != without:
                total[label] += n
                often[label].update(self.count[fold, label])
        if not (total[0] and total[1]):
            return set()
        toxic = {b: n for b, n in often[1].items() if n >= self.enough}

        def apart(b):
            p = (toxic[b] + often[0][b]) / (total[0] + total[1])
            return (toxic[b] / total[1] - often[0][b] / total[0]) / math.sqrt(p * (1 - p) * (1 / total[0] + 1 / total[1]) + 1e-12)

        least = NormalDist().inv_cdf(1 - CHANCE / max(1, len(toxic)))
        found = {b for b in toxic if apart(b) > least}
        return found - {b[:k] for b in found for k in range(LEAST, len(b)) if toxic[b] >= COVERED * toxic.get(b[:k], math.inf)}


def passages(text: str | None, beginnings: set[str]) -> bytes:
    """A text's words of these beginnings, one after the other."""
    spaced = [marked(x) + " " for x in words(text)]
    some = [w for w in spaced if any(w[:k] in beginnings for k in range(LEAST, len(w) + 1))]
    return (" " + "".join(some)).encode("utf-8", "replace") if some else b""


def train(texts: list[str | None], y: list[int]) -> Model:
    """A model of labelled texts. Without both labels it gives the share of toxic ones (0 if there are none)."""
    count = Counter(y)
    if not (count[0] and count[1]):
        return Model(b"", b"", np.zeros(HIGH - LOW + 1), np.zeros(1), np.array([float(count[1] > 0)]))
    folds = [_fold(t) for t in texts]
    ordinary = _content([w for t, label in zip(texts, y) if not label for w in windows(t)[::2]], ORDINARY_BYTES)
    beginnings = _Beginnings(texts, y, folds)

    def both(without=None):
        some = beginnings.significant(without)
        found = [p for t, fold, label in zip(texts, folds, y) if label and fold != without and (p := passages(t, some))]
        return ordinary + (_content(found, TOXIC_BYTES) if found else b"")

    a, of = _Lengths(ordinary), {f: _Lengths(both(f)) for f in set(folds)}
    found = [_differences(a, of[f], windows(t)) for t, f in zip(texts, folds)]
    share = [np.bincount(np.concatenate([d for d, label in zip(found, y) if label == k]), minlength=HIGH - LOW + 1) + 0.5 for k in (0, 1)]
    ratio = np.log(share[1] / share[1].sum()) - np.log(share[0] / share[0].sum())
    return Model(ordinary, both(), ratio, *isotonic(np.array([ratio[d].sum() for d in found]), np.array(y, float)))


def fit(docs, labels) -> Model:
    """Learns from at most TOXIC_ROWS and ORDINARY_ROWS labelled documents that are not held out, of TRAINING_CHARS in all; only their texts are looked at.

    Of a repeated doc_id the row whose text has the smallest hash counts. Documents are taken in the order of that hash.
    """
    spark, wanted = docs.sparkSession, training_labels(labels, "toxic")
    chosen = [r for y, n in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS)) for r in wanted.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).collect()]
    ids = spark.createDataFrame(chosen, "doc_id bigint, y int")
    rows = narrow(docs, doc_id="bigint", text="string").join(F.broadcast(ids), "doc_id")  # broadcast: TOXIC_ROWS + ORDINARY_ROWS ids at most
    rows = stage(rows.withColumn("h", F.xxhash64("text")), "toxicity-rows", spark)
    of, chars = [], 0
    for r in sorted(rows.groupBy("doc_id").agg(F.min(F.struct("h", F.coalesce(F.length("text"), F.lit(0)).alias("n"))).alias("of")).collect(), key=lambda r: (r.of.h, r.doc_id)):
        chars += r.of.n
        if chars <= TRAINING_CHARS:
            of.append((r.doc_id, r.of.h))
    some = rows.join(F.broadcast(spark.createDataFrame(of, "doc_id bigint, h bigint")), ["doc_id", "h"]).dropDuplicates(["doc_id"])  # broadcast: as above
    rows = sorted(some.select("doc_id", "text", "y").collect(), key=lambda r: r.doc_id)
    return train([r.text for r in rows], [r.y for r in rows])


def score(docs, model: Model):
    """(doc_id, held_out, score) of every row, from its whole text. A null text counts as empty; rows of a null or repeated doc_id are scored one by one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        of = sent.value.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([of(t.as_py()) for t in batch.column(1)], pa.float64())], ["doc_id", "score"])

    rows = narrow(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id bigint, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score")


def predict(docs, labels, threshold: float = 0.7):
    """(doc_id, held_out, score, predicted): predicted is 1 from the threshold on."""
    return score(docs, fit(docs, labels)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
