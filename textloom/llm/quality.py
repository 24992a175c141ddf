"""Quality by random Fourier features.

Statistics of whole texts are standardised over all documents and mapped to cosines of random directions, whose inner
products approximate a Gaussian kernel. Each partition sums its part of the normal equations; their sum, of a size
that doesn't depend on the rows, gives ridge weights, and isotonic regression turns scores into probabilities. It is
fitted to scores by weights that haven't seen the row.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ._labels import held_out, isotonic, training_labels
from ._store import narrow, stage

#: Random features, ridge penalty for each training row, and bandwidth in units of the square root of the statistics' number.
FEATURES, PENALTY, BANDWIDTH = 256, 1e-4, 0.6
#: Standardised statistics lie within these bounds; scores are calibrated on a grid of this step.
BOUND, STEP = 6.0, 1 / 512
#: Folds of the labelled rows, by doc_id, for calibration.
FOLDS = 2
#: Partial sums that reach the driver, at most.
SUMS = 8

STATISTICS = ("chars", "words", "word_length", "word_spread", "upper", "digits", "stops", "commas", "marks", "symbols", "bars", "other", "distinct", "repeats", "commonest", "lines", "line_repeats")


def statistics(text: str | None) -> list[float]:
    """One number for each of STATISTICS; all 0 for an empty text."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    count = np.bincount(np.minimum(codes, 128), minlength=129)
    n, m = len(words), len(codes)
    sizes = np.fromiter(map(len, words), np.float64, n)
    _, at = np.unique(np.fromiter(map(hash, words), np.int64, n), return_inverse=True)
    times = np.bincount(at)
    lines = [x for x in text.split("\n") if x]
    of = lambda chars: float(count[[ord(c) for c in chars]].sum())
    return [
        np.log1p(m), np.log1p(n), sizes.mean(), sizes.std(), count[65:91].sum() / m, count[48:58].sum() / m, of(".") / n, of(",") / n, of("!?") / n, of("*&%$#@^~=+<>{}[]\\/_") / n, of("|") / n,
        count[128] / m, np.log(len(times)) / np.log(n + 1), (at[1:] == at[:-1]).mean() if n > 1 else 0.0, times.max() / n, np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
    ]


@dataclass
class Model:
    """mean, scale: of the statistics. directions, phases: of the features. weights: ridge, an intercept first. knots, values: calibration."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -BOUND, BOUND) @ self.directions + self.phases
        return np.hstack([np.ones((len(x), 1)), np.cos(z) * np.sqrt(2 / len(self.phases))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def measure(docs):
    """(doc_id, x): the statistics of every row's whole text."""

    def run(batches):
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return narrow(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id bigint, x array<double>")


def fit(measured, labels, seed: int = 0) -> Model:
    """Learns from all labelled rows that are not held out. measured: of measure(), best a stored table, as it is read three times.

    Each row is calibrated by the score that it gets from the other fold's weights. Rows of a null doc_id aren't learnt
    from; all rows of a repeated one are. Without labelled rows every score is 0.5.
    """
    d, spark = len(STATISTICS), measured.sparkSession
    moments = measured.select(*[f(F.col("x")[i]).alias(f"{f.__name__}{i}") for i in range(d) for f in (F.avg, F.stddev_pop)]).first()
    scale = np.array([moments[2 * i + 1] or 0.0 for i in range(d)])
    rng = np.random.default_rng(seed)
    model = Model(np.array([moments[2 * i] or 0.0 for i in range(d)]), np.where(scale > 1e-9, scale, 1.0), rng.normal(size=(d, FEATURES)) / (BANDWIDTH * np.sqrt(d)), rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    rows = measured.join(training_labels(labels, "quality"), "doc_id").select("x", "y", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"))
    size = FEATURES + 1
    shape = FOLDS, size * size + size + 1
    schema = "sums array<double>"

    def sums(total):
        if total[:, -1].any():
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["sums"])

    def summed(batches):
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                every, label, fold = model.features(_matrix(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
                for f in range(FOLDS):
                    p, y = every[fold == f], label[fold == f]
                    total[f] += np.concatenate([(p.T @ p).ravel(), p.T @ y, [len(y)]])
        yield from sums(total)

    def added(batches):
        yield from sums(sum((b.column(0).flatten().to_numpy().reshape(b.num_rows, -1).sum(0) for b in batches if b.num_rows), np.zeros(shape[0] * shape[1])).reshape(shape))

    def solved(total):
        ridge = PENALTY * total[-1] * np.eye(size)
        ridge[0, 0] = 1e-9 * total[-1]
        return np.linalg.solve(total[: size * size].reshape(size, size) + ridge, total[size * size : -1])

    parts = rows.mapInArrow(summed, schema).repartition(SUMS).mapInArrow(added, schema).collect()
    total = np.sum([r.sums for r in parts], axis=0).reshape(shape) if parts else np.zeros(shape)
    if not total[:, -1].any():
        return model
    model.weights = solved(total.sum(0))
    # of a fold that the others leave nothing to learn from, its own
    others = [total.sum(0) - total[f] if total[:, -1].sum() > total[f, -1] else total[f] for f in range(FOLDS)]
    weights = np.array([solved(t) for t in others])

    def raw(batches):
        for batch in batches:
            s = (model.features(_matrix(batch.column(0))) * weights[batch.column(2).to_numpy()]).sum(1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.clip(np.round(s / STEP), -4 / STEP, 4 / STEP).astype(np.int32)), batch.column(1).cast(pa.int32())], ["bin", "y"])

    bins = rows.mapInArrow(raw, "bin int, y int").groupBy("bin").agg(F.avg("y").alias("y"), F.count("*").alias("n")).collect()  # the grid's size at most
    model.knots, model.values = isotonic(np.array([r.bin * STEP for r in bins]), np.array([r.y for r in bins]), np.array([float(r.n) for r in bins]))
    return model


def score(measured, model: Model):
    """(doc_id, held_out, score) of each row."""
    sent = measured.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = sent.value.score(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    return measured.mapInArrow(run, "doc_id bigint, score double").select("doc_id", held_out().alias("held_out"), "score")


def predict(docs, labels, threshold: float = 0.5):
    """(doc_id, held_out, score, predicted): predicted is 1 from the threshold on. A null or empty text is scored as one without words."""
    measured = stage(measure(docs), "quality")
    return score(measured, fit(measured, labels)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs, labels, threshold: float = 0.5):
    """The rows of docs, all their columns, whose score reaches the threshold. One more pass over the texts, but no shuffle of them."""
    measured = stage(measure(docs), "quality")
    sent = docs.sparkSession.sparkContext.broadcast(fit(measured, labels))
    at = [c for c in docs.columns].index("text")

    def run(batches):
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(at)]).reshape(batch.num_rows, len(STATISTICS))
            yield batch.filter(pa.array(sent.value.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
