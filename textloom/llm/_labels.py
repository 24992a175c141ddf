"""Labelled rows, folds and calibration shared by the two classifiers."""

import numpy as np
from pyspark.sql import functions as F

from ._store import narrow


def held_out(doc_id="doc_id"):
    """Whether crc32 of the doc_id as text leaves 1 when divided by 3; false for a null doc_id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def training_labels(labels, name: str):
    """(doc_id, y) of the rows to learn from: not held out, label 0 or 1. Of a doc_id with several labels the largest counts."""
    rows = narrow(labels, doc_id="bigint", **{name: "int"}).where(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1) & ~held_out())
    return rows.groupBy("doc_id").agg(F.max(name).alias("y"))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit of y on x (pool adjacent violators); between knots it is linear."""
    if not len(x):
        return np.zeros(1), np.zeros(1)
    weight = np.ones(len(x)) if weight is None else weight
    at, inverse = np.unique(x, return_inverse=True)
    w = np.bincount(inverse, weight)
    mean = np.bincount(inverse, weight * y) / w
    blocks: list[list[float]] = []  # mean, weight, first, last
    for k in range(len(at)):
        blocks.append([mean[k], w[k], at[k], at[k]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b = blocks.pop()
            a = blocks[-1]
            blocks[-1] = [(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]]
    knots = [(p, m) for m, _, first, last in blocks for p in dict.fromkeys((first, last))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])
