"""Rows of vectors and the merging of their neighbours, shared by both searches."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ._store import narrow


def valid(vectors, value=None, nonzero: bool = False):
    """(vec_id, v array<double>) of the vectors that take part: vec_id not null, v not null, of at least one finite component and none null or not finite.

    value: of a component, instead of itself. nonzero: leaves zero vectors out. Of rows with one vec_id the smallest
    vector counts.
    """
    rows = narrow(vectors, vec_id="bigint", embedding="array<double>").where("vec_id is not null and size(embedding) > 0")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad)
    if nonzero:
        rows = rows.where(F.exists("embedding", lambda x: x != 0))
    v = F.transform("embedding", value) if value else F.col("embedding")
    return rows.groupBy("vec_id").agg(F.min(v).alias("v"))


def matrix(column) -> np.ndarray:
    """Of a list column whose rows are equally long."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def top(found, k: int):
    """(query_id, rank, vec_id, score): of each query's rows the k highest scores, ties to the smaller vec_id."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
