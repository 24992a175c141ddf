"""Columns and batches of the operators' inputs. Intermediate tables are textloom.store's."""

from textloom.functions.batches import BATCH_BYTES, BATCH_ROWS, short_batches  # noqa: F401  for the operators
from textloom.store import drop, drop_path, new_path, shared_root, stage  # noqa: F401  for the operators


def column(df, name: str, kind: str):
    """The column by its exact name, cast; a missing one is null. Extra columns of any name don't matter."""
    from pyspark.sql import functions as F

    found = [c for c in df.columns if c == name] or [c for c in df.columns if c.lower() == name.lower()]
    return (df[f"`{found[0]}`"] if found else F.lit(None)).cast(kind).alias(name)


def narrow(df, **kinds: str):
    """Only the named columns, cast. The session's Arrow batches get short."""
    short_batches(df.sparkSession)
    return df.select(*[column(df, n, k) for n, k in kinds.items()])


def never_empty(df, key):
    """df and a row of this key and else nulls, which no other row has: so that a join with few rows is one, where none are, too, and the plan the same at every size."""
    nothing = df.sparkSession.createDataFrame([(key, *[None] * (len(df.columns) - 1))], df.schema)
    return df.unionByName(nothing)


def partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
