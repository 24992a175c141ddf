"""Connected components of a stored list of edges."""

from pyspark.sql import functions as F

from ._store import drop_path, new_path


def _written(df, label):
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def components(edges, a: str = "a", b: str = "b"):
    """(node, component) of every node that an edge names: component is the smallest node reachable.

    In each round a node takes the smallest of its neighbours, and then what that one takes; edges between nodes that
    took the same go, and the rest lie between the taken. So a round has fewer nodes and edges than the one before,
    and the rounds' tables are at last joined from the smallest up. Each round is a written table; of it only whether
    edges are left comes to the driver. Rows with a null end are left out; loops and repeated edges don't matter.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v")).where("u is not null and v is not null")
    e, path = _written(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "cc-edges")
    levels = []
    while True:
        ends = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
        near, near_path = _written(ends.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label")), "cc-near")
        level, _ = _written(near.withColumnRenamed("label", "at").join(near.select(F.col("node").alias("at"), "label"), "at").select("node", "label"), "cc-level")
        levels.append(level)
        drop_path(spark, near_path)
        x, y = (level.select(F.col("node").alias(c), F.col("label").alias(f"new_{c}")) for c in "uv")
        rest = e.where("u != v").join(x, "u").join(y, "v").where("new_u != new_v").select(F.least("new_u", "new_v").alias("u"), F.greatest("new_u", "new_v").alias("v")).distinct()
        before, (e, path) = path, _written(rest, "cc-edges")
        drop_path(spark, before)
        if e.isEmpty():
            break
    out = levels.pop().withColumnRenamed("label", "component")
    while levels:
        above = out.select(F.col("node").alias("label"), "component")
        out = levels.pop().join(above, "label", "left").select("node", F.coalesce("component", "label").alias("component"))
    return out
