"""Parquet with a schema that is given, not found."""

from pyspark.sql import functions as F

from textloom.schema import struct


def write(rows, path: str, schema: str, order=(), mode: str = "error") -> None:
    """The schema's columns, in its order and of its kinds; a column that rows lack is null, others are left out. order: columns that files, and rows in them, are sorted by."""
    fields = struct(schema).fields
    out = rows.select(*[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    (out.orderBy(*order) if order else out).write.mode(mode).parquet(path)


def read(spark, path: str, schema: str):
    return spark.read.schema(struct(schema)).parquet(path)
