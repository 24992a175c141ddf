"""JSON lines: strict reading, problems as rows, and writing."""

from pyspark.sql import functions as F

from textloom.schema import struct


def read(spark, path: str, schema: str, mode: str = "FAILFAST"):
    """Rows of JSON lines with the given columns and _ord, their order in the files. Blank lines are skipped; a line that isn't JSON is an error, or null in PERMISSIVE mode."""
    return _ordered(spark.read.schema(struct(schema)).option("mode", mode).json(path))


def _ordered(rows):
    # rises along each file and over files in the scan's order
    return rows.withColumn("_ord", F.monotonically_increasing_id())


def _is_nothing(v):
    """Whether a value has nothing in it, as Python's not has it: null, "", the number 0, false, [] and {}. The text "0" is something."""
    kind = F.schema_of_variant(v)
    as_text = F.try_variant_get(v, "$", "string")
    number = ~kind.isin("STRING", "BOOLEAN") & (F.try_variant_get(v, "$", "double") == 0)
    return F.coalesce(v.isNull() | F.is_variant_null(v) | F.when(kind == "STRING", as_text == "").otherwise(number | as_text.isin("false", "[]", "{}")), F.lit(False))


def problems(spark, path: str, schema: str, required=("version_id",), present=("text",)):
    """(line, problem): lines that aren't JSON, or lack a required value (see _is_nothing) or a key that must be there. line: the text itself."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    fields = struct(schema).add("_corrupt", "string")
    parsed = lines.select("value", F.from_json("value", fields, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}).alias("r"))
    parsed = parsed.withColumn("v", F.from_json("value", ", ".join(f"`{c}` VARIANT" for c in required))) if required else parsed
    keys = F.json_object_keys("value")
    problem = F.when(F.col("r._corrupt").isNotNull() | keys.isNull(), "not a JSON object")
    for c in required:
        problem = problem.when(_is_nothing(F.col(f"v.{c}")), f"no {c}")
    for c in present:
        problem = problem.when(~F.array_contains(keys, c), f"no key {c}")
    return parsed.select(F.col("value").alias("line"), problem.alias("problem")).where("problem IS NOT NULL")


def write(rows, path: str, mode: str = "error") -> None:
    """JSON lines with keys in order and nulls written. Files appear when the job commits."""
    rows.select(*sorted(c for c in rows.columns if not c.startswith("_"))).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_rejected(rows, path: str, reason: str = "reject_reason", mode: str = "error") -> None:
    """Rejected rows in a folder for each reason."""
    rows.write.mode(mode).partitionBy(reason).option("ignoreNullFields", "false").json(path)


def checked_paths(source: str, target: str) -> None:
    """Refuses to write where it reads."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("the output path is the input path")
