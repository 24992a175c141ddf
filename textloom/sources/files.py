"""Files as rows: texts, archives, books and their sidecars."""

from pyspark.sql import functions as F

from textloom.functions import markup
from textloom.schema import SIDECAR, struct

_BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def binary(spark, path: str, glob: str | None = None, recursive: bool = True):
    """(path, folder, name, length, content) of files."""
    reader = spark.read.format("binaryFile").schema(_BINARY).option("recursiveFileLookup", str(recursive).lower())
    rows = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    return rows.select("path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"), F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length", "content")


def decoded(content):
    """Bytes as UTF-8 without a byte order mark at the start, bad bytes replaced."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), r"\A\x{FEFF}", "")


def fingerprints(files):
    """(path, byte_count, sha256)."""
    return files.select("path", F.col("length").alias("byte_count"), F.sha2("content", 256).alias("sha256"))


def texts(spark, path: str):
    """(path, source_id, text) of all .txt files, and of layout archives in folders without one. source_id: the folder's name."""
    files = binary(spark, path).where(F.col("name").endswith(".txt") | F.col("name").endswith("_abbyy.gz"))
    plain = files.where(F.col("name").endswith(".txt"))
    layout = files.where(F.col("name").endswith("_abbyy.gz")).join(plain.select("folder").distinct(), "folder", "left_anti")
    both = plain.select("path", "folder", decoded(F.col("content")).alias("text")).unionByName(layout.select("path", "folder", markup.text_of_file("path", "content").alias("text")))
    return both.select("path", F.regexp_extract("folder", r"([^/]*)$", 1).alias("source_id"), "text")


def candidates(spark, path: str):
    """(source_id, path): of each folder the file to read, by its kind, then by name."""
    name = F.col("name")
    rank = F.when(name.endswith("_txt.zip"), 0).when(name.endswith("_djvu.txt"), 1).when(name.endswith("_abbyy.gz"), 2).when(name.endswith(".txt"), 3).when(name.endswith(".zip"), 4)
    files = binary(spark, path).drop("content").withColumn("rank", rank).where("rank IS NOT NULL")
    return files.groupBy(F.regexp_extract("folder", r"([^/]*)$", 1).alias("source_id")).agg(F.min_by("path", F.struct("rank", "name")).alias("path"))


def candidate_texts(spark, path: str):
    """(source_id, path, text) of each folder's file to read; a file that can't be read has an empty text."""
    chosen = candidates(spark, path)
    return binary(spark, path).join(chosen, "path").select("source_id", "path", markup.text_of_file("path", "content").alias("text"))


def books(spark, path: str):
    """(path, text, counts of pages by fate, skipped_filenames, error) of EPUB files."""
    return binary(spark, path, "*.epub").select("path", markup.text_of_epub("content").alias("b")).select("path", "b.*")


def sidecars(spark, path: str):
    """Acquisition records, a file each."""
    return spark.read.schema(struct(SIDECAR)).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "metadata.json").json(path)


def missing_files(manifest, files, path: str = "raw_path"):
    """Manifest rows whose file isn't among files (path)."""
    return manifest.join(files.select(F.col("path").alias(path)), path, "left_anti")
