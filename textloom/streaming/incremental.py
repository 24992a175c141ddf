"""Documents that arrive as files, taken up once each."""

from pyspark.sql import functions as F

from textloom.schema import struct


def arrivals(spark, path: str, schema: str, file_format: str = "json", files_per_batch: int = 1000):
    """A stream of the rows of new files."""
    return spark.readStream.schema(struct(schema)).option("maxFilesPerTrigger", files_per_batch).format(file_format).load(path)


def new_texts(stream, time: str | None = None, delay: str = "7 days"):
    """Rows whose text the stream hasn't had before. With a time column, state older than the delay is dropped, and a copy after it counts as new."""
    stream = stream.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    if time is None:
        return stream.dropDuplicates(["text_sha256"])
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["text_sha256"])


def run_once(stream, path: str, checkpoint: str, file_format: str = "parquet"):
    """Takes up all that has arrived and stops; a later call goes on from there."""
    query = stream.writeStream.format(file_format).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
