"""How many rows go to Python at a time."""

from pyspark.sql import SparkSession

#: Rows and bytes of an Arrow batch, at most.
BATCH_ROWS, BATCH_BYTES = 500, 2 << 20


def short_batches(spark=None) -> None:
    """Rows of texts go to Python this many at a time: with the default of 10,000, long texts would fill a worker's memory, and the executor's. A shorter limit of the session stays."""
    spark = spark or SparkSession.active()
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def on_texts(function):
    """An Arrow function of texts: where a column of it is made, the session's batches get short."""

    def of(*columns):
        short_batches()
        return function(*columns)

    of.__name__, of.__doc__ = function.__name__, function.__doc__
    return of
