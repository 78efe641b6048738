"""Streams that resume where they stopped: files once, keys once, batches by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """The files of a folder, each read once over all runs with the same checkpoint."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(path)


def once_per_key(stream: DataFrame, keys: list[str], time: str | None = None, late: str = "7 days") -> DataFrame:
    """The first row of each key; with a time, keys are forgotten once the watermark has passed them."""
    if time is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def append_to(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Appends to a Parquet table: all there is now, or in batches by time (such as '15 seconds')."""
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def run_available(stream: DataFrame, path: str, checkpoint: str, timeout: int = 500) -> None:
    """Takes in all that is there and ends; a later call with the same checkpoint takes in only what is new."""
    q = append_to(stream, path, checkpoint)
    if not q.awaitTermination(timeout):
        q.stop()
        raise TimeoutError(f"the stream took more than {timeout} s")
