"""Incremental runs: append what is new, retry what failed, windows over events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def append_new(spark: SparkSession, source: str, schema: StructType, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, files_at_once: int = 10) -> None:
    """Runs ``work`` over the files of a folder that were not seen before and appends the result, then stops.

    The stream's checkpoint is the set of what is done: a rerun reads new files only, and a run that broke off goes on where it was.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    work(stream).writeStream.format("parquet").outputMode("append").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def in_batches(spark: SparkSession, source: str, schema: StructType, commit: Callable[[DataFrame, int], None], checkpoint: str, files_at_once: int = 10) -> None:
    """Hands micro-batches of files to ``commit``, once each as far as the checkpoint tells."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items that the log of finished ones lacks."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def retry_queue(queue: DataFrame, failed: DataFrame, succeeded: DataFrame, key: str) -> DataFrame:
    """The queue after a run: what succeeded leaves, what failed joins, with its number of tries."""
    old = queue.join(succeeded.select(key).distinct(), key, "left_anti")
    f = failed.select(key).distinct().withColumn("_f", F.lit(1))
    j = old.select(key, "tries").join(f, key, "full")
    return j.select(key, (F.coalesce("tries", F.lit(0)) + F.coalesce("_f", F.lit(0))).alias("tries"))


def _timed(events: DataFrame, late: str) -> DataFrame:
    """Event time with a watermark; streams need a timestamp with a zone."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums by window and type, on a stream or a table; on a stream, events later than ``late`` are dropped."""
    w = _timed(events, late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a user by gaps, on a stream or a table."""
    s = _timed(events, late).groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")
