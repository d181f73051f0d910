"""The funnel over a stream of events: counts by window and session with watermarks, and first sightings.

An addition: batch runs need none of it. Late rows beyond the watermark are dropped, as Structured Streaming does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, files_per_batch: int = 16) -> DataFrame:
    """A stream of the Parquet files of a folder."""
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_batch).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def window_counts(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, event_type, n, value) of tumbling windows."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
    return w.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "1 day", late: str = "2 days") -> DataFrame:
    """(user_id, first, last, n): a user's events without a gap between them."""
    s = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.col("session_window.start").alias("first"), F.col("session_window.end").alias("last"), "n")


def first_sightings(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Each event once, however often it is delivered within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Take what is there and stop; a later call goes on from the checkpoint."""
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start().awaitTermination()
