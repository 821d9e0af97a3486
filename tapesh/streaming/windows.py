"""Streams of messages: counts by day window with late data, new messages once, and a pipeline per closed batch.

State is bounded by the watermark: a window's counts, or the ids seen, are
kept until it passes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapesh.models.interfaces import classify, rule_classifier
from tapesh.runtime import scratch_scope


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """Messages from the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def day_counts(stream: DataFrame, ts: str, text: str, late: str = "1 day") -> DataFrame:
    """day, raw_count, kept_count per day window; rows later than the watermark are left out."""
    rows = classify(stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late), text, rule_classifier())
    out = rows.groupBy(F.window("_ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("raw_count"), F.count_if("passed_filter").alias("kept_count"))
    return out.select(F.to_date("w.start").alias("day"), "raw_count", "kept_count")


def hour_counts(stream: DataFrame, ts: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """keys, day, hour, n: the histogram that the hourly spike is made of."""
    rows = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    out = rows.groupBy(*keys, F.window("_ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.to_date("w.start").alias("day"), F.hour("w.start").alias("hour"), "n")


def first_seen(stream: DataFrame, key: str, ts: str, late: str = "1 day") -> DataFrame:
    """Each key once, as long as its repetition is not later than the watermark."""
    return stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late).dropDuplicatesWithinWatermark([key]).drop("_ts")


def run_batches(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """work on each micro-batch, until what is there is done; a batch that failed comes again with its number."""

    def batch(df: DataFrame, number: int) -> None:
        with scratch_scope():  # what a batch writes for itself goes with it
            work(df, number)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
