"""Arrival rates and topic depth from offsets and timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE_SECONDS = 15


def windowed_rate(events: DataFrame, at: str, seconds: int = SAMPLE_SECONDS) -> DataFrame:
    """Events per second in tumbling windows; works on batches and on watermarked streams."""
    return (
        events.groupBy(F.window(at, f"{seconds} seconds").alias("window"))
        .agg(F.count("*").alias("events"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "events",
            (F.col("events") / F.lit(float(seconds))).alias("events_per_second"),
        )
    )


def offset_samples(log: DataFrame, seconds: int = SAMPLE_SECONDS) -> DataFrame:
    """First and end offset of each topic partition at every scrape tick that saw messages.

    ``log`` has topic, partition, offset and timestamp; offsets count within a partition.
    """
    tick = F.window("timestamp", f"{seconds} seconds").getField("end")
    return log.groupBy("topic", "partition", tick.alias("sampled_at")).agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("end_offset")
    )


def sampled_rate(samples: DataFrame) -> DataFrame:
    """Growth of a topic's end offsets, summed over its partitions, between successive ticks.

    A partition that appears later counts from its first offset; the first tick of a topic has
    rate 0. Samples are one row per partition and tick, so a window over one partition grows with
    time (5,760 rows a day), not with the number of messages.
    """
    of_partition = Window.partitionBy("topic", "partition").orderBy("sampled_at")
    so_far = of_partition.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = samples.select(
        "topic",
        "partition",
        "sampled_at",
        F.max("end_offset").over(so_far).alias("end_offset"),
        F.min("first_offset").over(so_far).alias("first_offset"),
    )
    before = F.coalesce(F.lag("end_offset").over(of_partition), "first_offset")
    grown = reached.select(
        "topic", "sampled_at", (F.col("end_offset") - before).alias("messages")
    )
    ticks = grown.groupBy("topic", "sampled_at").agg(F.sum("messages").alias("messages"))
    previous = F.lag("sampled_at").over(Window.partitionBy("topic").orderBy("sampled_at"))
    elapsed = F.unix_micros("sampled_at") - F.unix_micros(previous)
    rate = F.col("messages") * F.lit(1_000_000.0) / elapsed
    return ticks.withColumn("events_per_second", F.coalesce(rate, F.lit(0.0)))


def offset_ranges(log: DataFrame) -> DataFrame:
    """Begin and end offset of every topic partition."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset")
    )


def topic_depth(ranges: DataFrame) -> DataFrame:
    """Retained messages of each topic over all its partitions; reading does not lower it."""
    return ranges.groupBy("topic").agg(
        F.sum(F.col("end_offset") - F.col("begin_offset")).alias("depth")
    )
