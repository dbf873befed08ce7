"""Sending event messages in slices of event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming.messages import type_priority

SLICE_SECONDS = 60
#: The slice of messages without event_time, after that of every time.
UNTIMED = 2**62


def send_slices(
    log: DataFrame, staging: str, send: Callable[[DataFrame], None], seconds: int = SLICE_SECONDS
) -> int:
    """Send a log slice by slice of event time, each after the one before it.

    Tasks of one write run at the same time, so what they send mixes. A slice is
    shorter than the disorder that consumers allow for, hence no mixing makes a
    message late. Inside a slice a key belongs to one task, in time order. The
    log is staged once, split by slice; only the numbers of its slices (1,440 a
    day at most) come to the driver. Messages without event_time make up a last
    slice of their own. Returns how many were sent.
    """
    number = F.floor(F.unix_seconds(F.col("event_time").cast("timestamp")) / seconds)
    log.withColumn("slice", F.coalesce(number, F.lit(UNTIMED))).write.mode("overwrite").partitionBy("slice").parquet(staging)
    staged = log.sparkSession.read.parquet(staging)
    numbers = sorted(row.slice for row in staged.select("slice").distinct().collect())
    order = ["key", "event_time", type_priority(F.col("event_type")), "event_id"]
    for n in numbers:
        rows = staged.where(F.col("slice") == n).repartition("key").sortWithinPartitions(*order)
        send(rows.select("topic", "key", "value"))
    return len(numbers)


def send_to_kafka(log: DataFrame, servers: str, staging: str) -> int:
    """Send messages to their topics in slices (needs the Kafka connector).

    ``key`` decides the topic partition, so an order's messages stay together.
    The idempotent producer with acks=all keeps broker retries from repeating a
    message; a retried Spark task may, which is why consumers drop repeated
    event_ids.
    """

    def send(rows: DataFrame) -> None:
        (
            rows.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all")
            .option("kafka.enable.idempotence", "true")
            .option("kafka.retries", "3")
            .save()
        )

    return send_slices(log, staging, send)


def send_to_folder(log: DataFrame, path: str, staging: str) -> int:
    """Write messages as JSON lines with topic, key and value, slice after slice."""
    return send_slices(log, staging, lambda rows: rows.write.mode("append").json(path))
