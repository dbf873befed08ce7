"""Structured Streaming side of the contract: parse, watermark, dedup, count late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..storage import create_marker, delete_folder, names_in
from .messages import DETAIL_TOPIC
from .rejects import accepted, checked

WATERMARK = "2 minutes"
RAW_SCHEMA = "topic string, key string, value string"


def kafka_stream(spark: SparkSession, servers: str, topics: list[str]) -> DataFrame:
    """Raw messages of Kafka topics (needs the Spark Kafka connector)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .load()
        .select(
            "topic",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
        )
    )


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Raw messages from a directory of JSON lines with topic, key and value."""
    return (
        spark.readStream.schema(RAW_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def deduplicated(stream: DataFrame, topic: str, watermark: str = WATERMARK) -> DataFrame:
    """Typed events of one topic, each event_id once within the watermark.

    Only messages that keep the contract: a rejected one has no id or time to go
    by, and all such would share one key. ``rejects.route`` writes those.

    State is keyed by event_id, spread over all shuffle partitions, and dropped
    when the watermark passes. A resend later than that is caught by the batch
    dedup on event_id. Order lines are deduplicated by their business key.
    """
    key = "order_detail_id" if topic == DETAIL_TOPIC else "event_id"
    events = accepted(checked(stream), topic)
    # Watermarks need a zoned timestamp; contract times are in the session zone.
    events = events.withColumn("event_time", F.col("event_time").cast("timestamp"))
    return events.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark([key])


def start(
    events: DataFrame, path: str, checkpoint: str, *, once: bool = False
) -> StreamingQuery:
    """Write events as parquet, exactly once; ``once`` drains what is there and stops."""
    writer = (
        events.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(
        processingTime="10 seconds"
    )
    return writer.start()


def lines_without_order(lines: DataFrame, orders: DataFrame, bound: str = WATERMARK) -> DataFrame:
    """Order lines (typed streams of both topics) whose order does not come in time.

    An outer join of two streams, bounded by event time: a line waits for an
    order whose time is at most ``bound`` before or after its own. Both sides'
    watermarks tell when none can come any more; the line is then emitted with
    its key and time, once, and leaves the state. An order that comes later
    still is behind the watermark and changes nothing. State holds the lines and
    orders of the last two bounds, spread by order_id.
    """
    line = lines.select("order_detail_id", F.col("order_id").alias("line_order_id"),
                        F.col("event_time").cast("timestamp").alias("line_time"))
    order = orders.select("order_id", F.col("event_time").cast("timestamp").alias("order_time"))
    in_time = (
        (F.col("line_order_id") == F.col("order_id"))
        & (F.col("order_time") >= F.col("line_time") - F.expr(f"interval {bound}"))
        & (F.col("order_time") <= F.col("line_time") + F.expr(f"interval {bound}"))
    )
    joined = line.withWatermark("line_time", bound).join(
        order.withWatermark("order_time", bound), in_time, "left_outer"
    )
    return joined.where(F.col("order_id").isNull()).select(
        "order_detail_id", F.col("line_order_id").alias("order_id"), F.col("line_time").alias("event_time")
    )


class LateRows(StreamingQueryListener):
    """A ledger of the rows that queries drop behind their watermark.

    Every batch leaves one empty file, named by its number and its late rows, in
    a folder of its query under ``ledger``, best beside the checkpoint. A restart
    goes on counting where the ledger stands, a batch that runs again counts
    once, and any process can read it. Add the listener to ``spark.streams``
    before a query starts; progress arrives shortly after a batch ends, and
    ``behind`` tells up to which batch the ledger goes.
    """

    def __init__(self, spark: SparkSession, ledger: str) -> None:
        self.spark, self.ledger = spark, ledger.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        folder = f"{self.ledger}/{progress.id}"
        for name in names_in(self.spark, folder):
            number, counted = map(int, name.split("_"))
            if number == progress.batchId:  # run again, or an idle trigger after it
                if counted >= late:
                    return
                delete_folder(self.spark, f"{folder}/{name}")
        create_marker(self.spark, f"{folder}/{progress.batchId:012d}_{late}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def batches(self, query: StreamingQuery | str) -> dict[int, int]:
        """Late rows by batch number; a query is named by its id, which its checkpoint keeps."""
        number = query if isinstance(query, str) else str(query.id)
        return dict(tuple(map(int, n.split("_"))) for n in names_in(self.spark, f"{self.ledger}/{number}"))

    def of(self, query: StreamingQuery | str) -> int:
        return sum(self.batches(query).values())

    def behind(self, query: StreamingQuery | str) -> int:
        """The last batch that the ledger holds, -1 if none."""
        return max(self.batches(query), default=-1)
