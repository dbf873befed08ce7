"""Checks of a recorded message log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.temporal import ds_of, has_sub_millis
from .messages import DETAIL_TOPIC, ORDER_TOPIC, PAYMENT_TOPIC, TOPIC_OF_TYPE

MAX_DISORDER_SECONDS = 120


def expected_topic(event_type: Column) -> Column:
    cases = F.when(F.lit(False), F.lit(""))
    for kind, topic in TOPIC_OF_TYPE.items():
        cases = cases.when(event_type == kind, F.lit(topic))
    return cases


def row_violations(log: DataFrame) -> DataFrame:
    """Messages that break the contract by themselves: rule and event_id.

    A missing value breaks its rule. A message whose text is no JSON object, or
    whose text names another id than its envelope, is ``unreadable``.
    """
    status = F.get_json_object("value", "$.payment_status")
    succeeded = F.col("event_type").eqNullSafe("PAYMENT_SUCCESS")
    wrong_status = (F.col("topic") == PAYMENT_TOPIC) & (
        (succeeded != status.eqNullSafe("SUCCESS")) | status.isNull()
    )
    text_id = F.get_json_object("value", "$.event_id")
    rules = {
        "topic_type": ~F.col("topic").eqNullSafe(expected_topic(F.col("event_type"))),
        "unreadable": F.col("event_id").isNull() | ~text_id.eqNullSafe(F.col("event_id")),
        "business_date": F.col("event_time").isNull()
        | ~F.col("business_date").eqNullSafe(ds_of(F.col("event_time"))),
        "status_type": wrong_status,
        "below_millis": has_sub_millis(F.col("event_time")),
    }
    hits = F.array_compact(
        F.array(*[F.when(bad, F.lit(rule)) for rule, bad in rules.items()])
    )
    return log.select(F.explode(hits).alias("rule"), "event_id")


def violations(log: DataFrame) -> DataFrame:
    """Row violations and repeated ids, one row per rule and event_id."""
    repeated = (
        log.groupBy("event_id")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .select(F.lit("repeated_id").alias("rule"), "event_id")
    )
    return row_violations(log).distinct().union(repeated)


def topic_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("topic", "event_type").agg(F.count("*").alias("event_count"))


def missing_messages(log: DataFrame, facts: dict[str, DataFrame]) -> DataFrame:
    """Topics whose number of messages is not the number of fact rows."""
    sides = log.select("topic", F.lit(0).alias("facts"), F.lit(1).alias("messages"))
    for topic, df in facts.items():
        sides = sides.unionByName(
            df.select(
                F.lit(topic).alias("topic"),
                F.lit(1).alias("facts"),
                F.lit(0).alias("messages"),
            )
        )
    return (
        sides.groupBy("topic")
        .agg(F.sum("facts").alias("facts"), F.sum("messages").alias("messages"))
        .where(F.col("facts") != F.col("messages"))
    )


def running_latest(log: DataFrame) -> DataFrame:
    """Per arrival time: the latest event time that has arrived so far.

    An exact running maximum over the whole log without a single-task window.
    Arrivals are grouped by arrival time and cut into minutes and days. Inside
    a minute the window sees one row per distinct arrival time (at most 60,000
    at millisecond precision); what came before is the maximum of earlier
    minutes of the day (1,440 rows per day) and of earlier days (365 rows per
    year), whatever the traffic.
    """
    arrival = F.col("arrival_time")
    instants = (
        log.groupBy("arrival_time")
        .agg(F.max("event_time").alias("newest"))
        .withColumn("minute", F.date_format(arrival, "yyyyMMddHHmm"))
        .withColumn("day", ds_of(arrival))
    )
    minutes = instants.groupBy("day", "minute").agg(F.max("newest").alias("newest"))
    days = minutes.groupBy("day").agg(F.max("newest").alias("newest"))

    def max_over(window) -> Column:
        return F.max("newest").over(window)

    before = Window.unboundedPreceding, -1
    earlier_days = days.select(
        "day", max_over(Window.orderBy("day").rowsBetween(*before)).alias("_days")
    )
    earlier_minutes = minutes.select(
        "day",
        "minute",
        max_over(
            Window.partitionBy("day").orderBy("minute").rowsBetween(*before)
        ).alias("_minutes"),
    )
    so_far = max_over(
        Window.partitionBy("day", "minute")
        .orderBy("arrival_time")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        instants.withColumn("_now", so_far)
        .join(earlier_minutes, ["day", "minute"])
        .join(earlier_days, "day")
        .select("arrival_time", F.greatest("_now", "_minutes", "_days").alias("latest"))
    )


def disorder(log: DataFrame, bound: int = MAX_DISORDER_SECONDS) -> DataFrame:
    """Events that arrived more than ``bound`` seconds behind the newest event.

    Events are grouped by (arrival, event time) before the join, so a burst at
    one instant travels as few rows; the count keeps every event.
    """
    moments = log.groupBy("arrival_time", "event_time").agg(F.count("*").alias("events"))
    lag = F.unix_micros(F.col("latest").cast("timestamp")) - F.unix_micros(
        F.col("event_time").cast("timestamp")
    )
    return (
        moments.join(running_latest(log), "arrival_time")
        .withColumn("lag_seconds", (lag / 1_000_000).cast("decimal(18,3)"))
        .where(F.col("lag_seconds") > bound)
        .select("arrival_time", "event_time", "events", "lag_seconds")
    )


def detail_before_order(log: DataFrame) -> DataFrame:
    """Orders of which some line arrived before the order itself, or without it.

    One grouped pass on the key instead of a self join of the log.
    """
    order_at = F.min(F.when(F.col("topic") == ORDER_TOPIC, F.col("arrival_time")))
    detail_at = F.min(F.when(F.col("topic") == DETAIL_TOPIC, F.col("arrival_time")))
    return (
        log.where(F.col("topic").isin(ORDER_TOPIC, DETAIL_TOPIC))
        .groupBy("key")
        .agg(order_at.alias("order_arrival"), detail_at.alias("first_detail_arrival"))
        .where(
            F.col("first_detail_arrival").isNotNull()
            & (
                F.col("order_arrival").isNull()
                | (F.col("first_detail_arrival") < F.col("order_arrival"))
            )
        )
    )
