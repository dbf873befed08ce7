"""Event messages of orders, order lines and payments.

Topic names, event types, field names and field order are fixed values of the
message contract. A message is one row: topic, key, event_id, event_type,
event_time, business_date, value (JSON text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import money
from ..functions.temporal import contract_time, ds_of

ORDER_TOPIC = "ods_order_info"
DETAIL_TOPIC = "ods_order_detail"
PAYMENT_TOPIC = "ods_payment_info"

TOPIC_OF_TYPE = {
    "ORDER_CREATED": ORDER_TOPIC,
    "ORDER_DETAIL": DETAIL_TOPIC,
    "PAYMENT_SUCCESS": PAYMENT_TOPIC,
    "PAYMENT_FAILED": PAYMENT_TOPIC,
}
# Order of events that share one time.
TYPE_PRIORITY = {
    "ORDER_CREATED": 0,
    "ORDER_DETAIL": 1,
    "PAYMENT_SUCCESS": 2,
    "PAYMENT_FAILED": 2,
}

COMMON = "event_id string, event_type string, event_time timestamp_ntz, business_date string"
PAYLOADS = {
    ORDER_TOPIC: "order_id bigint, user_id bigint, shop_id bigint, "
    "order_amount decimal(20,2), create_time timestamp_ntz",
    DETAIL_TOPIC: "order_detail_id bigint, order_id bigint, sku_id bigint, sku_num int, "
    "original_amount decimal(20,2), final_amount decimal(20,2), create_time timestamp_ntz",
    PAYMENT_TOPIC: "payment_id bigint, order_id bigint, user_id bigint, "
    "payment_status string, payment_amount decimal(20,2), payment_time timestamp_ntz",
}

# Seconds or milliseconds; NTZ because contract times are local business times.
TIME_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSS]"}


def message_schema(topic: str) -> str:
    return f"{COMMON}, {PAYLOADS[topic]}"


def _field_names(topic: str) -> list[str]:
    return [part.split()[0] for part in PAYLOADS[topic].split(", ")]


#: What an event_id is made of, and the number in it of each topic's facts.
ID_PARTS = ("event_type", "event_date", "number")
NUMBERS = {ORDER_TOPIC: "order_id", DETAIL_TOPIC: "order_detail_id", PAYMENT_TOPIC: "payment_id"}


def _carried() -> dict[str, str]:
    """Fields of all payloads that ``message_rows`` hold, with their types: not the
    times, which are that of the event, and of the numbers only the order's."""
    kinds = dict(part.split(" ") for topic in PAYLOADS for part in PAYLOADS[topic].split(", "))
    own = {NUMBERS[DETAIL_TOPIC], NUMBERS[PAYMENT_TOPIC]}
    return {name: kind for name, kind in kinds.items() if not name.endswith("_time") and name not in own}


def _rows(df: DataFrame, topic: str, event_type: Column, time_column: str) -> DataFrame:
    own, time = _field_names(topic), F.col(time_column).cast("timestamp_ntz")
    fields = []
    for name, kind in _carried().items():
        column = F.col(name) if name in own else F.lit(None).cast(kind)
        fields.append((money(column) if name.endswith("_amount") else column).alias(name))
    return df.select(
        event_type.alias("event_type"),
        F.to_date(time).alias("event_date"),
        F.col(NUMBERS[topic]).alias("number"),
        time.alias("event_time"),
        F.col("order_id").cast("string").alias("key"),
        *fields,
    )


def written(rows: DataFrame) -> DataFrame:
    """The messages of ``message_rows``: their envelopes and texts."""
    kind, time = F.col("event_type"), F.col("event_time")
    day = ds_of(time)
    event_id = F.concat_ws(":", day, kind, F.col("number").cast("string"))
    envelope = [
        event_id.alias("event_id"),
        kind,
        contract_time(time).alias("event_time"),
        day.alias("business_date"),
    ]
    topic, value = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for name in PAYLOADS:
        kinds = [k for k, t in TOPIC_OF_TYPE.items() if t == name]
        # The time of a fact is the time of its event.
        body = [
            (contract_time(time) if c.endswith("_time") else F.col("number" if c == NUMBERS[name] else c)).alias(c)
            for c in _field_names(name)
        ]
        topic = topic.when(kind.isin(kinds), F.lit(name))
        value = value.when(kind.isin(kinds), F.to_json(F.struct(*envelope, *body)))
    return rows.select(
        topic.alias("topic"),
        F.col("order_id").cast("string").alias("key"),
        event_id.alias("event_id"),
        "event_type",
        "event_time",
        day.alias("business_date"),
        value.alias("value"),
    )


def order_rows(orders: DataFrame) -> DataFrame:
    return _rows(orders, ORDER_TOPIC, F.lit("ORDER_CREATED"), "create_time")


def detail_rows(details: DataFrame) -> DataFrame:
    return _rows(details, DETAIL_TOPIC, F.lit("ORDER_DETAIL"), "create_time")


def payment_rows(payments: DataFrame) -> DataFrame:
    kind = F.when(
        F.col("payment_status") == "SUCCESS", F.lit("PAYMENT_SUCCESS")
    ).otherwise(F.lit("PAYMENT_FAILED"))
    return _rows(payments, PAYMENT_TOPIC, kind, "payment_time")


def order_messages(orders: DataFrame) -> DataFrame:
    return written(order_rows(orders))


def detail_messages(details: DataFrame) -> DataFrame:
    return written(detail_rows(details))


def payment_messages(payments: DataFrame) -> DataFrame:
    return written(payment_rows(payments))


def message_rows(orders: DataFrame, details: DataFrame, payments: DataFrame) -> DataFrame:
    """All messages of the given facts before their texts are written: narrow rows."""
    return (
        order_rows(orders)
        .unionByName(detail_rows(details))
        .unionByName(payment_rows(payments))
    )


def message_log(orders: DataFrame, details: DataFrame, payments: DataFrame) -> DataFrame:
    """All messages of the given facts, unordered."""
    return (
        order_messages(orders)
        .unionByName(detail_messages(details))
        .unionByName(payment_messages(payments))
    )


def type_priority(event_type: Column) -> Column:
    cases = F.when(F.lit(False), F.lit(0))
    for kind, place in TYPE_PRIORITY.items():
        cases = cases.when(event_type == kind, F.lit(place))
    return cases


def in_send_order(log: DataFrame) -> DataFrame:
    """Global order: time, then type, then id (a range shuffle on all three)."""
    return log.orderBy("event_time", type_priority(F.col("event_type")), "event_id")


def parse(messages: DataFrame, topic: str) -> DataFrame:
    """Typed rows of one topic. Money goes from JSON text straight to decimal."""
    body = F.from_json(
        F.col("value").cast("string"),
        message_schema(topic),
        {**TIME_OPTIONS, "mode": "PERMISSIVE"},
    )
    return messages.where(F.col("topic") == topic).select(body.alias("_m")).select("_m.*")


def dedup_events(log: DataFrame, by: Sequence[str] = ("event_id",)) -> DataFrame:
    """One row per event_id. Resent messages are identical, so any copy will do.

    ``message_rows`` are told apart by the parts of their ids (``ID_PARTS``) and
    written afterwards, so that no text is shuffled.
    """
    return log.dropDuplicates(list(by))
