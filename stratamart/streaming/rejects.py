"""Messages that break the contract, told apart while they are read.

A message text is parsed once, with the fields of all topics. What is readable,
complete and agrees with its topic and key is accepted and typed; the rest is
rejected with its text and the rules it breaks. In a stream both come out of one
write per batch (``route``): a folder per batch number, one part per outcome. A
batch that is run again replaces its own folder, so each message is in one
outcome once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.temporal import ds_of
from .contract import expected_topic
from .messages import COMMON, PAYLOADS, PAYMENT_TOPIC, TIME_OPTIONS, message_schema

CORRUPT = "_corrupt"
REJECTS = "rejects"
_TIME_OF = {topic: "payment_time" if topic == PAYMENT_TOPIC else "create_time" for topic in PAYLOADS}


def _all_fields() -> dict[str, str]:
    fields: dict[str, str] = {}
    for ddl in (COMMON, *PAYLOADS.values()):
        fields |= dict(part.split(" ", 1) for part in ddl.split(", "))
    return fields


def _names(topic: str) -> list[str]:
    return [part.split()[0] for part in message_schema(topic).split(", ")]


def _by_topic(conditions: dict[str, Column]) -> Column:
    cases = F.when(F.lit(False), F.lit(False))
    for topic, condition in conditions.items():
        cases = cases.when(F.col("topic") == topic, condition)
    return F.coalesce(cases, F.lit(False))


def _rules() -> dict[str, Column]:
    """True for a message that breaks the rule; missing fields break ``required_missing`` alone."""
    m = {name: F.col(f"m.{name}") for name in _all_fields()}
    succeeded = m["event_type"] == "PAYMENT_SUCCESS"
    return {
        "unknown_topic": ~F.coalesce(F.col("topic").isin(*PAYLOADS), F.lit(False)),
        "required_missing": _by_topic(
            {t: reduce(lambda a, b: a | b, [m[n].isNull() for n in _names(t)]) for t in PAYLOADS}
        ),
        "topic_type": F.col("topic") != F.coalesce(expected_topic(m["event_type"]), F.lit("")),
        "other_key": ~F.col("key").eqNullSafe(m["order_id"].cast("string")) & m["order_id"].isNotNull(),
        "business_date": m["business_date"] != ds_of(m["event_time"]),
        "other_time": _by_topic({t: m["event_time"] != m[_TIME_OF[t]] for t in PAYLOADS}),
        "status_type": _by_topic({PAYMENT_TOPIC: succeeded != (m["payment_status"] == "SUCCESS")}),
    }


def checked(messages: DataFrame) -> DataFrame:
    """topic, key, value of each message, its parsed fields ``m`` and the ``rules`` it breaks."""
    shape = ", ".join(f"{name} {kind}" for name, kind in _all_fields().items())
    options = {**TIME_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = F.col("value").cast("string")
    parsed = F.from_json(text, f"{shape}, {CORRUPT} string", options)
    unreadable = F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull()
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in _rules().items()]))
    rules = F.when(unreadable, F.array(F.lit("unreadable"))).otherwise(broken)
    # Out of a generator, so that conditions on fields or rules, which the optimizer
    # moves down, are not answered by parsing the text again for each of them.
    once = F.explode(F.array(parsed)).alias("m")
    return messages.select("topic", "key", text.alias("value"), once).withColumn("rules", rules)


def accepted(checked_messages: DataFrame, topic: str) -> DataFrame:
    """Typed rows of one topic."""
    good = checked_messages.where((F.col("topic") == topic) & (F.size("rules") == 0))
    return good.select(*[F.col(f"m.{name}").alias(name) for name in _names(topic)])


def rejected(checked_messages: DataFrame) -> DataFrame:
    """(topic, key, value, rule), a row for each rule that a message breaks."""
    rule = F.explode_outer("rules").alias("rule")
    return checked_messages.select("topic", "key", "value", rule).where(F.col("rule").isNotNull())


def write_batch(messages: DataFrame, path: str, batch: int) -> None:
    """Both outcomes of one batch in one write; a repeated batch replaces itself."""
    rows = checked(messages)
    outcome = F.when(F.size("rules") == 0, F.col("topic")).otherwise(F.lit(REJECTS))
    good = F.size("rules") == 0
    rows.select(
        "topic",
        "key",
        F.when(~good, F.col("value")).alias("value"),  # an accepted text is in its fields
        F.when(good, F.col("m").dropFields(CORRUPT)).alias("m"),
        "rules",
        outcome.alias("outcome"),
    ).write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/batch={batch}")


def route(stream: DataFrame, path: str, checkpoint: str, *, once: bool = False) -> StreamingQuery:
    """Write every batch of raw messages as accepted and rejected rows."""
    writer = (
        stream.writeStream.foreachBatch(lambda rows, batch: write_batch(rows, path, batch))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")
    return writer.start()


def _routed(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    shape = ", ".join(f"{name}: {kind}" for name, kind in _all_fields().items())
    schema = f"topic string, key string, value string, m struct<{shape}>, rules array<string>, batch long, outcome string"
    return spark.read.schema(schema).parquet(path).where(F.col("outcome") == outcome)


def routed_rows(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Accepted rows of one topic with the batch that wrote them."""
    names = [F.col(f"m.{name}").alias(name) for name in _names(topic)]
    return _routed(spark, path, topic).select("batch", *names)


def routed_rejects(spark: SparkSession, path: str) -> DataFrame:
    rows = _routed(spark, path, REJECTS)
    return rows.select("batch", "topic", "key", "value", F.explode("rules").alias("rule"))
