"""Streams over several batches and runs: lines without their order, the ledger of late rows."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

import facts as f
from stratamart.streaming import consume, contract, messages
from stratamart.streaming.rejects import accepted, checked

RAW = "topic string, key string, value string"


def at(seconds):
    return f.NOON + dt.timedelta(seconds=seconds)


def order(spark, number, seconds):
    return messages.order_messages(spark.createDataFrame([f.order(number, created=at(seconds))], f.ORDER))


def line(spark, number, owner, seconds):
    return messages.detail_messages(spark.createDataFrame([f.detail(number, owner, created=at(seconds))], f.DETAIL))


def send(path, log):
    """One file of messages, in arrival order."""
    path.mkdir(exist_ok=True)
    name = f"{len(list(path.iterdir())):05d}.json"
    rows = [json.dumps({"topic": r.topic, "key": r.key, "value": r.value}) for r in log.collect()]
    (path / name).write_text("\n".join(rows))
    os.utime(path / name, (1_000_000_000 + len(list(path.iterdir())),) * 2)  # read in this order


def typed(spark, source, topic):
    return accepted(checked(consume.file_stream(spark, str(source), 1)), topic)


def run(spark, tmp_path, source):
    lonely = consume.lines_without_order(
        typed(spark, source, messages.DETAIL_TOPIC), typed(spark, source, messages.ORDER_TOPIC)
    )
    query = consume.start(lonely, f"{tmp_path}/rows", f"{tmp_path}/checkpoint", once=True)
    query.awaitTermination(200)


def test_a_line_whose_order_does_not_come_is_emitted(spark, tmp_path):
    source = tmp_path / "in"
    first = [
        order(spark, 1, 0), line(spark, 10, 1, 1),  # on time
        line(spark, 20, 2, 5),  # its order comes in the next batch
        line(spark, 30, 3, 6),  # its order comes too late
        line(spark, 40, 4, 7),  # no order at all
    ]
    log = first[0]
    for part in first[1:]:
        log = log.unionByName(part)
    send(source, log)
    send(source, order(spark, 2, 60).unionByName(line(spark, 50, 5, 61)).unionByName(order(spark, 5, 61)))
    run(spark, tmp_path, source)
    assert spark.read.schema("order_id long").parquet(f"{tmp_path}/rows").count() == 0
    # Both topics move on beyond both bounds; then the late order arrives, after a restart.
    send(source, order(spark, 6, 900).unionByName(line(spark, 60, 6, 900)))
    send(source, order(spark, 7, 901).unionByName(line(spark, 70, 7, 901)))
    run(spark, tmp_path, source)
    send(source, order(spark, 3, 600).unionByName(order(spark, 8, 1800)).unionByName(line(spark, 80, 8, 1800)))
    send(source, order(spark, 9, 1801).unionByName(line(spark, 90, 9, 1801)))
    run(spark, tmp_path, source)
    got = sorted((r.order_detail_id, r.order_id) for r in spark.read.parquet(f"{tmp_path}/rows").collect())
    assert got == [(30, 3), (40, 4)]
    # The recorded log says the same of lines that arrived without or before their order by the bound.
    raw = spark.read.schema(RAW).json(str(source)).withColumn("event_time", F.get_json_object("value", "$.event_time"))
    arrived = raw.withColumn("arrival_time", F.col("event_time").cast("timestamp_ntz"))
    report = contract.detail_before_order(arrived).collect()
    absent = {int(r.key) for r in report if r.order_arrival is None}
    far = {int(r.key) for r in report
           if r.order_arrival is not None and r.order_arrival - r.first_detail_arrival > dt.timedelta(minutes=2)}
    assert absent | far == {o for _, o in got}


def test_the_ledger_counts_over_runs_and_many_batches(spark, tmp_path):
    source, late = tmp_path / "in", consume.LateRows(spark, str(tmp_path / "late"))
    spark.streams.addListener(late)
    expected = 0

    def drain():
        stream = consume.deduplicated(consume.file_stream(spark, str(source), 1), messages.ORDER_TOPIC)
        query = consume.start(stream, f"{tmp_path}/rows", f"{tmp_path}/checkpoint", once=True)
        query.awaitTermination(600)
        last = query.lastProgress["batchId"]
        for _ in range(300):
            if late.behind(query) >= last:
                return str(query.id)
            time.sleep(0.1)
        raise AssertionError("progress did not arrive")

    text = order(spark, 1, 0).first().value
    source.mkdir()

    def put(number, seconds):
        moment = at(seconds).strftime("%Y-%m-%d %H:%M:%S.000")
        fields = json.loads(text) | {"event_id": str(number), "event_time": moment, "create_time": moment}
        fields["business_date"] = at(seconds).strftime("%Y%m%d")
        row = json.dumps({"topic": messages.ORDER_TOPIC, "key": "1", "value": json.dumps(fields)})
        file = source / f"{number:05d}.json"
        file.write_text(row)
        os.utime(file, (1_000_000_000 + number,) * 2)  # read in this order

    try:
        for i in range(12):
            put(i, i * 600 if i % 3 else 0)  # every third is far behind, but the first
            expected += i % 3 == 0 and i > 1
        query = drain()
        assert late.of(query) == expected
        for i in range(12, 112):
            put(i, i * 600 if i % 10 else 0)
            expected += i % 10 == 0
        assert drain() == query
        assert late.of(query) == expected and len(late.batches(query)) >= 112
        assert consume.LateRows(spark, str(tmp_path / "late")).of(query) == expected  # another process
    finally:
        spark.streams.removeListener(late)
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 112 - expected
