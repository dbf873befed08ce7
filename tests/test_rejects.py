"""Accepted and rejected messages: rules one by one, and both outcomes of a stream."""

import json

import pytest

import facts as f
from stratamart.streaming import consume, messages, rejects

RAW = "topic string, key string, value string"


@pytest.fixture(scope="module")
def texts(spark):
    log = messages.message_log(
        spark.createDataFrame([f.order(4)], f.ORDER),
        spark.createDataFrame([f.detail(40, 4)], f.DETAIL),
        spark.createDataFrame([f.payment(44, 4)], f.PAYMENT),
    )
    return {r.topic: json.loads(r.value) for r in log.collect()}


def changed(fields, drop=(), **values):
    return json.dumps({k: v for k, v in (fields | values).items() if k not in drop})


def rules(spark, *rows):
    out = {}
    for r in rejects.rejected(rejects.checked(spark.createDataFrame(list(rows), RAW))).collect():
        out.setdefault(r.value, set()).add(r.rule)
    return out


def test_each_rule(spark, texts):
    order, line, paid = (texts[t] for t in (messages.ORDER_TOPIC, messages.DETAIL_TOPIC, messages.PAYMENT_TOPIC))
    cases = [
        (messages.ORDER_TOPIC, "4", changed(order), set()),
        (messages.DETAIL_TOPIC, "4", changed(line, extra=1), set()),
        (messages.PAYMENT_TOPIC, "4", changed(paid), set()),
        (messages.ORDER_TOPIC, "4", "not json", {"unreadable"}),
        (messages.ORDER_TOPIC, "4", changed(order, order_id="four"), {"unreadable"}),
        (messages.ORDER_TOPIC, "4", changed(order, event_time="yesterday"), {"unreadable"}),
        (messages.ORDER_TOPIC, "5", changed(order, user_id=12), {"other_key"}),
        (messages.ORDER_TOPIC, None, changed(order, user_id=8), {"other_key"}),
        (messages.PAYMENT_TOPIC, "4", changed(order, user_id=9), {"topic_type", "required_missing"}),
        ("elsewhere", "4", changed(order, user_id=10), {"unknown_topic", "topic_type"}),
        (None, "4", changed(order, user_id=11), {"unknown_topic"}),
        (messages.ORDER_TOPIC, "4", changed(order, business_date="20260826"), {"business_date"}),
        (messages.ORDER_TOPIC, "4", changed(order, event_time="2026-08-25 12:00:01"), {"other_time"}),
        (messages.PAYMENT_TOPIC, "4", changed(paid, payment_status="FAILED"), {"status_type"}),
        (messages.ORDER_TOPIC, "4", changed(order, event_type="OTHER"), {"topic_type"}),
    ]
    for topic, fields in texts.items():
        cases += [(topic, "4", changed(fields, drop=[name]), {"required_missing"}) for name in fields
                  if name != "event_type"]
        cases += [(topic, "4", changed(fields, **{name: None}), {"required_missing"}) for name in fields
                  if name != "event_type"]
        cases.append((topic, "4", changed(fields, drop=["event_type"]), {"required_missing", "topic_type"}))
    found = rules(spark, *[c[:3] for c in cases], (messages.ORDER_TOPIC, "4", None))
    for _, _, value, expected in cases:
        assert found.get(value, set()) == expected, value
    assert found[None] == {"unreadable"}


def test_accepted_rows_are_typed_as_parse_types_them(spark, texts):
    rows = [(topic, "4", json.dumps(fields)) for topic, fields in texts.items()]
    raw = spark.createDataFrame([*rows, (messages.ORDER_TOPIC, "4", "{")], RAW)
    for topic in texts:
        got, whole = rejects.accepted(rejects.checked(raw), topic), messages.parse(raw, topic)
        assert got.schema == whole.schema
        assert got.collect() == [r for r in whole.collect() if r.event_id is not None]


def write(spark, path, rows):
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").json(str(path))


def test_a_stream_writes_both_outcomes_and_a_repeated_batch_once(spark, texts, tmp_path, monkeypatch):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    order = texts[messages.ORDER_TOPIC]

    def drain():
        stream = consume.file_stream(spark, str(source), 1)
        query = rejects.route(stream, out, checkpoint, once=True)
        query.awaitTermination(120)
        return query

    write(spark, source, [(messages.ORDER_TOPIC, "4", changed(order)), (messages.ORDER_TOPIC, "4", "broken"),
                          (messages.ORDER_TOPIC, "9", changed(order, user_id=1, business_date="20260101"))])
    drain()
    assert [r.order_id for r in rejects.routed_rows(spark, out, messages.ORDER_TOPIC).collect()] == [4]
    told = {(r.batch, r.value[:6], r.rule) for r in rejects.routed_rejects(spark, out).collect()}
    assert told == {(0, "broken", "unreadable"), (0, '{"even', "other_key"), (0, '{"even', "business_date")}

    # The second batch is written, then its query is lost before the batch is committed.
    real = rejects.write_batch

    def lost(rows, path, batch):
        real(rows, path, batch)
        raise RuntimeError("driver lost")

    write(spark, source, [(messages.ORDER_TOPIC, "4", changed(order, event_id="second")), (messages.ORDER_TOPIC, "4", "bad")])
    monkeypatch.setattr(rejects, "write_batch", lost)
    with pytest.raises(Exception, match="driver lost"):
        drain()
    monkeypatch.undo()
    drain()
    rows = rejects.routed_rows(spark, out, messages.ORDER_TOPIC).collect()
    assert sorted((r.batch, r.event_id) for r in rows) == [(0, order["event_id"]), (1, "second")]
    assert sorted(r.value for r in rejects.routed_rejects(spark, out).where("batch = 1").collect()) == ["bad"]


def test_the_text_is_parsed_once(spark, tmp_path):
    write(spark, tmp_path / "in", [(messages.ORDER_TOPIC, "4", "{}")])
    raw = spark.read.schema(RAW).json(str(tmp_path / "in"))
    for df in (rejects.rejected(rejects.checked(raw)), rejects.accepted(rejects.checked(raw), messages.ORDER_TOPIC)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_rejected_messages_do_not_reach_the_deduplicated_stream(spark, texts, tmp_path):
    order = texts[messages.ORDER_TOPIC]
    write(spark, tmp_path / "in", [(messages.ORDER_TOPIC, "4", changed(order)), (messages.ORDER_TOPIC, "4", "x"),
                                   (messages.ORDER_TOPIC, "4", "y")])
    stream = consume.deduplicated(consume.file_stream(spark, str(tmp_path / "in"), 1), messages.ORDER_TOPIC)
    consume.start(stream, f"{tmp_path}/rows", f"{tmp_path}/checkpoint", once=True).awaitTermination(120)
    assert [r.order_id for r in spark.read.parquet(f"{tmp_path}/rows").collect()] == [4]
