import datetime as dt
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import facts as f
from stratamart.sinks.topics import send_slices, send_to_folder
from stratamart.streaming import consume, contract, messages

ORDER_ID, LINE_ID, PAID_ID, FAILED_ID = 77, 7701, 7791, 7792
CREATED = f.NOON + dt.timedelta(seconds=41, milliseconds=7)
LATER = {LINE_ID: dt.timedelta(milliseconds=50), PAID_ID: dt.timedelta(seconds=95, milliseconds=600),
         FAILED_ID: dt.timedelta(seconds=40)}


@pytest.fixture(scope="module")
def log(spark):
    orders = spark.createDataFrame([f.order(ORDER_ID, 5, 3, amount=120.5, created=CREATED)], f.ORDER)
    details = spark.createDataFrame(
        [f.detail(LINE_ID, ORDER_ID, 6, 2, 120.5, CREATED + LATER[LINE_ID], original=130)], f.DETAIL)
    payments = spark.createDataFrame(
        [f.payment(PAID_ID, ORDER_ID, 5, amount=120.5, paid=CREATED + LATER[PAID_ID]),
         f.payment(FAILED_ID, ORDER_ID, 5, status="FAILED", amount=0, paid=CREATED + LATER[FAILED_ID])], f.PAYMENT)
    return messages.message_log(orders, details, payments)


def _text(kind, number, time, **fields):
    """The message text that the facts must give: common fields, then the fact's own."""
    stamp = time.strftime("%Y-%m-%d %H:%M:%S.") + f"{time.microsecond // 1000:03d}"
    common = {"event_id": f"{f.DS}:{kind}:{number}", "event_type": kind, "event_time": stamp, "business_date": f.DS}
    parts = [f'"{k}":"{v}"' for k, v in common.items()]
    parts += [f'"{k}":"{stamp}"' if v is None else f'"{k}":{v}' for k, v in fields.items()]
    return "{" + ",".join(parts) + "}"


def test_values_follow_the_contract(log):
    got = {r.event_id: r for r in log.collect()}
    expected = [
        _text("ORDER_CREATED", ORDER_ID, CREATED, order_id=ORDER_ID, user_id=5, shop_id=3, order_amount="120.50",
              create_time=None),
        _text("ORDER_DETAIL", LINE_ID, CREATED + LATER[LINE_ID], order_detail_id=LINE_ID, order_id=ORDER_ID, sku_id=6,
              sku_num=2, original_amount="130.00", final_amount="120.50", create_time=None),
        _text("PAYMENT_SUCCESS", PAID_ID, CREATED + LATER[PAID_ID], payment_id=PAID_ID, order_id=ORDER_ID, user_id=5,
              payment_status='"SUCCESS"', payment_amount="120.50", payment_time=None),
        _text("PAYMENT_FAILED", FAILED_ID, CREATED + LATER[FAILED_ID], payment_id=FAILED_ID, order_id=ORDER_ID, user_id=5,
              payment_status='"FAILED"', payment_amount="0.00", payment_time=None),
    ]
    assert sorted(r.value for r in got.values()) == sorted(expected)
    assert {r.key for r in got.values()} == {str(ORDER_ID)}


def test_send_order(log):
    kinds = [r.event_type for r in messages.in_send_order(log).collect()]
    assert kinds == ["ORDER_CREATED", "ORDER_DETAIL", "PAYMENT_FAILED", "PAYMENT_SUCCESS"]


def test_equal_times_are_ordered_by_type_then_id(spark):
    orders = spark.createDataFrame([f.order(2), f.order(1)], f.ORDER)
    details = spark.createDataFrame([f.detail(1, 1)], f.DETAIL)
    payments = spark.createDataFrame([f.payment(9, paid=f.NOON)], f.PAYMENT)
    log = messages.in_send_order(messages.message_log(orders, details, payments))
    assert [r.event_id.split(":", 1)[1] for r in log.collect()] == [
        "ORDER_CREATED:1", "ORDER_CREATED:2", "ORDER_DETAIL:1", "PAYMENT_SUCCESS:9"]


def test_parse_keeps_money_exact_and_accepts_seconds(spark):
    body = ('{{"event_id":"e{0}","event_type":"ORDER_CREATED","event_time":"{1}",'
            '"business_date":"20260825","order_id":1,"user_id":2,"shop_id":3,'
            '"order_amount":{2},"create_time":"{1}"}}')
    rows = [("ods_order_info", "1", body.format(1, "2026-08-25 09:15:20.123", "0.10")),
            ("ods_order_info", "1", body.format(2, "2026-08-25 09:15:20",
                                                "123456789012345678.91"))]
    df = spark.createDataFrame(rows, "topic string, key string, value string")
    got = {r.event_id: r for r in messages.parse(df, "ods_order_info").collect()}
    assert got["e1"].order_amount == Decimal("0.10")
    assert got["e2"].order_amount == Decimal("123456789012345678.91")
    assert got["e1"].event_time == dt.datetime(2026, 8, 25, 9, 15, 20, 123000)
    assert got["e2"].event_time == dt.datetime(2026, 8, 25, 9, 15, 20)


def test_contract_violations(spark, log):
    assert contract.violations(log).isEmpty()
    rows = [r.asDict() for r in log.collect()]
    by = {r["event_type"]: r for r in rows}
    bad = [
        {**by["ORDER_CREATED"], "topic": "ods_order_detail", "event_id": "a"},
        {**by["ORDER_CREATED"], "business_date": "20260826", "event_id": "b"},
        {**by["PAYMENT_SUCCESS"], "event_type": "PAYMENT_FAILED", "event_id": "c"},
        {**by["ORDER_DETAIL"], "event_id": "d",
         "event_time": by["ORDER_DETAIL"]["event_time"] + dt.timedelta(microseconds=1)},
        {**by["ORDER_CREATED"], "event_type": "OTHER", "event_id": "e"},
        by["ORDER_DETAIL"], by["ORDER_DETAIL"],
    ]
    got = {tuple(r) for r in contract.violations(spark.createDataFrame(bad, log.schema)).collect()}
    assert got == {("topic_type", "a"), ("business_date", "b"), ("status_type", "c"),
                   ("below_millis", "d"), ("topic_type", "e"),
                   ("repeated_id", by["ORDER_DETAIL"]["event_id"]),
                   *(("unreadable", x) for x in "abcde")}


def test_missing_messages(spark, log):
    facts = {"ods_order_info": spark.range(1), "ods_order_detail": spark.range(3),
             "ods_payment_info": spark.range(2)}
    got = contract.missing_messages(log, facts).collect()
    assert [tuple(r) for r in got] == [("ods_order_detail", 3, 1)]


def _arrivals(spark, pairs):
    rows = [(f.NOON + dt.timedelta(seconds=a), f.NOON + dt.timedelta(seconds=e)) for a, e in pairs]
    return spark.createDataFrame(rows, "arrival_time timestamp_ntz, event_time timestamp_ntz")


def test_disorder_bound_is_120_seconds(spark):
    assert contract.disorder(_arrivals(spark, [(0, 200), (1, 80), (2, 200)])).isEmpty()
    (row,) = contract.disorder(_arrivals(spark, [(0, 200), (1, 79), (1, 79)])).collect()
    assert (row.events, row.lag_seconds) == (2, 121)


def test_disorder_remembers_earlier_minutes_and_days(spark):
    pairs = [(0, 500), (70, 300), (90_000, 400), (90_001, 200), (200_000, 379)]
    got = contract.disorder(_arrivals(spark, pairs)).collect()
    assert sorted(int(r.lag_seconds) for r in got) == [121, 200, 300]


def test_running_latest_equals_brute_force(spark):
    import random

    rng = random.Random(3)
    pairs = [(rng.randrange(0, 300_000), rng.randrange(0, 300_000)) for _ in range(300)]
    got = {r.arrival_time: r.latest for r in
           contract.running_latest(_arrivals(spark, pairs)).collect()}
    for a, _ in pairs:
        newest = max(e for x, e in pairs if x <= a)
        assert got[f.NOON + dt.timedelta(seconds=a)] == f.NOON + dt.timedelta(seconds=newest)


# ---- stream ----------------------------------------------------------------

def _write(spark, path, rows):
    """One file of messages, so that one trigger takes it as one batch."""
    body = ('{{"event_id":"{0}","event_type":"{3}","event_time":"{1}",'
            '"business_date":"20260825","order_detail_id":{2},"order_id":1,"user_id":2,'
            '"shop_id":3,"sku_id":4,"sku_num":1,"order_amount":9.90,"original_amount":1.00,'
            '"final_amount":1.00,"create_time":"{1}"}}')
    data = [(topic, "1", body.format(e, t, d, kind)) for topic, kind, e, t, d in rows]
    spark.createDataFrame(data, "topic string, key string, value string").coalesce(1).write.mode(
        "append").json(str(path))


ORDER = ("ods_order_info", "ORDER_CREATED")


def _drain(spark, source, out, topic):
    stream = consume.deduplicated(consume.file_stream(spark, str(source), 1), topic)
    query = consume.start(stream, f"{out}/rows", f"{out}/checkpoint", once=True)
    query.awaitTermination(120)
    return query


def test_stream_drops_resends_and_counts_late_rows(spark, tmp_path):
    source = tmp_path / "in"
    late = consume.LateRows(spark, str(tmp_path / "late"))
    spark.streams.addListener(late)
    _write(spark, source, [(*ORDER, "a", "2026-08-25 10:00:00", 1),
                           (*ORDER, "a", "2026-08-25 10:00:00", 1),
                           (*ORDER, "b", "2026-08-25 10:00:30.500", 1)])
    _drain(spark, source, tmp_path, "ods_order_info")
    # Same events again and a new one: the checkpoint remembers the first run.
    _write(spark, source, [(*ORDER, "b", "2026-08-25 10:00:30.500", 1),
                           (*ORDER, "c", "2026-08-25 10:10:00", 1)])
    _drain(spark, source, tmp_path, "ods_order_info")
    # The watermark is now 10:08: d is late, e is not.
    _write(spark, source, [(*ORDER, "d", "2026-08-25 10:07:59", 1),
                           (*ORDER, "e", "2026-08-25 10:09:00", 1)])
    query = _drain(spark, source, tmp_path, "ods_order_info")
    rows = spark.read.parquet(f"{tmp_path}/rows").collect()
    assert sorted(r.event_id for r in rows) == ["a", "b", "c", "e"]
    assert {r.order_amount for r in rows} == {Decimal("9.90")}
    for _ in range(100):  # events reach listeners shortly after the query ends
        if late.of(query):
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.of(query) == 1


def test_stream_deduplicates_lines_by_business_key(spark, tmp_path):
    source = tmp_path / "in"
    line = ("ods_order_detail", "ORDER_DETAIL")
    _write(spark, source, [(*line, "a", "2026-08-25 10:00:00", 1),
                           (*line, "b", "2026-08-25 10:00:00", 1),
                           (*line, "c", "2026-08-25 10:00:00", 2),
                           (*ORDER, "z", "2026-08-25 10:00:00", 9)])
    _drain(spark, source, tmp_path, "ods_order_detail")
    rows = spark.read.parquet(f"{tmp_path}/rows").collect()
    assert sorted(r.order_detail_id for r in rows) == [1, 2]


def test_folder_sink_feeds_the_stream(spark, tmp_path, log):
    send_to_folder(log, str(tmp_path / "in"), str(tmp_path / "staged"))
    send_to_folder(log, str(tmp_path / "in"), str(tmp_path / "staged"))  # a resend
    _drain(spark, tmp_path / "in", tmp_path, "ods_payment_info")
    rows = spark.read.parquet(f"{tmp_path}/rows").collect()
    assert sorted(r.payment_id for r in rows) == [PAID_ID, FAILED_ID]


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_slices_lose_nothing_at_any_batch_size(spark, tmp_path, files_per_batch):
    """Orders of twelve minutes over many tasks: none is late, keys stay in order."""
    orders = spark.range(600).select(
        F.col("id").alias("order_id"), F.lit(1).cast("bigint").alias("user_id"),
        F.lit(3).cast("bigint").alias("shop_id"), F.lit("PAID").alias("order_status"),
        F.lit(1).cast("decimal(20,2)").alias("order_amount"),
        (F.lit(f.NOON).cast("timestamp") + F.make_dt_interval(secs=(F.col("id") * 7 % 720).cast("decimal(18,6)")))
        .cast("timestamp_ntz").alias("create_time"),
        F.lit(f.NOON).cast("timestamp_ntz").alias("update_time"), F.lit(f.DS).alias("ds"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        sent = send_to_folder(messages.order_messages(orders), str(tmp_path / "in"), str(tmp_path / "staged"))
    finally:
        spark.conf.set(key, "true")
    assert sent == 12
    stream = consume.file_stream(spark, str(tmp_path / "in"), files_per_batch)
    events = consume.deduplicated(stream, "ods_order_info")
    consume.start(events, f"{tmp_path}/rows", f"{tmp_path}/checkpoint", once=True).awaitTermination(200)
    assert spark.read.parquet(f"{tmp_path}/rows").select("order_id").distinct().count() == 600


@pytest.mark.parametrize("times", [[None, "2025-01-01 00:00:00", "1969-12-31 23:59:30"], [None, None]])
def test_messages_without_time_are_sent_last(spark, tmp_path, times):
    rows = [(f"e{i}", "order_created", t, "topic", f"k{i}", f"v{i}") for i, t in enumerate(times)]
    log = spark.createDataFrame(rows, "event_id string, event_type string, event_time string, topic string, key string, value string")
    sent = []
    count = send_slices(log, str(tmp_path / "staged"), lambda df: sent.append(sorted(r.value for r in df.collect())))
    assert count == len(sent) == len(set(times))
    assert sorted(v for part in sent for v in part) == sorted(r[5] for r in rows) and "v0" in sent[-1]


def test_missing_and_unreadable_values_break_their_rules(log):
    broken = log.where("topic = 'ods_payment_info'").limit(1)
    no_status = broken.withColumn("value", F.regexp_replace("value", '"payment_status":"[A-Z]+",?', ""))
    no_text = broken.withColumn("value", F.lit("not json"))
    no_time = broken.withColumns({"event_time": F.lit(None).cast("timestamp_ntz"),
                                  "business_date": F.lit(None).cast("string")})

    def rules(df):
        return {r.rule for r in contract.row_violations(df).collect()}

    assert rules(broken) == set()
    assert rules(no_status) == {"status_type"}
    assert rules(no_text) == {"unreadable", "status_type"}
    assert "business_date" in rules(no_time)


def test_lines_without_their_order_are_reported(log):
    arrived = log.withColumn("arrival_time", F.col("event_time"))
    assert contract.detail_before_order(arrived).isEmpty()
    lonely = contract.detail_before_order(arrived.where("topic <> 'ods_order_info'")).collect()
    assert [(r.key, r.order_arrival) for r in lonely] == [(str(ORDER_ID), None)]
