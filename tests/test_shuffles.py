"""How often the lines of a star folder are shuffled on their way to the layers."""

import datetime as dt

import pytest

from stratamart.queries import Layers

DAY = dt.datetime(1995, 1, 3)
TABLES = {
    "nation": ("n_nationkey int, n_name string", [(1, "N")]),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int",
                 [(k, f"S{k}", 1) for k in range(10)]),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_retailprice double",
             [(k, f"P{k}", "Brand#7", 9.0) for k in range(10)]),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
               [(k, k % 3, "F", None if k == 4 else DAY) for k in range(8)]),
    "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double,"
                 " l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
                 [(k, n, k, 2.0, 10.0, 0.05, None if (k, n) == (2, 1) else DAY)
                  for k in range(8) for n in (1, 2, 2)]),
    "events": ("event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, props string",
               [(k, k, dt.datetime(2024, 1, 5), "view", '{"k": 3}') for k in range(4)]),
}


@pytest.fixture()
def layers(spark, tmp_path):
    """Layers of a small folder, planned as for tables too large to be broadcast."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for name, (columns, rows) in TABLES.items():
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{name}.parquet")
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield Layers(spark, str(tmp_path))
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, table):
    return sum("Scan parquet" in line and f"{table}.parquet" in line for line in text.splitlines())


def test_trade_shuffles_lineitem_once_and_broadcasts_hot_orders(layers):
    text = plan(layers.trade())
    assert scans(text, "lineitem") == 1
    assert "BroadcastExchange" in text
    kept = {(r.order_id, r.order_detail_id, r.payment_amount) for r in layers.trade().collect()}
    assert {(o, d) for o, d, _ in kept} == {(k, k * 10 + n) for k in (0, 1, 3, 6) for n in (1, 2)}
    assert {float(p) for _, _, p in kept} == {19.0}


def test_both_views_of_the_lines_use_one_shuffle_by_line(layers):
    layers.spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    text = plan(layers.trade())
    by_line = [x for x in text.splitlines() if "Exchange hashpartitioning(order_detail_id" in x]
    assert len([x for x in by_line if "ReusedExchange" not in x]) == 1
    assert len([x for x in by_line if "ReusedExchange" in x]) == 2


def test_lines_hashed_by_id_are_the_lines(layers):
    src = layers.src
    assert src.ods_detail.exceptAll(src.ods_detail_by_id).isEmpty()
    assert src.ods_detail_by_id.exceptAll(src.ods_detail).isEmpty()
    assert src.ods_detail.columns == src.ods_detail_by_id.columns


def test_newest_orders_stay_where_their_sums_are(layers):
    orders = layers.src.ods_order
    assert plan(orders).count("Exchange hashpartitioning") == plan(
        orders.groupBy("order_id").count()).count("Exchange hashpartitioning")


def test_sales_of_a_sku_shuffle_narrow_lines_once_by_payer(layers):
    text = plan(layers.sku())
    assert "hashpartitioning(sku_id, user_id, order_id" not in "".join(
        c for c in text.replace("L,", ",") if c != "#" and not c.isdigit())


def test_lines_without_a_time_stay_in_the_source(layers):
    times = {(r.order_detail_id, r.create_time) for r in layers.src.order_detail.collect()}
    assert len(times) == 16 and {d for d, t in times if t is None} == {21, 41, 42}


def test_deduplicated_messages_are_shuffled_before_their_texts_are_written(layers):
    layers.spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    lines = plan(layers.deduplicated_log()).splitlines()
    texts = [i for i, x in enumerate(lines) if "AS value#" in x]
    dedup = [i for i, x in enumerate(lines) if "Exchange hashpartitioning(event_type" in x]
    # The plan is printed from the result down.
    assert texts and len(dedup) == 1 and max(texts) < dedup[0]


def test_deduplicated_messages_are_those_of_the_log(layers):
    once, log = layers.deduplicated_log(), layers.log().drop("arrival_time")
    assert once.columns == log.columns
    assert once.schema == log.schema
    messages = sorted(map(str, log.collect()))
    assert sorted(map(str, once.collect())) == messages
    assert layers.resent_log().count() > len(messages) > 0
