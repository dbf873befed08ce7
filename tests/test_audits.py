import datetime as dt
import random

import facts as f
from stratamart.operators import audits
from stratamart.operators.compare import reconcile, set_difference
from stratamart.operators.dedup import latest_by, only_member, repeated_keys


def test_missing_parent_keeps_null_keys(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    assert sorted(r.id for r in audits.missing_parent(child, parent, "k").collect()) == [2, 3]


def test_rating_without_success(spark):
    ratings = spark.createDataFrame(
        [(1, 1, 3), (2, 2, 3), (3, 1, 4), (4, 9, 3)],
        "rating_id bigint, order_id bigint, shop_id bigint")
    orders = spark.createDataFrame([f.order(), f.order(2)], f.ORDER)
    payments = spark.createDataFrame(
        [f.payment(), f.payment(22), f.payment(23, order_id=2, amount=0)], f.PAYMENT)
    got = audits.rating_without_success(ratings, orders, payments)
    assert sorted(r.rating_id for r in got.collect()) == [2, 3, 4]


def test_status_disagrees(spark):
    orders = spark.createDataFrame(
        [f.order(1), f.order(2), f.order(3, status="CREATED"), f.order(4, status="CANCELLED")],
        f.ORDER)
    payments = spark.createDataFrame([f.payment(), f.payment(22, order_id=4)], f.PAYMENT)
    got = audits.status_disagrees(orders, payments).collect()
    assert sorted((r.order_id, r.success_count) for r in got) == [(2, 0), (4, 1)]


def test_bursts_equal_brute_force(spark):
    """Random rows around bucket edges, with many equal times and one busy user."""
    rng = random.Random(11)
    start = dt.datetime(2026, 8, 25, 0, 0)
    rows = [
        (0 if rng.random() < 0.4 else rng.randrange(4),
         start + dt.timedelta(milliseconds=rng.randrange(0, 600_000) // 500 * 500))
        for _ in range(400)
    ]
    got = audits.bursts(
        spark.createDataFrame(rows, "user_id int, t timestamp_ntz"), "user_id", "t", 60, 6
    ).collect()
    expected = set()
    for user, t in set(rows):
        n = sum(u == user and 0 <= (t - x).total_seconds() <= 60 for u, x in rows)
        if n >= 6:
            expected.add((user, t, n))
    assert {tuple(r) for r in got} == expected and len(got) == len(expected) > 20


def test_burst_edge_is_inclusive(spark):
    def at(ms):
        return (1, f.NOON + dt.timedelta(milliseconds=ms))

    def run(rows):
        df = spark.createDataFrame(rows, "user_id int, payment_time timestamp_ntz")
        return audits.failed_payment_bursts(df).count()

    assert run([at(0), at(1000), at(180_000)]) == 1
    assert run([at(0), at(1000), at(180_001)]) == 0


def test_price_and_names(spark):
    skus = spark.createDataFrame(
        [(1, 1, 5, "item-1"), (2, 1, 50, "cup model"), (3, 7, 5, "cup")],
        "sku_id int, category_id int, price int, sku_name string")
    ranges = spark.createDataFrame([(1, 1, 10)], "category_id int, price_low int, price_high int")
    got = audits.price_outside_category(skus, ranges).collect()
    assert sorted(r.sku_id for r in got) == [2, 3]
    names = audits.placeholder_names(skus, "sku_id", "sku_name", "item-", "model").collect()
    assert sorted(r.sku_id for r in names) == [1, 3]


def test_set_difference(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "v int")
    assert sorted(map(tuple, set_difference(a, b).collect())) == [(1, "missing"), (3, "unexpected")]
    assert set_difference(a, a).isEmpty()


def test_reconcile(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "ds string")
    b = spark.createDataFrame([("x",), ("x",), ("z",)], "ds string")
    got = sorted(map(tuple, reconcile(a, b, "ds").collect()))
    assert got == [("x", 2, 2, True), ("y", 1, 0, False), ("z", 0, 1, False)]


def test_dedup_operators(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, "b"), (1, None, "c"), (2, None, "d"), (None, 1, "e"), (None, 2, "f")],
        "k int, v int, s string")
    got = {(r.k, r.s) for r in latest_by(df, ["k"], ["v"], ["s"]).collect()}
    assert got == {(1, "b"), (2, "d"), (None, "f")}
    assert [tuple(r) for r in only_member(df, "k", ["s"]).collect()] == [(2, "d")]
    assert {tuple(r) for r in repeated_keys(df, "k").collect()} == {(1, 3), (None, 2)}
