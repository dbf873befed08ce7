"""One test per rule of a valid trade line."""

import datetime as dt
from decimal import Decimal

import pytest

import facts as f
from stratamart.plans import dwd


def run(spark, orders=None, details=None, payments=None, ds=f.DS, rows_per_task=1_000_000):
    orders = [f.order()] if orders is None else orders
    details = [f.detail()] if details is None else details
    payments = [f.payment()] if payments is None else payments
    df = dwd.trade(
        spark.createDataFrame(orders, f.ORDER),
        spark.createDataFrame(details, f.DETAIL),
        spark.createDataFrame(payments, f.PAYMENT),
        spark.createDataFrame(f.SKUS, f.SKU),
        ds,
        rows_per_task,
    )
    return sorted(df.collect())


def test_valid_line_has_all_attributes(spark):
    (row,) = run(spark)
    assert row.asDict() == {
        "order_detail_id": 11, "order_id": 1, "payment_id": 21, "user_id": 7, "shop_id": 3,
        "shop_name": "north", "sku_id": 5, "sku_name": "cup", "category_id": 1,
        "category_name": "home", "sku_num": 1, "original_amount": Decimal("10.00"),
        "final_amount": Decimal("10.00"), "order_amount": Decimal("10.00"),
        "payment_amount": Decimal("10.00"), "create_time": f.NOON,
        "payment_time": f.NOON + dt.timedelta(minutes=1),
        "order_date": dt.date(2026, 8, 25), "payment_date": dt.date(2026, 8, 25),
    }


@pytest.mark.parametrize("status", ["CREATED", "CANCELLED"])
def test_other_status_is_dropped(spark, status):
    assert run(spark, orders=[f.order(status=status)]) == []


def test_no_or_failed_payment(spark):
    assert run(spark, payments=[f.payment(order_id=99)]) == []
    assert run(spark, payments=[f.payment(status="FAILED")]) == []


def test_two_successes_are_dropped_but_a_failed_try_is_not(spark):
    assert run(spark, payments=[f.payment(), f.payment(22)]) == []
    assert len(run(spark, payments=[f.payment(), f.payment(22, status="FAILED")])) == 1


def test_zero_success_does_not_count_as_second(spark):
    assert len(run(spark, payments=[f.payment(), f.payment(22, amount=0)])) == 1


def test_wrong_payer(spark):
    assert run(spark, payments=[f.payment(user=8)]) == []


def test_paid_before_created(spark):
    early = f.NOON - dt.timedelta(milliseconds=1)
    assert run(spark, payments=[f.payment(paid=early)]) == []
    assert len(run(spark, payments=[f.payment(paid=f.NOON)])) == 1


def test_amounts_must_agree(spark):
    assert run(spark, details=[f.detail(final="9.99")]) == []
    assert run(spark, payments=[f.payment(amount="9.99")]) == []
    two = [f.detail(11, final="4.50"), f.detail(12, sku=6, final="5.50")]
    assert [r.order_detail_id for r in run(spark, details=two)] == [11, 12]


def test_sku_of_another_shop_loses_its_line_only(spark):
    two = [f.detail(11, final=4), f.detail(12, sku=8, final=6)]
    assert [r.order_detail_id for r in run(spark, details=two)] == [11]
    assert run(spark, details=[f.detail(sku=404)]) == []


def test_rank_first_then_filter(spark):
    later = f.NOON + dt.timedelta(hours=1)
    cancelled = f.order(status="CANCELLED", updated=later)
    assert run(spark, orders=[f.order(), cancelled]) == []
    failed = f.payment(status="FAILED", paid=later)
    assert run(spark, payments=[f.payment(), failed]) == []


def test_newest_version_wins(spark):
    old_line = f.detail(final=3, created=f.NOON - dt.timedelta(seconds=1))
    (row,) = run(spark, details=[old_line, f.detail(), f.detail()])
    assert row.final_amount == 10


def test_ds_breaks_equal_times_and_later_days_are_ignored(spark):
    yesterday = f.order(status="CANCELLED", ds="20260824")
    assert len(run(spark, orders=[yesterday, f.order()])) == 1
    tomorrow = f.order(status="CANCELLED", ds="20260826",
                       updated=f.NOON + dt.timedelta(days=1))
    assert len(run(spark, orders=[f.order(), tomorrow])) == 1
    assert run(spark, orders=[f.order(), tomorrow], ds="20260826") == []


def test_orders_with_many_lines_are_salted_and_stay_whole(spark):
    lines = [f.detail(100 + i, final=1) for i in range(40)]
    lines += [f.detail(500, order_id=2)]
    orders = [f.order(amount=40), f.order(2)]
    payments = [f.payment(amount=40), f.payment(22, order_id=2)]
    plain = run(spark, orders, lines, payments)
    salted = run(spark, orders, lines, payments, rows_per_task=3)
    assert len(plain) == 41 and salted == plain


def test_cleaning_summary_counts_candidates_before_dedup(spark):
    later = f.NOON + dt.timedelta(hours=1)
    payments = [
        f.payment(), f.payment(status="FAILED", paid=later),  # hidden by its newer version
        f.payment(23, order_id=2, amount=0),
        f.payment(24, order_id=3, status="FAILED"),
        f.payment(25, order_id=4, ds="20260826"),
    ]
    df = spark.createDataFrame(payments, f.PAYMENT)
    lines = spark.createDataFrame([(2,), (2,)], "order_id bigint")
    assert tuple(dwd.cleaning_summary(df, lines, f.DS).first()) == (2, 1, 1)
    assert tuple(dwd.cleaning_summary(df, lines.limit(0), f.DS).first()) == (2, 0, 2)
