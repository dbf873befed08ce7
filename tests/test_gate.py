"""The gate on source facts: every rule, known anomalies, the jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import facts as f
from stratamart import jobs
from stratamart.errors import DataQualityError
from stratamart.plans import audit
from stratamart.plans.ods import INGESTS
from stratamart.sources import tables

DAY = f.NOON
NEXT = DAY + dt.timedelta(days=1)
SHAPES = {"order_info": f.ORDER, "order_detail": f.DETAIL, "payment_info": f.PAYMENT,
          "user_behavior": f.BEHAVIOR, "rating_info": f.RATING}
CLEAN = {
    "order_info": [f.order(1), f.order(2, status="CREATED"), f.order(3, status="CANCELLED")],
    "order_detail": [f.detail(11, 1), f.detail(12, 2), f.detail(13, 3, final=4), f.detail(14, 3, final=6)],
    "payment_info": [f.payment(21, 1), f.payment(22, 1, status="FAILED", amount=0)],
    "user_behavior": [f.event(31), f.event(32, kind="cart", sku=6)],
    "rating_info": [f.rating(41, 1)],
}


def line(row, **values):
    names = [part.split()[0] for part in f.DETAIL.split(", ")]
    return tuple(values.get(n, v) for n, v in zip(names, row))


def paying(row, **values):
    names = [part.split()[0] for part in f.PAYMENT.split(", ")]
    return tuple(values.get(n, v) for n, v in zip(names, row))


# rule -> rows added to facts; ids of a rule are its own, so that no rule hides another.
BROKEN = {
    "order_info": {
        "required_is_null": [(101, None, 3, "CREATED", f.money(0), DAY, DAY, f.DS)],
        "unknown_status": [f.order(102, status="LOST")],
        "bad_amount": [f.order(103, status="CREATED", amount=-1)],
        "updated_before_created": [f.order(104, status="CREATED", updated=DAY - dt.timedelta(seconds=1))],
        "outside_day": [f.order(105, status="CREATED", updated=NEXT)],
        "shop_missing": [f.order(106, status="CREATED", shop=99)],
        "status_disagrees": [f.order(107)],
        "repeated_keys": [f.order(108, status="CREATED")] * 2,
    },
    "order_detail": {
        "required_is_null": [line(f.detail(201, 2), sku_num=None)],
        "bad_quantity": [f.detail(202, 2, num=0)],
        "bad_amount": [f.detail(203, 2, final=-1, original=0)],
        "final_above_original": [f.detail(204, 2, final=3, original=2)],
        "outside_day": [f.detail(205, 2, created=NEXT)],
        "order_missing": [f.detail(206, 999)],
        "sku_missing": [f.detail(207, 2, sku=999)],
        "other_shop": [f.detail(208, 2, sku=8)],
        "repeated_keys": [f.detail(209, 2)] * 2,
    },
    "payment_info": {
        "required_is_null": [paying(f.payment(301, 2, status="FAILED"), payment_type=None)],
        "unknown_type": [paying(f.payment(302, 2, status="FAILED"), payment_type="CASH")],
        "unknown_status": [f.payment(303, 2, status="OPEN")],
        "bad_amount": [f.payment(304, 2, status="FAILED", amount=-1)],
        "recorded_before_paid": [paying(f.payment(305, 2, status="FAILED"), create_time=DAY)],
        "outside_day": [paying(f.payment(306, 2, status="FAILED"), payment_time=NEXT, create_time=NEXT)],
        "order_missing": [f.payment(307, 998, status="FAILED")],
        "other_payer": [f.payment(308, 2, user=8, status="FAILED")],
        "other_amount": [f.payment(309, 1, amount=11)],
        "several_successes": [f.payment(310, 997), f.payment(311, 997)],
        "repeated_keys": [f.payment(312, 2, status="FAILED")] * 2,
    },
    "user_behavior": {
        "required_is_null": [f.event(401, session=None)],
        "unknown_type": [f.event(402, kind="click")],
        "outside_day": [f.event(403, time=NEXT)],
        "sku_missing": [f.event(404, sku=999)],
        "repeated_keys": [f.event(405)] * 2,
    },
    "rating_info": {
        "required_is_null": [f.rating(501, 1, score=None)],
        "bad_score": [f.rating(502, 1, score=6)],
        "outside_day": [f.rating(503, 1, time=NEXT)],
        "order_missing": [f.rating(504, 996)],
        "other_shop": [f.rating(505, 1, shop=4)],
        "no_success": [f.rating(506, 2)],
        "repeated_keys": [f.rating(507, 1)] * 2,
    },
}
KNOWN = {
    "line_sum_differs": {"order_detail": [f.detail(601, 1, final=1)]},
    "paid_before_created": {
        "order_info": [f.order(602)],
        "order_detail": [f.detail(603, 602)],
        "payment_info": [f.payment(604, 602, paid=DAY - dt.timedelta(seconds=1))],
    },
}


def frames(spark, added=None):
    rows = {fact: CLEAN[fact] + (added or {}).get(fact, []) for fact in SHAPES}
    return {fact: spark.createDataFrame(rows[fact], shape) for fact, shape in SHAPES.items()}


def dimensions(spark):
    shop = spark.createDataFrame([(3,), (4,)], "shop_id bigint")
    return {"shop_info": shop, "sku_info": spark.createDataFrame(f.SKUS, f.SKU)}


def counts(spark, added=None):
    days = {fact: F.lit(f.DS) for fact in SHAPES}
    rows = audit.report(frames(spark, added) | dimensions(spark), days).collect()
    assert len({(r.fact, r.rule) for r in rows}) == len(rows)
    return {(r.fact, r.rule): r.rows for r in rows}


@pytest.fixture(scope="module")
def clean(spark):
    return counts(spark)


def test_a_clean_day_breaks_no_rule(spark, clean):
    assert set(clean.values()) == {0} and len(clean) == 42
    audit.gate(clean, frames(spark))


def test_every_rule_has_a_breaker(clean):
    named = {(fact, rule) for fact, rules in BROKEN.items() for rule in rules}
    assert named | set(audit.KNOWN) == set(clean)


@pytest.fixture(scope="module")
def broken(spark):
    return counts(spark, {fact: [r for rows in rules.values() for r in rows] for fact, rules in BROKEN.items()})


@pytest.mark.parametrize(("fact", "rule"), [(a, b) for a, rules in BROKEN.items() for b in rules])
def test_one_broken_rule_stops_the_day(clean, broken, fact, rule):
    assert broken[fact, rule] >= 1
    with pytest.raises(DataQualityError, match=f"^source facts: {fact}.{rule}={broken[fact, rule]}$"):
        audit.gate(clean | {(fact, rule): broken[fact, rule]}, {})


def test_a_breaker_breaks_little_else(spark):
    """Breakers of payments alone: what they add to other facts follows from them."""
    found = counts(spark, {"payment_info": BROKEN["payment_info"]["other_amount"]})
    assert {k for k, n in found.items() if n} == {
        ("payment_info", "other_amount"), ("payment_info", "several_successes"), ("order_info", "status_disagrees")}


def test_known_anomalies_must_be_the_announced_ones(spark):
    added = {}
    for rows in KNOWN.values():
        for fact, extra in rows.items():
            added[fact] = added.get(fact, []) + extra
    found, facts = counts(spark, added), frames(spark, added)
    assert {k for k, n in found.items() if n} == set(audit.KNOWN)
    audit.gate(found, facts)

    def orders(*ids):
        return spark.createDataFrame([(i,) for i in ids], "order_id bigint")

    line_sum, early = audit.KNOWN
    audit.gate(found, facts, {line_sum: orders(1), early: orders(602)})
    with pytest.raises(DataQualityError, match="line_sum_differs: 1 missing.*paid_before_created: 1 unexpected"):
        audit.gate(found, facts, {line_sum: orders(1, 2), early: orders()})


@pytest.fixture()
def warehouse(spark, tmp_path):
    tables.create_all(spark, str(tmp_path))
    yield
    for table in tables.TABLES:
        spark.sql(f"DROP TABLE {table}")


def test_jobs_refuse_a_broken_day_and_keep_the_old_one(spark, warehouse):
    shops = "select cast(id as bigint), 'n', 'p', timestamp'2020-01-01 00:00:00', cast(1 as tinyint) from range(3, 5)"
    spark.sql(f"insert into cdm.dim_shop_df {shops}")
    spark.createDataFrame(f.SKUS, f.SKU).write.insertInto("cdm.dim_sku_df")
    good, bad = frames(spark), frames(spark, {"rating_info": BROKEN["rating_info"]["bad_score"]})
    assert jobs.load_day(spark, good.__getitem__, f.DS, audited=True)["ods.ods_order_detail_di"] == 4
    before = {i.target: tables.current_path(spark, i.target, f.DS) for i in INGESTS}
    with pytest.raises(DataQualityError, match="rating_info.bad_score=1"):
        jobs.load_day(spark, bad.__getitem__, f.DS, audited=True)
    assert {i.target: tables.current_path(spark, i.target, f.DS) for i in INGESTS} == before
    assert set(jobs.audit_day(spark, f.DS).values()) == {0}
    jobs.load_day(spark, bad.__getitem__, f.DS)  # not audited, as before
    with pytest.raises(DataQualityError, match="rating_info.bad_score=1"):
        jobs.audit_day(spark, f.DS)
