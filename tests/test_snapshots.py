"""Behavior and rating snapshots."""

import datetime as dt

import pytest

import facts as f
from stratamart.plans import dwd

LATER = f.NOON + dt.timedelta(seconds=1)


def behavior(spark, events, ds=f.DS):
    df = dwd.behavior(
        spark.createDataFrame(events, f.BEHAVIOR), spark.createDataFrame(f.SKUS, f.SKU), ds
    )
    return sorted(df.collect())


def rating(spark, ratings, ds=f.DS):
    trade = spark.createDataFrame(
        [(1, 3, "north"), (1, 3, "north"), (2, 4, "south")],
        "order_id bigint, shop_id bigint, shop_name string",
    )
    return sorted(dwd.rating(spark.createDataFrame(ratings, f.RATING), trade, ds).collect())


def test_event_gets_sku_attributes(spark):
    (row,) = behavior(spark, [f.event()])
    assert (row.sku_name, row.shop_name, row.event_date) == ("cup", "north", dt.date(2026, 8, 25))


@pytest.mark.parametrize("column", ["event_id", "user", "sku", "time", "session"])
def test_incomplete_events_are_dropped(spark, column):
    assert behavior(spark, [f.event(**{column: None})]) == []


def test_unknown_type_or_sku(spark):
    assert behavior(spark, [f.event(kind="error"), f.event(32, sku=404)]) == []


def test_invalid_newest_event_does_not_hide_an_older_one(spark):
    rows = behavior(spark, [f.event(), f.event(kind="error", time=LATER)])
    assert [r.event_type for r in rows] == ["view"]
    rows = behavior(spark, [f.event(), f.event(kind="cart", time=LATER)])
    assert [r.event_type for r in rows] == ["cart"]


def test_event_dated_after_the_cutoff_inside_an_allowed_day(spark):
    tomorrow = f.NOON + dt.timedelta(days=1)
    assert behavior(spark, [f.event(time=tomorrow)]) == []
    assert len(behavior(spark, [f.event(time=tomorrow)], ds="20260826")) == 1


@pytest.mark.parametrize(
    "score, level", [(0, None), (1, "bad"), (2, "bad"), (3, "mid"), (4, "good"), (5, "good"),
                     (6, None)]
)
def test_score_levels_and_range(spark, score, level):
    assert [r.score_level for r in rating(spark, [f.rating(score=score)])] == (
        [level] if level else []
    )


def test_last_rating_of_an_order_wins(spark):
    rows = rating(spark, [f.rating(41, score=1), f.rating(40, score=5, time=LATER)])
    assert [(r.rating_id, r.shop_score) for r in rows] == [(40, 5)]
    tie = rating(spark, [f.rating(41, score=1), f.rating(42, score=4)])
    assert [r.rating_id for r in tie] == [42]
    invalid_newest = rating(spark, [f.rating(41, score=1), f.rating(42, score=9, time=LATER)])
    assert [r.rating_id for r in invalid_newest] == [41]


def test_rating_needs_paid_trade_in_the_same_shop(spark):
    assert rating(spark, [f.rating(order_id=99)]) == []
    assert rating(spark, [f.rating(shop=4)]) == []
    assert rating(spark, [f.rating(shop=None)]) == []
