"""Period operators and aggregates against brute force in Python."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import facts as f
from stratamart.operators.periods import PERIODS, Periods
from stratamart.plans import ads, dws

DAY = dt.date(2026, 8, 25)
BACK = {"1d": 0, "7d": 6, "30d": 29, "all": 10_000}


def inside(day, period):
    return DAY - dt.timedelta(days=BACK[period]) <= day <= DAY


def test_period_table(spark):
    rows = {r.stat_period: r.start_date for r in Periods(f.DS).table(spark).collect()}
    assert rows == {"1d": DAY, "7d": dt.date(2026, 8, 19), "30d": dt.date(2026, 7, 27),
                    "all": dt.date(1900, 1, 1)}


def test_fan_out_edges(spark):
    days = [(DAY - dt.timedelta(days=n),) for n in (-1, 0, 6, 7, 29, 30)]
    df = spark.createDataFrame([*days, (None,)], "day date")
    got = Periods(f.DS).fan_out(df, "day").groupBy("stat_period").count().collect()
    assert {r[0]: r[1] for r in got} == {"1d": 1, "7d": 2, "30d": 4, "all": 5}


def test_fill_keeps_empty_periods(spark):
    df = spark.createDataFrame([("7d", 3)], "stat_period string, n bigint")
    got = {r[0]: r[1] for r in Periods(f.DS).fill(df, {"n": "bigint"}).collect()}
    assert got == {"1d": 0, "7d": 3, "30d": 0, "all": 0}


@pytest.fixture(scope="module")
def random_facts():
    rng = random.Random(4)
    days = [DAY - dt.timedelta(days=n) for n in (0, 1, 5, 6, 7, 20, 29, 30, 400)]
    behavior = [
        (i, rng.randrange(6), rng.choice(["view", "favorite", "cart"]), rng.randrange(4),
         rng.choice(days))
        for i in range(300)
    ]
    trade = []
    for order in range(80):
        user, day = rng.randrange(9), rng.choice(days)
        for line in range(rng.randrange(1, 4)):
            trade.append((order * 10 + line, order, user, rng.randrange(2, 7),
                          rng.randrange(1, 4), Decimal(rng.randrange(1, 900)) / 100,
                          Decimal(order) + 1, day))
    orders = [(o, dt.datetime.combine(rng.choice(days), dt.time(3)), 0) for o in range(50)]
    return behavior, trade, orders


def frames(spark, random_facts):
    behavior, trade, orders = random_facts
    names = [F.concat(F.lit("n"), F.col("sku_id")).alias("sku_name"),
             F.col("sku_id").alias("category_id"),
             F.concat(F.lit("c"), F.col("sku_id")).alias("category_name"),
             (F.col("sku_id") % 2).alias("shop_id"),
             F.concat(F.lit("s"), F.col("sku_id") % 2).alias("shop_name")]
    b = spark.createDataFrame(
        behavior, "event_id bigint, user_id bigint, event_type string, sku_id bigint, event_date date"
    ).select("*", *names)
    t = spark.createDataFrame(
        trade, "order_detail_id bigint, order_id bigint, user_id bigint, sku_id bigint, "
        "sku_num int, final_amount decimal(20,2), payment_amount decimal(20,2), payment_date date"
    ).select("*", *names)
    o = spark.createDataFrame(orders, "order_id bigint, create_time timestamp_ntz, k int").select(
        "order_id", "create_time", F.col("create_time").alias("update_time"),
        F.lit(f.DS).alias("ds"),
    )
    return b, t, o


def test_site_metrics(spark, random_facts):
    behavior, trade, orders = random_facts
    b, t, o = frames(spark, random_facts)
    got = {r.stat_period: r for r in dws.site_stats(b, t, o, f.DS).collect()}
    assert set(got) == set(PERIODS)
    for p, row in got.items():
        seen = [x for x in behavior if inside(x[4], p)]
        lines = [x for x in trade if inside(x[7], p)]
        assert row.pv_count == len(seen)
        assert row.uv_count == len({x[1] for x in seen if x[2] == "view"})
        assert row.favorite_count == sum(x[2] == "favorite" for x in seen)
        assert row.cart_count == sum(x[2] == "cart" for x in seen)
        assert row.order_count == sum(inside(x[1].date(), p) for x in orders)
        assert row.paid_order_count == len({x[1] for x in lines})
        assert row.paid_user_count == len({x[2] for x in lines})
        assert row.paid_sku_num == sum(x[4] for x in lines)
        assert row.gmv == sum({x[1]: x[6] for x in lines}.values())


def test_site_of_empty_inputs_is_all_zero(spark, random_facts):
    b, t, o = (df.limit(0) for df in frames(spark, random_facts))
    rows = dws.site_stats(b, t, o, f.DS).collect()
    assert {r.stat_period for r in rows} == set(PERIODS)
    assert all(v == 0 for r in rows for v in r[1:])
    zero = ads.overview(dws.site_stats(b, t, o, f.DS)).first()
    assert (zero.avg_order_amount, zero.view_to_pay_rate) == (0, 0)


def test_sku_metrics(spark, random_facts):
    behavior, trade, _ = random_facts
    b, t, _ = frames(spark, random_facts)
    got = {(r.stat_period, r.sku_id): r for r in dws.sku_trade(b, t, f.DS).collect()}
    expected = set()
    for p in PERIODS:
        for sku in range(8):
            seen = [x for x in behavior if x[3] == sku and inside(x[4], p)]
            lines = [x for x in trade if x[3] == sku and inside(x[7], p)]
            if not seen and not lines:
                continue
            expected.add((p, sku))
            row = got[(p, sku)]
            views = [x for x in seen if x[2] == "view"]
            assert row.sku_name == f"n{sku}" and row.shop_name == f"s{sku % 2}"
            assert row.pv_count == len(views)
            assert row.visitor_count == len({x[1] for x in views})
            assert row.cart_user_count == len({x[1] for x in seen if x[2] == "cart"})
            assert row.paid_order_count == len({x[1] for x in lines})
            assert row.paid_user_count == len({x[2] for x in lines})
            assert row.paid_sku_num == sum(x[4] for x in lines)
            assert row.gmv == sum(x[5] for x in lines)
    assert set(got) == expected


def test_shop_rating_and_its_results(spark):
    days = [0, 0, 6, 7, 29, 30, 500]
    rows = [(1, "north", 1 + i % 5, ["bad", "bad", "mid", "good", "good"][i % 5],
             DAY - dt.timedelta(days=n)) for i, n in enumerate(days)]
    df = spark.createDataFrame(
        rows, "shop_id bigint, shop_name string, shop_score tinyint, score_level string, "
        "rating_date date")
    got = {r.stat_period: r for r in dws.shop_rating(df, f.DS).collect()}
    for p in PERIODS:
        hit = [r for r in rows if inside(r[4], p)]
        assert got[p].rating_count == len(hit)
        assert got[p].score_sum == sum(r[2] for r in hit)
        assert got[p].good_count + got[p].mid_count + got[p].bad_count == len(hit)
    old = df.where(F.col("rating_date") < F.lit(dt.date(2026, 7, 1)))
    assert [r.stat_period for r in dws.shop_rating(old, f.DS).collect()] == ["all"]


def test_ads_rating_of_six_without_good_is_zero_not_negative(spark):
    df = spark.createDataFrame(
        [("all", 1, "n", 6, 6, 0, 0, 6), ("all", 2, "n", 0, 0, 0, 0, 0)],
        "stat_period string, shop_id bigint, shop_name string, rating_count bigint, "
        "score_sum bigint, good_count bigint, mid_count bigint, bad_count bigint")
    (row,) = ads.shop_rating(df).collect()
    assert (row.shop_id, row.wilson_good_rate, row.risk_flag) == (1, 0, False)
    assert (row.avg_score, row.bad_rate) == (1, 1)


def _sku_rows(spark, rows):
    return spark.createDataFrame(
        [(p, s, "n", 1, "c", 1, "s", 0, 0, 0, o, 0, n, Decimal(g)) for p, s, g, n, o in rows],
        "stat_period string, sku_id bigint, sku_name string, category_id bigint, "
        "category_name string, shop_id bigint, shop_name string, pv_count bigint, "
        "visitor_count bigint, cart_user_count bigint, paid_order_count bigint, "
        "paid_user_count bigint, paid_sku_num bigint, gmv decimal(20,2)")


def test_topn_ties_short_groups_and_unsold(spark):
    rows = [("1d", s, 5, 0, 0) for s in (9, 3, 7)] + [("7d", s, s, 100 - s, 1) for s in range(15)]
    top = ads.sku_topn(_sku_rows(spark, rows)).collect()
    by = {}
    for r in sorted(top, key=lambda r: r.rank_no):
        by.setdefault((r.stat_period, r.rank_type), []).append(r.sku_id)
    assert by[("1d", "gmv")] == [3, 7, 9] and by[("1d", "paid_sku_num")] == [3, 7, 9]
    assert by[("7d", "gmv")] == list(range(14, 4, -1))
    assert by[("7d", "paid_sku_num")] == list(range(10))
    assert by[("7d", "paid_order_count")] == list(range(10))
