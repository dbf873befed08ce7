"""Tiny hand-written facts around one valid order."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

DS = "20260825"

ORDER = (
    "order_id bigint, user_id bigint, shop_id bigint, order_status string, "
    "order_amount decimal(20,2), create_time timestamp_ntz, update_time timestamp_ntz, ds string"
)
DETAIL = (
    "order_detail_id bigint, order_id bigint, sku_id bigint, sku_num int, "
    "original_amount decimal(20,2), final_amount decimal(20,2), create_time timestamp_ntz, "
    "ds string"
)
PAYMENT = (
    "payment_id bigint, order_id bigint, user_id bigint, payment_type string, "
    "payment_status string, payment_amount decimal(20,2), payment_time timestamp_ntz, "
    "create_time timestamp_ntz, ds string"
)
BEHAVIOR = (
    "event_id bigint, session_id string, user_id bigint, sku_id bigint, event_type string, "
    "event_time timestamp_ntz, ds string"
)
RATING = (
    "rating_id bigint, order_id bigint, shop_id bigint, shop_score tinyint, "
    "rating_time timestamp_ntz, ds string"
)
SKU = (
    "sku_id bigint, sku_name string, category_id bigint, category_name string, shop_id bigint, "
    "shop_name string, province_name string, price decimal(20,2), status tinyint"
)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


NOON = at("2026-08-25 12:00:00")


def money(value) -> Decimal:
    return Decimal(str(value)).quantize(Decimal("0.01"))


def order(order_id=1, user=7, shop=3, status="PAID", amount=10, created=NOON,
          updated=None, ds=DS):
    return (order_id, user, shop, status, money(amount), created, updated or created, ds)


def detail(detail_id=11, order_id=1, sku=5, num=1, final=10, created=NOON, ds=DS,
           original=None):
    original = final if original is None else original
    return (detail_id, order_id, sku, num, money(original), money(final), created, ds)


def payment(payment_id=21, order_id=1, user=7, status="SUCCESS", amount=10, paid=None, ds=DS):
    paid = paid or NOON + dt.timedelta(minutes=1)
    return (payment_id, order_id, user, "CARD", status, money(amount), paid, paid, ds)


def event(event_id=31, user=7, sku=5, kind="view", time=NOON, session="s", ds=DS):
    return (event_id, session, user, sku, kind, time, ds)


def rating(rating_id=41, order_id=1, shop=3, score=5, time=NOON, ds=DS):
    return (rating_id, order_id, shop, score, time, ds)


SKUS = [
    (5, "cup", 1, "home", 3, "north", "x", money(10), 1),
    (6, "pen", 2, "office", 3, "north", "x", money(5), 0),
    (8, "hat", 3, "wear", 4, "south", "y", money(7), 1),
]
