"""The gate on a day's source facts: rule counts, one report, a verdict.

Rules of single rows are counted while the rows are staged (``row_measures``,
taken by ``observe``), so they cost no pass. Rules between facts take one pass
per fact: its parents and per-order sums are joined to it once, and all of its
rules are counted on that join. Joins are plain, so AQE may broadcast a
dimension or split a hot order; sums per order combine before the shuffle.

A business day is closed: an order's lines, payments and rating are of its day,
so the facts are audited against each other.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DataQualityError
from ..functions.money import money
from ..functions.temporal import ds_of
from ..operators.compare import set_difference
from ..operators.quality import any_null
from .contracts import SOURCE
from .ods import INGESTS

#: Times of a fact that must lie on its day.
TIMES = {
    "order_info": ("create_time", "update_time"),
    "order_detail": ("create_time",),
    "payment_info": ("payment_time", "create_time"),
    "user_behavior": ("event_time",),
    "rating_info": ("rating_time",),
}
COLUMNS = {i.source: tuple(i.columns) for i in INGESTS}
#: Orders that the shops' systems are known to produce; later layers leave them out.
KNOWN = {
    ("order_info", "line_sum_differs"): "order_id",
    ("payment_info", "paid_before_created"): "order_id",
}


def row_rules(fact: str, day: Column) -> dict[str, Column]:
    """Conditions that are true for a bad row of one fact."""
    wrong_day = reduce(lambda a, b: a | b, [ds_of(F.col(t)) != day for t in TIMES[fact]])
    return {
        "required_is_null": any_null(COLUMNS[fact]),
        **SOURCE[fact].row_rules(),
        "outside_day": wrong_day,
    }


def row_measures(fact: str, day: Column) -> list[Column]:
    return [F.count_if(bad).alias(rule) for rule, bad in row_rules(fact, day).items()]


def _one_row(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(bad).alias(rule) for rule, bad in rules.items()])


def _repeated(df: DataFrame, fact: str) -> DataFrame:
    per_key = df.groupBy(*SOURCE[fact].key).agg(F.count("*").alias("_n"))
    return _one_row(per_key, {"repeated_keys": F.col("_n") > 1})


def _known(df: DataFrame, key: str, mark: str) -> DataFrame:
    return df.select(key, F.lit(True).alias(mark))


def _successes(payments: DataFrame) -> DataFrame:
    success = F.col("payment_status") == "SUCCESS"
    return payments.groupBy("order_id").agg(
        F.count_if(success).alias("successes"),
        F.count_if(success & (F.col("payment_amount") > 0)).alias("paid"),
    )


def with_line_sums(orders: DataFrame, details: DataFrame) -> DataFrame:
    sums = details.groupBy("order_id").agg(money(F.sum("final_amount")).alias("line_sum"))
    return orders.join(sums, "order_id", "left")


def with_orders(payments: DataFrame, orders: DataFrame) -> DataFrame:
    owner = orders.select("order_id", F.col("user_id").alias("buyer_id"), "order_amount",
                          F.col("create_time").alias("ordered_at"), F.lit(True).alias("has_order"))
    return payments.join(owner, "order_id", "left")


LINE_SUM_DIFFERS = "line_sum <> order_amount"
PAID_BEFORE_CREATED = "payment_status = 'SUCCESS' and payment_time < ordered_at"


def cross_rules(facts: Mapping[str, DataFrame]) -> dict[str, list[DataFrame]]:
    """One-row tables of rule counts per fact.

    ``facts``: the five source facts, ``shop_info`` and ``sku_info``, each with
    one row per key (``repeated_keys`` tells where not).
    """
    orders, details, payments = (facts[n] for n in ("order_info", "order_detail", "payment_info"))
    shops = _known(facts["shop_info"], "shop_id", "has_shop")
    skus = facts["sku_info"].select("sku_id", F.col("shop_id").alias("sku_shop_id"), F.lit(True).alias("has_sku"))
    shop_of_order = orders.select("order_id", F.col("shop_id").alias("order_shop_id"), F.lit(True).alias("has_order"))
    successes = _successes(payments)
    paid = F.coalesce("paid", F.lit(0))
    is_paid = F.col("order_status") == "PAID"
    order_pass = with_line_sums(orders, details).join(shops, "shop_id", "left").join(successes, "order_id", "left")
    detail_pass = details.join(shop_of_order, "order_id", "left").join(skus, "sku_id", "left")
    rating_pass = (
        facts["rating_info"].join(shop_of_order, "order_id", "left").join(successes, "order_id", "left")
    )
    behavior_pass = facts["user_behavior"].join(skus, "sku_id", "left")
    out = {
        "order_info": [_one_row(order_pass, {
            "shop_missing": F.col("has_shop").isNull(),
            "status_disagrees": (is_paid & (paid != 1)) | (~is_paid & (paid != 0)),
            "line_sum_differs": F.expr(LINE_SUM_DIFFERS),
        })],
        "order_detail": [_one_row(detail_pass, {
            "order_missing": F.col("has_order").isNull(),
            "sku_missing": F.col("has_sku").isNull(),
            "other_shop": F.col("order_shop_id") != F.col("sku_shop_id"),
        })],
        "payment_info": [
            _one_row(with_orders(payments, orders), {
                "order_missing": F.col("has_order").isNull(),
                "other_payer": F.col("user_id") != F.col("buyer_id"),
                "other_amount": F.expr("payment_status = 'SUCCESS' and payment_amount <> order_amount"),
                "paid_before_created": F.expr(PAID_BEFORE_CREATED),
            }),
            _one_row(successes, {"several_successes": F.col("successes") > 1}),
        ],
        "user_behavior": [_one_row(behavior_pass, {"sku_missing": F.col("has_sku").isNull()})],
        "rating_info": [_one_row(rating_pass, {
            "order_missing": F.col("has_order").isNull(),
            "other_shop": F.col("shop_id") != F.col("order_shop_id"),
            "no_success": paid == 0,
        })],
    }
    for fact in out:
        out[fact].append(_repeated(facts[fact], fact))
    return out


def _long(one_row: DataFrame, fact: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("rule"), F.col(c).cast("bigint").alias("rows")) for c in one_row.columns]
    return one_row.select(F.lit(fact).alias("fact"), F.inline(F.array(*pairs)))


def cross_report(facts: Mapping[str, DataFrame]) -> DataFrame:
    parts = [_long(row, fact) for fact, rows in cross_rules(facts).items() for row in rows]
    return reduce(DataFrame.unionByName, parts)


def report(facts: Mapping[str, DataFrame], days: Mapping[str, Column]) -> DataFrame:
    """(fact, rule, rows) of every rule, broken or not; ``days``: the day of each fact's rows."""
    rows = [_long(facts[fact].agg(*row_measures(fact, days[fact])), fact) for fact in TIMES]
    return reduce(DataFrame.unionByName, rows).unionByName(cross_report(facts))


def known_orders(facts: Mapping[str, DataFrame]) -> dict[tuple[str, str], DataFrame]:
    """Orders behind the rules of ``KNOWN``, to be compared with what was announced."""
    orders, details, payments = (facts[n] for n in ("order_info", "order_detail", "payment_info"))
    return {
        ("order_info", "line_sum_differs"):
            with_line_sums(orders, details).where(LINE_SUM_DIFFERS).select("order_id"),
        ("payment_info", "paid_before_created"):
            with_orders(payments, orders).where(PAID_BEFORE_CREATED).select("order_id"),
    }


def gate(
    counts: Mapping[tuple[str, str], int],
    facts: Mapping[str, DataFrame],
    announced: Mapping[tuple[str, str], DataFrame] | None = None,
) -> None:
    """Raise DataQualityError if a rule is broken.

    Rules of ``KNOWN`` do not raise by their count. If their orders were
    ``announced`` (order_id), the orders found must be that set, no more and no
    fewer.
    """
    broken = [f"{fact}.{rule}={n}" for (fact, rule), n in sorted(counts.items())
              if n and (fact, rule) not in KNOWN]
    found = known_orders(facts) if announced else {}
    for rule, expected in (announced or {}).items():
        wrong = set_difference(expected.select("order_id"), found[rule]).groupBy("side").count().collect()
        broken += [f"{'.'.join(rule)}: {r['count']} {r.side}" for r in sorted(wrong)]
    if broken:
        raise DataQualityError("source facts: " + ", ".join(broken))
