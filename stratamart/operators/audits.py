"""Audits of source facts: references, agreements between facts, bursts.

Each returns the rows that break a rule. Missing parents are anti joins and
disagreements are inner joins with a residual; both run as shuffle joins whose
skewed side AQE can split, and shrink to a broadcast when a side is measured
small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import money
from ..functions.temporal import ds_of


def missing_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent row (a NULL key has none either)."""
    return child.join(parent.select(key), key, "left_anti")


def wrong_shop_lines(details: DataFrame, orders: DataFrame, skus: DataFrame) -> DataFrame:
    """Lines whose SKU belongs to another shop than their order."""
    order_shop = orders.select("order_id", F.col("shop_id").alias("order_shop_id"))
    sku_shop = skus.select("sku_id", F.col("shop_id").alias("sku_shop_id"))
    return (
        details.select("order_detail_id", "order_id", "sku_id")
        .join(order_shop, "order_id")
        .join(sku_shop, "sku_id")
        .where(F.col("order_shop_id") != F.col("sku_shop_id"))
        .select("order_detail_id", "order_id", "sku_id", "order_shop_id", "sku_shop_id")
    )


def wrong_payer(payments: DataFrame, orders: DataFrame) -> DataFrame:
    buyer = orders.select("order_id", F.col("user_id").alias("order_user_id"))
    return (
        payments.select("payment_id", "order_id", "user_id")
        .join(buyer, "order_id")
        .where(F.col("user_id") != F.col("order_user_id"))
        .select("payment_id", "order_id", "user_id", "order_user_id")
    )


def _positive_success() -> Column:
    return (F.col("payment_status") == "SUCCESS") & (F.col("payment_amount") > 0)


def status_disagrees(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """PAID orders without exactly one success payment, others with any."""
    counts = (
        payments.where(_positive_success())
        .groupBy("order_id")
        .agg(F.count("*").alias("success_count"))
    )
    n = F.coalesce("success_count", F.lit(0))
    paid = F.col("order_status") == "PAID"
    return (
        orders.select("order_id", "order_status")
        .join(counts, "order_id", "left")
        .withColumn("success_count", n)
        .where((paid & (F.col("success_count") != 1)) | (~paid & (F.col("success_count") != 0)))
    )


def multiple_success(payments: DataFrame) -> DataFrame:
    return (
        payments.where(F.col("payment_status") == "SUCCESS")
        .groupBy("order_id")
        .agg(F.count("*").alias("success_count"))
        .where(F.col("success_count") > 1)
    )


def rating_without_success(
    ratings: DataFrame, orders: DataFrame, payments: DataFrame
) -> DataFrame:
    """Ratings of unknown orders, of another shop, or of orders without success.

    Payments shrink to one row per order first, so the left joins keep one row
    per rating and one pass finds all three faults.
    """
    order_shop = orders.select("order_id", F.col("shop_id").alias("order_shop_id"))
    paid = payments.where(_positive_success()).select(
        "order_id", F.lit(True).alias("_paid")
    ).distinct()
    return (
        ratings.select("rating_id", "order_id", "shop_id")
        .join(order_shop, "order_id", "left")
        .join(paid, "order_id", "left")
        .where(
            F.col("order_shop_id").isNull()
            | (F.col("shop_id") != F.col("order_shop_id"))
            | F.col("_paid").isNull()
        )
        .select("rating_id", "order_id", "shop_id")
    )


def amount_mismatch(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Orders whose line sum is not the order amount."""
    sums = details.groupBy("order_id").agg(
        money(F.sum("final_amount")).alias("detail_amount")
    )
    return (
        orders.select("order_id", "order_amount")
        .join(sums, "order_id")
        .where(F.col("detail_amount") != F.col("order_amount"))
    )


def paid_before_created(payments: DataFrame, orders: DataFrame) -> DataFrame:
    created = orders.select("order_id", "create_time")
    return (
        payments.where(F.col("payment_status") == "SUCCESS")
        .select("payment_id", "order_id", "payment_time")
        .join(created, "order_id")
        .where(F.col("payment_time") < F.col("create_time"))
        .select("payment_id", "order_id", "payment_time", "create_time")
    )


def payment_amount_differs(payments: DataFrame, orders: DataFrame) -> DataFrame:
    due = orders.select("order_id", "order_amount")
    return (
        payments.where(F.col("payment_status") == "SUCCESS")
        .select("payment_id", "order_id", "payment_amount")
        .join(due, "order_id")
        .where(F.col("payment_amount") != F.col("order_amount"))
        .select("payment_id", "order_id", "payment_amount", "order_amount")
    )


def outside_day(df: DataFrame, times: list[str], ds: Column) -> DataFrame:
    """Rows with any time on another day than ``ds`` (a literal or the ds column)."""
    return df.where(reduce(lambda a, b: a | b, [ds_of(F.col(t)) != ds for t in times]))


def placeholder_names(
    df: DataFrame, key: str, name: str, prefix: str, must_contain: str | None = None
) -> DataFrame:
    """Dimension rows whose name is a placeholder or lacks a required part."""
    bad = F.col(name).startswith(prefix)
    if must_contain is not None:
        bad = bad | ~F.col(name).contains(must_contain)
    return df.where(bad).select(key, name)


def price_outside_category(skus: DataFrame, ranges: DataFrame) -> DataFrame:
    """SKUs of an unknown category or priced outside its (price_low, price_high)."""
    return (
        skus.select("sku_id", "category_id", "price")
        .join(ranges, "category_id", "left")
        .where(
            F.col("price_low").isNull()
            | ~F.col("price").between(F.col("price_low"), F.col("price_high"))
        )
        .select("sku_id", "category_id", "price")
    )


def bursts(
    df: DataFrame, who: str, time: str, within_seconds: int, at_least: int
) -> DataFrame:
    """Moments at which ``who`` had ``at_least`` rows in the last ``within_seconds``.

    Split so that one busy user does not land in one task: rows are counted
    per (user, time) first, each count is placed in its time bucket and in the
    next one as context, and the sliding window runs per (user, bucket). A
    bucket is as long as the window, so no earlier bucket can contribute.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    width = within_seconds * 1_000_000
    moments = (
        df.groupBy(who, time)
        .agg(F.count("*").alias("_n"))
        .withColumn("_at", micros)
        .withColumn("_own", F.floor(F.col("_at") / width))
    )
    placed = moments.withColumn(
        "_bucket", F.explode(F.array(F.col("_own"), F.col("_own") + 1))
    )
    window = (
        Window.partitionBy(who, "_bucket").orderBy("_at").rangeBetween(-width, 0)
    )
    return (
        placed.withColumn("events", F.sum("_n").over(window))
        .where((F.col("_bucket") == F.col("_own")) & (F.col("events") >= at_least))
        .select(who, F.col(time), "events")
    )


def unpaid_order_bursts(unpaid: DataFrame) -> DataFrame:
    """At least six unpaid orders of a user within 60 seconds."""
    return bursts(unpaid, "user_id", "create_time", 60, 6)


def failed_payment_bursts(failed: DataFrame) -> DataFrame:
    """At least three failed payments of a user within 180 seconds."""
    return bursts(failed, "user_id", "payment_time", 180, 3)
