"""Period aggregates of the site, each SKU and each shop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import MONEY
from ..functions.temporal import day_of
from ..operators.dedup import latest_by
from ..operators.periods import Periods
from ..schemas import columns_of
from .dwd import history

SKU_ATTRIBUTES = ["sku_name", "category_id", "category_name", "shop_id", "shop_name"]


# ---- site ------------------------------------------------------------------

def site_traffic(behavior: DataFrame, ds: str) -> DataFrame:
    """Page views, favorites and carts per period, and users with a view."""
    periods = Periods(ds)
    day, kind = F.col("event_date"), F.col("event_type")
    per_user = (
        behavior.where(periods.known(day))
        .groupBy("user_id")
        .agg(
            *periods.count_hits("pv_count", day, F.col("event_id").isNotNull()),
            *periods.count_hits("favorite_count", day, kind == "favorite"),
            *periods.count_hits("cart_count", day, kind == "cart"),
            F.max(F.when(kind == "view", day)).alias("last_view"),
        )
    )
    site = per_user.agg(
        *periods.sums("pv_count"),
        *periods.sums("favorite_count"),
        *periods.sums("cart_count"),
        *periods.reached_by(
            "uv_count", F.col("last_view"), F.col("user_id").isNotNull()
        ),
    )
    return periods.long_form(
        site, [], dict.fromkeys(
            ["pv_count", "uv_count", "favorite_count", "cart_count"], "bigint"
        )
    )


def newest_creation(orders: DataFrame, ds: str) -> DataFrame:
    """Creation time of each order by its newest version."""
    return latest_by(
        history(orders, ds).select("order_id", "create_time", "update_time", "ds"),
        ["order_id"],
        ["update_time", "ds"],
        ["create_time"],
    )


def site_orders(newest: DataFrame, ds: str) -> DataFrame:
    """Created orders per period, all statuses; one row per order is given."""
    periods = Periods(ds)
    created = newest.where(F.col("order_id").isNotNull()).withColumn(
        "order_date", day_of(F.col("create_time"))
    )
    site = created.agg(*periods.count_hits("order_count", F.col("order_date")))
    return periods.long_form(site, [], {"order_count": "bigint"})


def paid_orders(trade_lines: DataFrame) -> DataFrame:
    """One row per paid order, so that many lines do not count an order twice."""
    return trade_lines.groupBy("order_id").agg(
        F.max("user_id").alias("user_id"),
        F.max("payment_amount").alias("payment_amount"),
        F.max("payment_date").alias("payment_date"),
        F.sum("sku_num").alias("sku_num"),
    )


def site_payments(trade_lines: DataFrame, ds: str) -> DataFrame:
    """Paid orders, payers, items and GMV (order level) per period."""
    periods = Periods(ds)
    day = F.col("payment_date")
    per_user = (
        paid_orders(trade_lines)
        .where(periods.known(day))
        .groupBy("user_id")
        .agg(
            *periods.count_hits("paid_order_count", day, F.col("order_id").isNotNull()),
            *periods.sum_hits("paid_sku_num", day, F.col("sku_num")),
            *periods.sum_hits("gmv", day, F.col("payment_amount")),
            F.max(day).alias("last_paid"),
        )
    )
    site = per_user.agg(
        *periods.sums("paid_order_count"),
        *periods.sums("paid_sku_num"),
        *periods.sums("gmv"),
        *periods.reached_by(
            "paid_user_count", F.col("last_paid"), F.col("user_id").isNotNull()
        ),
    )
    return periods.long_form(
        site,
        [],
        {
            "paid_order_count": "bigint",
            "paid_user_count": "bigint",
            "paid_sku_num": "bigint",
            "gmv": MONEY,
        },
    )


def site_stats(
    behavior: DataFrame, trade_lines: DataFrame, orders: DataFrame, ds: str
) -> DataFrame:
    """Nine metrics for each of the four periods, from the whole history of orders."""
    return site_stats_of(behavior, trade_lines, newest_creation(orders, ds), ds)


def site_stats_of(
    behavior: DataFrame, trade_lines: DataFrame, newest_orders: DataFrame, ds: str
) -> DataFrame:
    """The same from the newest row of each order; empty periods give zeros.

    Each input shrinks to four rows before anything is joined.
    """
    periods = Periods(ds).table(behavior.sparkSession).select("stat_period")
    joined = (
        periods.join(site_traffic(behavior, ds), "stat_period", "left")
        .join(site_orders(newest_orders, ds), "stat_period", "left")
        .join(site_payments(trade_lines, ds), "stat_period", "left")
    )
    return joined.select(*columns_of("cdm.dws_site_stats_df"))


# ---- SKU -------------------------------------------------------------------

def sku_attributes(detail: DataFrame, ds: str, day: str) -> DataFrame:
    """Names and owner of each SKU seen up to ``ds``, one row per SKU.

    Taken apart from the metrics: it scans a few dictionary-coded columns and
    shuffles one row per SKU and task, while the metric shuffles stay numeric.
    A snapshot is built from one frozen dimension, so a SKU has one set of
    attributes; a second set would give repeated keys, which the contract of
    the aggregate refuses. The distinct is a hash aggregate, a max over names
    would sort all rows.
    """
    seen = detail.where(Periods(ds).known(F.col(day)))
    return seen.select("sku_id", *SKU_ATTRIBUTES).distinct()


def sku_traffic(behavior: DataFrame, ds: str) -> DataFrame:
    """Wide traffic metrics of each SKU: views, viewers and cart users."""
    periods = Periods(ds)
    day, kind = F.col("event_date"), F.col("event_type")
    per_user = (
        behavior.where(periods.known(day))
        .groupBy("sku_id", "user_id")
        .agg(
            *periods.count_hits("pv_count", day, kind == "view"),
            F.max(F.when(kind == "view", day)).alias("last_view"),
            F.max(F.when(kind == "cart", day)).alias("last_cart"),
            F.max(day).alias("last_day"),
        )
    )
    known_user = F.col("user_id").isNotNull()
    return per_user.groupBy("sku_id").agg(
        *periods.sums("pv_count"),
        *periods.reached_by("visitor_count", F.col("last_view"), known_user),
        *periods.reached_by("cart_user_count", F.col("last_cart"), known_user),
        F.max("last_day").alias("last_day"),
    )


def sku_sales(trade_lines: DataFrame, ds: str) -> DataFrame:
    """Wide sales metrics of each SKU; GMV at line level.

    Narrowed in steps (order, payer, SKU). Lines are shuffled once, as narrow
    rows, by SKU and payer, which serves the first two steps: partial rows of
    12 sums per SKU and payer would be wider than the lines. A hot SKU or payer
    is spread by the other of the two until only partial rows are left.
    """
    periods = Periods(ds)
    day = F.col("payment_date")
    per_order = (
        trade_lines.where(periods.known(day))
        .select("sku_id", "user_id", "order_id", "payment_date", "sku_num", "final_amount")
        .repartition("sku_id", "user_id")
        .groupBy("sku_id", "user_id", "order_id")
        .agg(
            F.max("payment_date").alias("payment_date"),
            F.sum("sku_num").alias("sku_num"),
            F.sum("final_amount").alias("final_amount"),
        )
    )
    per_user = per_order.groupBy("sku_id", "user_id").agg(
        *periods.count_hits("paid_order_count", day, F.col("order_id").isNotNull()),
        *periods.sum_hits("paid_sku_num", day, F.col("sku_num")),
        *periods.sum_hits("gmv", day, F.col("final_amount")),
        F.max(day).alias("last_day"),
    )
    return per_user.groupBy("sku_id").agg(
        *periods.sums("paid_order_count"),
        *periods.sums("paid_sku_num"),
        *periods.sums("gmv"),
        *periods.reached_by(
            "paid_user_count", F.col("last_day"), F.col("user_id").isNotNull()
        ),
        F.max("last_day").alias("last_day"),
    )


def sku_trade(behavior: DataFrame, trade_lines: DataFrame, ds: str) -> DataFrame:
    """Traffic and sales of every SKU that has either, per period.

    Traffic and sales meet in a full outer join of one wide row per SKU; both
    sides are already hashed by sku_id. Where both know a SKU, its attributes
    come from the traffic side.
    """
    periods = Periods(ds)
    visited = sku_traffic(behavior, ds).join(
        sku_attributes(behavior, ds, "event_date"), "sku_id"
    )
    sold = sku_sales(trade_lines, ds).join(
        sku_attributes(trade_lines, ds, "payment_date"), "sku_id"
    )
    traffic_metrics = ["pv_count", "visitor_count", "cart_user_count"]
    sales_metrics = ["paid_order_count", "paid_user_count", "paid_sku_num", "gmv"]
    v, s = visited.alias("v"), sold.alias("s")
    merged = v.join(s, F.col("v.sku_id") == F.col("s.sku_id"), "full").select(
        *[
            F.coalesce(F.col(f"v.{c}"), F.col(f"s.{c}")).alias(c)
            for c in ["sku_id", *SKU_ATTRIBUTES]
        ],
        F.greatest("v.last_day", "s.last_day").alias("last_day"),
        *[f"v.{c}" for m in traffic_metrics for c in _wide(visited, m)],
        *[f"s.{c}" for m in sales_metrics for c in _wide(sold, m)],
    )
    types = {**dict.fromkeys(traffic_metrics + sales_metrics, "bigint"), "gmv": MONEY}
    long = periods.long_form(
        merged, ["sku_id", *SKU_ATTRIBUTES], types, present="last_day"
    )
    return long.select(*columns_of("cdm.dws_sku_trade_df"))


def _wide(df: DataFrame, metric: str) -> list[str]:
    return [c for c in df.columns if c.startswith(f"{metric}__")]


# ---- shop ------------------------------------------------------------------

def shop_rating(ratings: DataFrame, ds: str) -> DataFrame:
    """Rating counts and score sum of each shop and period."""
    periods = Periods(ds)
    day, level = F.col("rating_date"), F.col("score_level")
    additive = ["rating_count", "score_sum", "good_count", "mid_count", "bad_count"]
    by_name = (
        ratings.where(periods.known(day))
        .groupBy("shop_id", "shop_name")
        .agg(
            *periods.count_hits("rating_count", day),
            *periods.sum_hits("score_sum", day, F.col("shop_score").cast("bigint")),
            *periods.count_hits("good_count", day, level == "good"),
            *periods.count_hits("mid_count", day, level == "mid"),
            *periods.count_hits("bad_count", day, level == "bad"),
            F.max(day).alias("last_day"),
        )
    )
    per_shop = by_name.groupBy("shop_id").agg(
        F.max("shop_name").alias("shop_name"),
        *[c for m in additive for c in periods.sums(m)],
        F.max("last_day").alias("last_day"),
    )
    long = periods.long_form(
        per_shop,
        ["shop_id", "shop_name"],
        dict.fromkeys(additive, "bigint"),
        present="last_day",
    )
    return long.select(*columns_of("cdm.dws_shop_rating_df"))
