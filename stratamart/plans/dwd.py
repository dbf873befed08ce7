"""Detail snapshots: the complete valid history up to a cutoff day.

Every function takes the increment history (with its ``ds`` column) and reads
``ds <= cutoff`` itself, so a partitioned scan is pruned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import score_level
from ..functions.money import money
from ..functions.temporal import day_of, on_or_before
from ..operators.dedup import latest_by, only_member
from ..operators.skew import (
    ROWS_PER_TASK,
    hot_keys,
    salted_join,
    same,
)
from ..schemas import columns_of
from .contracts import EVENT_TYPES


def history(increments: DataFrame, ds: str) -> DataFrame:
    """All increments up to and including ``ds``; yyyyMMdd text sorts as dates."""
    return increments.where(F.col("ds") <= ds)


# ---- newest row of each business key ---------------------------------------
# Trade facts rank first and filter on status afterwards: a later CANCELLED
# version hides an earlier PAID one. Behaviors and ratings filter first: an
# invalid newest row must not hide an older valid one.

@dataclass(frozen=True)
class Newest:
    """Which row of a key is the newest: its order, ended by ties, and what is kept."""

    key: str
    newest_first: tuple[str, ...]
    ties: tuple[str, ...]
    columns: tuple[str, ...]

    def of(self, rows: DataFrame) -> DataFrame:
        return latest_by(rows.select(*self.columns), [self.key], self.newest_first, self.ties)


ORDERS = Newest(
    "order_id",
    ("update_time", "ds"),
    ("create_time", "order_status", "order_amount", "user_id", "shop_id"),
    ("order_id", "user_id", "shop_id", "order_status", "order_amount", "create_time",
     "update_time", "ds"),
)
DETAILS = Newest(
    "order_detail_id",
    ("create_time", "ds"),
    ("sku_id", "original_amount", "final_amount", "sku_num", "order_id"),
    ("order_detail_id", "order_id", "sku_id", "sku_num", "original_amount", "final_amount",
     "create_time", "ds"),
)
PAYMENTS = Newest(
    "payment_id",
    ("payment_time", "create_time", "ds"),
    ("payment_status", "payment_amount", "order_id", "user_id"),
    ("payment_id", "order_id", "user_id", "payment_status", "payment_amount", "payment_time",
     "create_time", "ds"),
)
CANDIDATES = Newest("order_id", ("ds",), (), ("order_id", "ds"))
EVENTS = Newest(
    "event_id",
    ("event_time", "ds"),
    ("event_type", "sku_id", "user_id", "session_id"),
    ("event_id", "session_id", "user_id", "sku_id", "event_type", "event_time", "ds"),
)
RATINGS = Newest(
    "order_id",
    ("rating_time", "rating_id", "ds"),
    ("shop_score", "shop_id"),
    ("rating_id", "order_id", "shop_id", "shop_score", "rating_time", "ds"),
)


def latest_orders(orders: DataFrame, ds: str) -> DataFrame:
    return ORDERS.of(history(orders, ds))


def latest_details(details: DataFrame, ds: str) -> DataFrame:
    return DETAILS.of(history(details, ds))


def latest_payments(payments: DataFrame, ds: str) -> DataFrame:
    return PAYMENTS.of(history(payments, ds))


def _complete_events(behavior: DataFrame, ds: str) -> DataFrame:
    complete = (
        F.col("event_id").isNotNull()
        & F.col("session_id").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("sku_id").isNotNull()
        & F.col("event_time").isNotNull()
    )
    return history(behavior, ds).where(complete & F.col("event_type").isin(*EVENT_TYPES))


def valid_events(behavior: DataFrame, ds: str) -> DataFrame:
    return _complete_events(behavior, ds).where(on_or_before(F.col("event_time"), ds))


def later_events(behavior: DataFrame, ds: str) -> DataFrame:
    """Events that will be valid on a later day."""
    return _complete_events(behavior, ds).where(~on_or_before(F.col("event_time"), ds))


def latest_events(behavior: DataFrame, ds: str) -> DataFrame:
    return EVENTS.of(valid_events(behavior, ds))


def _complete_ratings(ratings: DataFrame, ds: str) -> DataFrame:
    complete = (
        F.col("rating_id").isNotNull()
        & F.col("order_id").isNotNull()
        & F.col("shop_id").isNotNull()
        & F.col("rating_time").isNotNull()
    )
    return history(ratings, ds).where(complete & F.col("shop_score").between(1, 5))


def valid_ratings(ratings: DataFrame, ds: str) -> DataFrame:
    return _complete_ratings(ratings, ds).where(on_or_before(F.col("rating_time"), ds))


def later_ratings(ratings: DataFrame, ds: str) -> DataFrame:
    """Ratings that will be valid on a later day."""
    return _complete_ratings(ratings, ds).where(~on_or_before(F.col("rating_time"), ds))


def latest_ratings(ratings: DataFrame, ds: str) -> DataFrame:
    return RATINGS.of(valid_ratings(ratings, ds))


# ---- trade -----------------------------------------------------------------

def _succeeded(newest: DataFrame) -> DataFrame:
    return newest.where((F.col("payment_status") == "SUCCESS") & (F.col("payment_amount") > 0))


def _only_success(newest: DataFrame) -> DataFrame:
    return only_member(
        _succeeded(newest), "order_id", ["payment_id", "user_id", "payment_amount", "payment_time"]
    )


def _line_sums(newest: DataFrame) -> DataFrame:
    return newest.groupBy("order_id").agg(
        F.sum("final_amount").alias("detail_final_amount"),
        F.count("*").alias("line_count"),
    )


def success_payments(payments: DataFrame, ds: str) -> DataFrame:
    return _succeeded(latest_payments(payments, ds))


def single_success(payments: DataFrame, ds: str) -> DataFrame:
    """The success payment of orders that have exactly one."""
    return _only_success(latest_payments(payments, ds))


def detail_amounts(details: DataFrame, ds: str) -> DataFrame:
    """Sum and number of the newest lines of each order."""
    return _line_sums(latest_details(details, ds))


def valid_orders(
    orders: DataFrame, details: DataFrame, payments: DataFrame, ds: str
) -> DataFrame:
    """Paid orders whose single payment, time order and amounts agree.

    All three inputs arrive hashed by order_id from their own dedup or
    aggregate, so these joins add no shuffle.
    """
    return valid_orders_of(
        latest_orders(orders, ds), latest_details(details, ds), latest_payments(payments, ds)
    )


def valid_orders_of(orders: DataFrame, details: DataFrame, payments: DataFrame) -> DataFrame:
    """The same from the newest rows of each key."""
    paid = _only_success(payments).withColumnRenamed("user_id", "payer_id")
    order = orders.select(
        "order_id", "user_id", "shop_id", "order_status", "order_amount", "create_time"
    )
    return (
        order.where(F.col("order_status") == "PAID")
        .join(paid, "order_id")
        .join(_line_sums(details), "order_id")
        .where(
            same(F.col("payer_id"), F.col("user_id"))
            & (F.col("payment_time") >= F.col("create_time"))
            & same(F.col("detail_final_amount"), F.col("order_amount"))
            & same(F.col("payment_amount"), F.col("order_amount"))
        )
        .select("order_id", "user_id", "shop_id", "order_amount", "create_time",
                "payment_id", "payment_amount", "payment_time", "line_count")
    )


def trade(
    orders: DataFrame,
    details: DataFrame,
    payments: DataFrame,
    skus: DataFrame,
    ds: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Valid paid order lines up to ``ds``, from the whole history."""
    return trade_of(
        latest_orders(orders, ds),
        latest_details(details, ds),
        latest_payments(payments, ds),
        skus,
        rows_per_task,
    )


def trade_of(
    orders: DataFrame,
    details: DataFrame,
    payments: DataFrame,
    skus: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Valid paid order lines, from the newest rows of each key.

    The line join is the only one where an order may own very many rows. The
    line counts are known from the amount check, so orders beyond
    ``rows_per_task`` lines are salted over as many tasks as they need.
    """
    lines = details.select(
        "order_detail_id", "order_id", "sku_id", "sku_num",
        "original_amount", "final_amount",
    )
    # The sums of valid orders are not NULL. Asking for them here too makes both
    # uses of the sums one shuffle.
    sums = _line_sums(details).where(F.col("detail_final_amount").isNotNull())
    hot = hot_keys(sums, "order_id", "line_count", rows_per_task)
    order = valid_orders_of(orders, details, payments).withColumn(
        "_salts",
        F.when(
            F.col("line_count") > rows_per_task,
            F.ceil(F.col("line_count") / F.lit(rows_per_task)).cast("int"),
        ),
    )
    # A valid order's payment equals its amount: one of the two travels.
    owned = salted_join(
        lines, order.drop("payment_amount"), "order_id", hot, "order_detail_id"
    )
    sold = skus.select("sku_id", "shop_id", "sku_name", "category_id",
                       "category_name", "shop_name")
    # (sku_id, shop_id): a line whose SKU belongs to another shop is not valid.
    full = owned.join(sold, ["sku_id", "shop_id"]).withColumn(
        "payment_amount", F.col("order_amount")
    )
    amounts = {
        c: money(F.col(c))
        for c in ("original_amount", "final_amount", "order_amount", "payment_amount")
    }
    return full.withColumns(
        {
            **amounts,
            "order_date": day_of(F.col("create_time")),
            "payment_date": day_of(F.col("payment_time")),
        }
    ).select(*columns_of("cdm.dwd_trd_pay_dtl_df"))


def cleaning_summary(payments: DataFrame, trade_lines: DataFrame, ds: str) -> DataFrame:
    """Orders with any success payment, orders kept, and the difference.

    Candidates are counted before dedup and without an amount check.
    """
    return cleaning_summary_of(candidate_orders(payments, ds), trade_lines)


def cleaning_summary_of(candidate: DataFrame, trade_lines: DataFrame) -> DataFrame:
    candidates = candidate.withColumnRenamed("order_count", "candidate")
    kept = trade_lines.select("order_id").distinct().agg(F.count("*").alias("valid"))
    # Both sides are single rows; a union and a sum put them side by side.
    return (
        candidates.unionByName(kept, allowMissingColumns=True)
        .agg(F.sum("candidate").alias("candidate"), F.sum("valid").alias("valid"))
        .withColumn("excluded", F.col("candidate") - F.col("valid"))
    )


def candidate_orders(payments: DataFrame, ds: str) -> DataFrame:
    return (
        history(payments, ds)
        .where(F.col("payment_status") == "SUCCESS")
        .agg(F.countDistinct("order_id").alias("order_count"))
    )


# ---- behavior --------------------------------------------------------------

def behavior(events: DataFrame, skus: DataFrame, ds: str) -> DataFrame:
    """Newest valid event of each id, with its SKU's attributes."""
    return behavior_of(latest_events(events, ds), skus)


def behavior_of(newest: DataFrame, skus: DataFrame) -> DataFrame:
    """The same from the newest valid events."""
    attributes = skus.select("sku_id", "sku_name", "category_id", "category_name",
                             "shop_id", "shop_name")
    return (
        newest.drop("ds").join(attributes, ["sku_id"])
        .withColumn("event_date", day_of(F.col("event_time")))
        .select(*columns_of("cdm.dwd_user_behavior_df"))
    )


# ---- rating ----------------------------------------------------------------

def paid_shops(trade_lines: DataFrame) -> DataFrame:
    """One row per valid paid order: its shop.

    All lines of a valid order carry its one shop, so the distinct leaves one
    row per order; it runs as a hash aggregate, where a max over the name
    would sort every line. Should a snapshot name one shop in two ways, the
    rating contract (unique order_id) refuses the result.
    """
    return trade_lines.select("order_id", "shop_id", "shop_name").distinct()


def rating(ratings: DataFrame, trade_lines: DataFrame, ds: str) -> DataFrame:
    """Newest valid rating of each order that has valid trade in the same shop."""
    return rating_of(latest_ratings(ratings, ds), trade_lines)


def rating_of(newest: DataFrame, trade_lines: DataFrame) -> DataFrame:
    """The same from the newest valid ratings."""
    paid = paid_shops(trade_lines).withColumnRenamed("shop_id", "paid_shop_id")
    return (
        newest.join(paid, "order_id")
        .where(same(F.col("shop_id"), F.col("paid_shop_id")))
        .withColumn("score_level", score_level(F.col("shop_score")))
        .withColumn("rating_date", day_of(F.col("rating_time")))
        .select(*columns_of("cdm.dwd_shop_rating_df"))
    )
