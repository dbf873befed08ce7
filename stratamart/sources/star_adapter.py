"""Shows a star-schema data set (orders, lineitem, part, ...) as commerce facts.

The given parquet tables have no payments, ratings or SKU on events, so these
columns follow from fixed arithmetic on the keys. Each view is a lazy
DataFrame over the whole tables and grows with them.

Three families of views:

* ``shop_info`` ... ``rating_info``: source facts, one row per key, including
  rule breakers (wrong shop, wrong payer, two payments, unequal amounts);
* ``ods_*``: the same facts with their ``ds`` plus older versions and invalid
  newer ones, as daily increments accumulate them;
* ``audit_*``: source facts plus orphans and bursts, for the audits.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import money
from ..functions.temporal import ds_of
from ..operators.dedup import latest_by

EPOCH = "timestamp_ntz'2023-12-17 00:00:00'"
STAR_START = "date'1995-01-01'"


def _plus_seconds(time: str, seconds: str) -> Column:
    return F.expr(
        f"{time} + make_dt_interval(0, 0, 0, cast({seconds} as decimal(18,6)))"
    )


def _versions(df: DataFrame, rows: list[Column], *keep: str) -> DataFrame:
    """Replace each row by the structs that are not NULL (one pass, no union).

    Columns to ``keep`` stand beside the structs, so rows hashed by them stay so.
    """
    return df.select(*keep, F.inline(F.array_compact(F.array(*rows))))


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` hashed by ``key``, the same shuffle for each use of it.

    Filters on other columns and unused columns do not get past ``inline``, so
    what is below stays the same plan for each use and runs once.
    """
    rest = F.struct(*[c for c in df.columns if c != key])
    return df.repartition(key).select(key, F.inline(F.array(rest)))


class StarAdapter:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}.parquet")

    # ---- source facts ------------------------------------------------------

    @cached_property
    def shop_info(self) -> DataFrame:
        nation = self.raw("nation").select("n_nationkey", "n_name")
        return (
            self.raw("supplier")
            .join(nation, F.expr("s_nationkey = n_nationkey"))
            .select(
                F.col("s_suppkey").alias("shop_id"),
                F.col("s_name").alias("shop_name"),
                F.col("n_name").alias("province_name"),
                F.expr(
                    "timestamp_ntz'2020-01-01 00:00:00'"
                    " + make_dt_interval(cast(s_suppkey as int))"
                ).alias("open_time"),
                F.expr("cast(if(s_suppkey % 7 = 3, 0, 1) as tinyint)").alias("status"),
            )
        )

    @cached_property
    def sku_info(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("sku_id"),
            F.col("p_name").alias("sku_name"),
            F.expr("cast(substring(p_brand, 7) as bigint)").alias("category_id"),
            F.col("p_brand").alias("category_name"),
            F.expr("p_partkey % 10").alias("shop_id"),
            money(F.col("p_retailprice")).alias("price"),
            F.expr("cast(if(p_partkey % 50 = 0, 0, 1) as tinyint)").alias("status"),
            F.expr("timestamp_ntz'2023-01-01 00:00:00'").alias("create_time"),
            _plus_seconds("timestamp_ntz'2023-01-01 00:00:00'", "p_partkey").alias(
                "update_time"
            ),
        )

    @cached_property
    def _order_head(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.expr("o_orderkey % 10").alias("shop_id"),
            F.expr(
                "case when o_orderstatus in ('F', 'O') then 'PAID' "
                "when o_orderkey % 2 = 0 then 'CREATED' else 'CANCELLED' end"
            ).alias("order_status"),
            F.expr(
                f"{EPOCH} + make_dt_interval("
                f"datediff(o_orderdate, {STAR_START}) % 45, 0, 0, "
                "cast(600 + o_orderkey % 72000 as decimal(18,6)))"
            ).alias("create_time"),
        )

    @cached_property
    def _line_rows(self) -> DataFrame:
        """Lines beside the time of their order, as narrow rows."""
        heads = self._order_head.select("order_id", F.col("create_time").alias("_t"))
        lines = self.raw("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            F.expr("cast(l_quantity as int)").alias("_quantity"),
            "l_extendedprice",
            F.col("l_discount").cast("decimal(4,2)").alias("_discount"),
            F.expr(f"datediff(l_shipdate, {STAR_START}) % 60").alias("_late"),
        )
        return lines.join(heads, F.expr("l_orderkey = order_id")).drop("order_id").select(
            F.expr("l_orderkey * 10 + l_linenumber").alias("order_detail_id"), "*"
        ).drop("l_linenumber")

    @staticmethod
    def _details(lines: DataFrame) -> DataFrame:
        return lines.select(
            "order_detail_id",
            F.col("l_orderkey").alias("order_id"),
            F.expr(
                "if(l_orderkey % 97 = 0, l_partkey,"
                " l_partkey - l_partkey % 10 + l_orderkey % 10)"
            ).alias("sku_id"),
            F.col("_quantity").alias("sku_num"),
            money(F.col("l_extendedprice")).alias("original_amount"),
            money(money(F.col("l_extendedprice")) * (1 - F.col("_discount"))).alias(
                "final_amount"
            ),
            _plus_seconds("_t", "_late").alias("create_time"),
        )

    @cached_property
    def _detail_rows(self) -> DataFrame:
        """All line rows; line numbers repeat within an order, so ids do too."""
        return self._details(self._line_rows)

    @cached_property
    def _dealt_details(self) -> DataFrame:
        """The same hashed by line id, for all that keep one row of each id."""
        return self._details(_dealt(self._line_rows, "order_detail_id"))

    @cached_property
    def order_detail(self) -> DataFrame:
        return latest_by(
            self._dealt_details,
            ["order_detail_id"],
            ["create_time"],
            ["sku_id", "original_amount", "final_amount", "sku_num", "order_id"],
        )

    @cached_property
    def order_info(self) -> DataFrame:
        totals = self.order_detail.groupBy("order_id").agg(
            F.sum("final_amount").alias("_sum")
        )
        return self._order_head.join(totals, "order_id", "left").select(
            "order_id",
            "user_id",
            "shop_id",
            "order_status",
            money(
                F.coalesce("_sum", F.lit(0))
                + F.expr("cast(if(order_id % 50 = 7, 1, 0) as decimal(3,2))")
            ).alias("order_amount"),
            "create_time",
            # Up to a day later, so the last change may fall on the next day.
            _plus_seconds("create_time", "order_id % 26 * 3600").alias("update_time"),
        )

    def _payment_rows(self, with_history: bool) -> DataFrame:
        """Up to four attempts per order, as one exploded array."""
        kind = "element_at(array('ALIPAY', 'WECHAT', 'CARD'), cast(order_id % 3 as int) + 1)"

        def attempt(when: str, number: int, user: str, status: str, amount: str, at: str):
            return F.expr(
                f"case when {when} then named_struct("
                f"'payment_id', order_id * 10 + {number}, 'order_id', order_id, "
                f"'user_id', {user}, 'payment_type', {kind}, "
                f"'payment_status', '{status}', "
                f"'payment_amount', cast({amount} as decimal(20,2)), "
                f"'payment_time', create_time + make_dt_interval(0, 0, 0, "
                f"cast({at} as decimal(18,6)))) end"
            )

        payer = "user_id + if(order_id % 90 = 13, 1, 0)"
        paid_at = "if(order_id % 40 = 5, -30, 1 + order_id * 37 % 1800)"
        rows = [
            attempt(
                "order_status = 'PAID'", 1, payer, "SUCCESS",
                "order_amount - if(order_id % 60 = 11, 0.01, 0.00)", paid_at,
            ),
            attempt("order_id % 8 = 0", 2, "user_id", "FAILED", "0", "1 + order_id % 600"),
            attempt(
                "order_status = 'PAID' and order_id % 75 = 9", 3, "user_id", "SUCCESS",
                "order_amount", "900",
            ),
        ]
        if with_history:
            # An older state of the success payment, which must lose.
            rows.append(
                attempt(
                    "order_status = 'PAID' and order_id % 30 = 4", 1, "user_id",
                    "FAILED", "0", "-20",
                )
            )
        return _versions(self.order_info, rows).withColumn(
            "create_time", F.expr("payment_time + interval 1 second")
        )

    @cached_property
    def payment_info(self) -> DataFrame:
        return self._payment_rows(with_history=False)

    @cached_property
    def _behavior_source(self) -> DataFrame:
        return self.raw("events").select(
            "event_id",
            "user_id",
            F.expr("cast(get_json_object(props, '$.k') as bigint)").alias("sku_id"),
            F.expr(
                "case event_type when 'view' then 'view' when 'click' then 'favorite' "
                "when 'purchase' then 'cart' else event_type end"
            ).alias("event_type"),
            F.expr(
                "if(event_id % 2 = 1, ts - interval 20 days, ts)"
            ).alias("event_time"),
        )

    @cached_property
    def user_behavior(self) -> DataFrame:
        return self._behavior_source.select(
            "event_id",
            F.concat_ws("-", "user_id", ds_of(F.col("event_time"))).alias("session_id"),
            "user_id",
            "sku_id",
            "event_type",
            "event_time",
        )

    @cached_property
    def rating_info(self) -> DataFrame:
        score = (
            "case when order_id % 101 = 0 then 6 "
            "when order_id % 10 = 3 then 1 + (order_id div 7) % 3 "
            "else element_at(array(1,2,3,3,4,4,4,5,5,5), "
            "cast(1 + (order_id div 30 + user_id) % 10 as int)) end"
        )
        return self._order_head.select(
            F.col("order_id").alias("rating_id"),
            "order_id",
            "shop_id",
            F.expr(f"cast({score} as tinyint)").alias("shop_score"),
            F.expr("create_time + interval 2 hours").alias("rating_time"),
        )

    # ---- daily increments --------------------------------------------------

    @staticmethod
    def _with_ds(df: DataFrame, time: str) -> DataFrame:
        return df.withColumn("ds", ds_of(F.col(time)))

    @cached_property
    def ods_order(self) -> DataFrame:
        """Every 20th order also has the version it was created with."""
        fields = "'user_id', user_id, 'shop_id', shop_id"
        rest = "'order_amount', order_amount, 'create_time', create_time"
        now = F.expr(
            f"named_struct({fields}, 'order_status', order_status, {rest}, "
            "'update_time', update_time)"
        )
        first = F.expr(
            f"if(order_id % 20 = 3, named_struct({fields}, 'order_status', 'CREATED', "
            f"{rest}, 'update_time', create_time), null)"
        )
        return self._with_ds(_versions(self.order_info, [now, first], "order_id"), "create_time")

    @cached_property
    def ods_detail(self) -> DataFrame:
        return self._with_ds(self._detail_rows, "create_time")

    @cached_property
    def ods_detail_by_id(self) -> DataFrame:
        """The same rows as ``ods_detail``, hashed by line id for the dedup."""
        return self._with_ds(self._dealt_details, "create_time")

    @cached_property
    def ods_payment(self) -> DataFrame:
        return self._with_ds(self._payment_rows(with_history=True), "payment_time")

    @cached_property
    def ods_behavior(self) -> DataFrame:
        """Every 17th event is repeated one second later with an unknown type."""
        same = "'event_id', event_id, 'session_id', session_id, 'user_id', user_id, 'sku_id', sku_id"
        good = F.expr(
            f"named_struct({same}, 'event_type', event_type, 'event_time', event_time)"
        )
        bad = F.expr(
            f"if(event_id % 17 = 3, named_struct({same}, 'event_type', 'error', "
            "'event_time', event_time + interval 1 second), null)"
        )
        return self._with_ds(_versions(self.user_behavior, [good, bad]), "event_time")

    @cached_property
    def ods_rating(self) -> DataFrame:
        """Every 5th rated order was rated once before, one hour earlier, with 1."""
        same = "'order_id', order_id, 'shop_id', shop_id"
        last = F.expr(
            f"named_struct('rating_id', rating_id, {same}, 'shop_score', shop_score, "
            "'rating_time', rating_time)"
        )
        first = F.expr(
            f"if(order_id % 15 = 6, named_struct('rating_id', -rating_id, {same}, "
            "'shop_score', cast(1 as tinyint), "
            "'rating_time', rating_time - interval 1 hour), null)"
        )
        return self._with_ds(_versions(self.rating_info, [last, first]), "rating_time")

    # ---- audit variants ----------------------------------------------------

    @cached_property
    def audit_sku(self) -> DataFrame:
        return self.sku_info.withColumn(
            "shop_id", F.expr("if(sku_id % 229 = 0, -99, shop_id)")
        )

    @cached_property
    def audit_order(self) -> DataFrame:
        """Unknown shops and statuses, a negative amount, a change before creation."""
        return self.order_info.withColumns(
            {
                "shop_id": F.expr("if(order_id % 227 = 0, -99, shop_id)"),
                "order_status": F.expr("if(order_id % 241 = 0, 'LOST', order_status)"),
                "order_amount": F.expr(
                    "if(order_id % 251 = 1, cast(-1 as decimal(20,2)), order_amount)"
                ),
                "update_time": F.expr(
                    "if(order_id % 257 = 2, create_time - interval 1 second, update_time)"
                ),
            }
        )

    @cached_property
    def audit_detail(self) -> DataFrame:
        """Orphans by order and by SKU, and a line sold above its list price."""
        return self.order_detail.withColumns(
            {
                "final_amount": F.expr(
                    "if(order_id % 331 = 2, original_amount + 1.00, final_amount)"
                ).cast("decimal(20,2)"),
                "order_id": F.expr("if(order_id % 223 = 1, -order_id, order_id)"),
                "sku_id": F.expr("if(order_detail_id % 239 = 0, -1, sku_id)"),
            }
        )

    @cached_property
    def audit_payment(self) -> DataFrame:
        return self.payment_info.withColumn(
            "order_id", F.expr("if(order_id % 233 = 1, -order_id, order_id)")
        )

    @cached_property
    def audit_behavior(self) -> DataFrame:
        return self.user_behavior.withColumn(
            "sku_id", F.expr("if(event_id % 211 = 0, -1, sku_id)")
        )

    @cached_property
    def unpaid_orders(self) -> DataFrame:
        """Orders without payment; some stand for a burst of six, 8 s apart."""
        burst = "sequence(0, if(order_id % 25 = 3, 5, 0))"
        return (
            self._order_head.where("order_status <> 'PAID'")
            .withColumn("_n", F.explode(F.expr(burst)))
            .select(
                F.expr("order_id * 10 + _n").alias("order_id"),
                "user_id",
                _plus_seconds("create_time", "_n * 8").alias("create_time"),
            )
        )

    @cached_property
    def failed_payments(self) -> DataFrame:
        """Failed attempts; some stand for three, 50 s apart."""
        burst = "sequence(0, if(order_id % 200 = 0, 2, 0))"
        return (
            self.payment_info.where("payment_status = 'FAILED'")
            .withColumn("_n", F.explode(F.expr(burst)))
            .select(
                F.expr("payment_id * 10 + _n").alias("payment_id"),
                "user_id",
                _plus_seconds("payment_time", "_n * 50").alias("payment_time"),
            )
        )
