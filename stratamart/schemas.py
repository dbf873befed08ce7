"""Declared tables: columns, keys and layout.

Column names, types and order are fixed values: they are the contract of the
stored tables, and writes go by position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    key: tuple[str, ...]
    partitioned: bool = True

    @property
    def schema(self) -> StructType:
        """Data columns, without the partition column (needs a running session)."""
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [column.split()[0] for column in self.ddl.split(", ")]

    @property
    def stored_schema(self) -> StructType:
        return self.schema.add("ds", "string") if self.partitioned else self.schema


_ALL = (
    # daily increments
    Table(
        "ods.ods_order_info_di",
        "order_id bigint, user_id bigint, shop_id bigint, order_status string, "
        "order_amount decimal(20,2), create_time timestamp, update_time timestamp",
        ("order_id",),
    ),
    Table(
        "ods.ods_order_detail_di",
        "order_detail_id bigint, order_id bigint, sku_id bigint, sku_num int, "
        "original_amount decimal(20,2), final_amount decimal(20,2), create_time timestamp",
        ("order_detail_id",),
    ),
    Table(
        "ods.ods_payment_info_di",
        "payment_id bigint, order_id bigint, user_id bigint, payment_type string, "
        "payment_status string, payment_amount decimal(20,2), payment_time timestamp, "
        "create_time timestamp",
        ("payment_id",),
    ),
    Table(
        "ods.ods_user_behavior_di",
        "event_id bigint, session_id string, user_id bigint, sku_id bigint, "
        "event_type string, event_time timestamp",
        ("event_id",),
    ),
    Table(
        "ods.ods_rating_info_di",
        "rating_id bigint, order_id bigint, shop_id bigint, shop_score tinyint, "
        "rating_time timestamp",
        ("rating_id",),
    ),
    # dimensions
    Table(
        "cdm.dim_shop_df",
        "shop_id bigint, shop_name string, province_name string, open_time timestamp, "
        "status tinyint",
        ("shop_id",),
        partitioned=False,
    ),
    Table(
        "cdm.dim_sku_df",
        "sku_id bigint, sku_name string, category_id bigint, category_name string, "
        "shop_id bigint, shop_name string, province_name string, price decimal(20,2), "
        "status tinyint",
        ("sku_id",),
        partitioned=False,
    ),
    # detail snapshots
    Table(
        "cdm.dwd_trd_pay_dtl_df",
        "order_detail_id bigint, order_id bigint, payment_id bigint, user_id bigint, "
        "shop_id bigint, shop_name string, sku_id bigint, sku_name string, "
        "category_id bigint, category_name string, sku_num int, "
        "original_amount decimal(20,2), final_amount decimal(20,2), "
        "order_amount decimal(20,2), payment_amount decimal(20,2), "
        "create_time timestamp, payment_time timestamp, order_date date, payment_date date",
        ("order_detail_id",),
    ),
    Table(
        "cdm.dwd_user_behavior_df",
        "event_id bigint, session_id string, user_id bigint, event_type string, "
        "sku_id bigint, sku_name string, category_id bigint, category_name string, "
        "shop_id bigint, shop_name string, event_time timestamp, event_date date",
        ("event_id",),
    ),
    Table(
        "cdm.dwd_shop_rating_df",
        "rating_id bigint, order_id bigint, shop_id bigint, shop_name string, "
        "shop_score tinyint, score_level string, rating_time timestamp, rating_date date",
        ("order_id",),
    ),
    # period aggregates
    Table(
        "cdm.dws_site_stats_df",
        "stat_period string, pv_count bigint, uv_count bigint, favorite_count bigint, "
        "cart_count bigint, order_count bigint, paid_order_count bigint, "
        "paid_user_count bigint, paid_sku_num bigint, gmv decimal(20,2)",
        ("stat_period",),
    ),
    Table(
        "cdm.dws_sku_trade_df",
        "stat_period string, sku_id bigint, sku_name string, category_id bigint, "
        "category_name string, shop_id bigint, shop_name string, pv_count bigint, "
        "visitor_count bigint, cart_user_count bigint, paid_order_count bigint, "
        "paid_user_count bigint, paid_sku_num bigint, gmv decimal(20,2)",
        ("stat_period", "sku_id"),
    ),
    Table(
        "cdm.dws_shop_rating_df",
        "stat_period string, shop_id bigint, shop_name string, rating_count bigint, "
        "score_sum bigint, good_count bigint, mid_count bigint, bad_count bigint",
        ("stat_period", "shop_id"),
    ),
    # result sets
    Table(
        "ads.ads_biz_overview_df",
        "stat_period string, pv_count bigint, uv_count bigint, favorite_count bigint, "
        "cart_count bigint, order_count bigint, paid_order_count bigint, "
        "paid_user_count bigint, paid_sku_num bigint, gmv decimal(20,2), "
        "avg_order_amount decimal(20,2), view_to_pay_rate decimal(10,6)",
        ("stat_period",),
    ),
    Table(
        "ads.ads_sku_topn_df",
        "stat_period string, rank_type string, rank_no int, sku_id bigint, "
        "sku_name string, category_id bigint, category_name string, shop_id bigint, "
        "shop_name string, pv_count bigint, visitor_count bigint, "
        "cart_user_count bigint, paid_order_count bigint, paid_user_count bigint, "
        "paid_sku_num bigint, gmv decimal(20,2)",
        ("stat_period", "rank_type", "rank_no"),
    ),
    Table(
        "ads.ads_shop_rating_df",
        "stat_period string, shop_id bigint, shop_name string, rating_count bigint, "
        "avg_score decimal(10,6), good_count bigint, mid_count bigint, bad_count bigint, "
        "good_rate decimal(10,6), bad_rate decimal(10,6), "
        "wilson_good_rate decimal(10,6), risk_flag boolean",
        ("stat_period", "shop_id"),
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in _ALL}


def columns_of(name: str) -> list[str]:
    return TABLES[name].columns
