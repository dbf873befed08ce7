"""The rules each stored or published dataset must satisfy."""

from __future__ import annotations

from ..functions.metrics import RANK_TYPES, TOP_N
from ..operators.periods import PERIODS
from ..operators.quality import Contract
from ..schemas import columns_of


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_BAD_PERIOD = f"stat_period not in {_in(PERIODS)}"
_BAD_RANK = f"rank_no < 1 or rank_no > {TOP_N}"
_BAD_RANK_TYPE = f"rank_type not in {_in(RANK_TYPES)}"
_BAD_DS = "not ds rlike '^[0-9]{8}$'"


def _negative(*columns: str) -> str:
    return " or ".join(f"{c} < 0" for c in columns)


def _off_unit(*columns: str) -> str:
    return " or ".join(f"{c} < 0 or {c} > 1" for c in columns)


# ---- stored layers ---------------------------------------------------------

TRADE = Contract(
    "cdm.dwd_trd_pay_dtl_df",
    key=("order_detail_id",),
    required=tuple(columns_of("cdm.dwd_trd_pay_dtl_df")),
    columns=tuple(columns_of("cdm.dwd_trd_pay_dtl_df")),
    forbidden={
        "bad_quantity": "sku_num <= 0",
        "bad_amount": _negative("original_amount", "final_amount", "order_amount")
        + " or payment_amount <= 0",
    },
)

BEHAVIOR = Contract(
    "cdm.dwd_user_behavior_df",
    key=("event_id",),
    required=tuple(
        c for c in columns_of("cdm.dwd_user_behavior_df") if c != "event_type"
    ),
)

RATING = Contract(
    "cdm.dwd_shop_rating_df",
    key=("order_id",),
    required=tuple(columns_of("cdm.dwd_shop_rating_df")),
)

SITE = Contract(
    "cdm.dws_site_stats_df",
    key=("stat_period",),
    rows=len(PERIODS),
    forbidden={
        "unknown_period": _BAD_PERIOD,
        "negative": _negative(
            "pv_count", "uv_count", "favorite_count", "cart_count", "order_count",
            "paid_order_count", "paid_user_count", "paid_sku_num", "gmv",
        ),
    },
)

SKU = Contract(
    "cdm.dws_sku_trade_df",
    key=("stat_period", "sku_id"),
    forbidden={
        "negative": _negative(
            "pv_count", "visitor_count", "cart_user_count", "paid_order_count",
            "paid_user_count", "paid_sku_num", "gmv",
        )
    },
)

SHOP_RATING = Contract(
    "cdm.dws_shop_rating_df",
    key=("stat_period", "shop_id"),
    forbidden={
        "negative": _negative(
            "rating_count", "score_sum", "good_count", "mid_count", "bad_count"
        ),
        "counts_differ": "rating_count <> good_count + mid_count + bad_count",
    },
)

ADS_OVERVIEW = Contract(
    "ads.ads_biz_overview_df",
    key=("stat_period",),
    rows=len(PERIODS),
    forbidden={
        "unknown_period": _BAD_PERIOD,
        "negative": _negative("avg_order_amount", "view_to_pay_rate"),
    },
)

ADS_TOPN = Contract(
    "ads.ads_sku_topn_df",
    key=("stat_period", "rank_type", "rank_no"),
    forbidden={"unknown_rank_type": _BAD_RANK_TYPE, "bad_rank": _BAD_RANK},
)

ADS_RATING = Contract(
    "ads.ads_shop_rating_df",
    key=("stat_period", "shop_id"),
    forbidden={
        "bad_score": "avg_score < 0",
        "bad_rate": _off_unit("good_rate", "bad_rate", "wilson_good_rate"),
    },
)

# ---- published results -----------------------------------------------------

PUBLISHED_COLUMNS = {
    "ads.ads_biz_overview_df": ["ds", *columns_of("ads.ads_biz_overview_df")],
    "ads.ads_sku_topn_df": [
        "ds", "stat_period", "rank_type", "rank_no", "sku_id", "sku_name",
        "category_id", "category_name", "shop_id", "shop_name", "paid_order_count",
        "paid_user_count", "paid_sku_num", "gmv",
    ],
    "ads.ads_shop_rating_df": [
        "ds", "stat_period", "shop_id", "rating_count", "avg_score", "good_count",
        "mid_count", "bad_count", "good_rate", "bad_rate", "wilson_good_rate",
        "risk_flag",
    ],
}

PUBLISH = {
    "ads.ads_biz_overview_df": Contract(
        "published overview",
        key=("ds", "stat_period"),
        required=tuple(PUBLISHED_COLUMNS["ads.ads_biz_overview_df"]),
        rows=len(PERIODS),
        forbidden={
            "bad_ds": _BAD_DS,
            "unknown_period": _BAD_PERIOD,
            "negative_count": _negative(
                "pv_count", "uv_count", "favorite_count", "cart_count", "order_count",
                "paid_order_count", "paid_user_count", "paid_sku_num",
            ),
            "negative_amount": _negative("gmv", "avg_order_amount"),
            "bad_rate": _off_unit("view_to_pay_rate"),
        },
    ),
    "ads.ads_sku_topn_df": Contract(
        "published ranking",
        key=("ds", "stat_period", "rank_type", "rank_no"),
        required=tuple(PUBLISHED_COLUMNS["ads.ads_sku_topn_df"]),
        not_empty=True,
        forbidden={
            "bad_ds": _BAD_DS,
            "unknown_period": _BAD_PERIOD,
            "unknown_rank_type": _BAD_RANK_TYPE,
            "bad_rank": _BAD_RANK,
            "negative": _negative(
                "paid_order_count", "paid_user_count", "paid_sku_num", "gmv"
            ),
        },
    ),
    "ads.ads_shop_rating_df": Contract(
        "published shop rating",
        key=("ds", "stat_period", "shop_id"),
        required=tuple(PUBLISHED_COLUMNS["ads.ads_shop_rating_df"]),
        not_empty=True,
        forbidden={
            "bad_ds": _BAD_DS,
            "unknown_period": _BAD_PERIOD,
            "bad_count": "rating_count < 0 or "
            "rating_count <> good_count + mid_count + bad_count",
            "bad_score": "avg_score < 0 or avg_score > 5",
            "bad_rate": _off_unit("good_rate", "bad_rate", "wilson_good_rate"),
            "bad_flag": "risk_flag not in (0, 1)",
        },
    ),
}

# A SKU may hold only one rank per period and ranking (second unique key).
RANKED_ONCE = Contract(
    "published ranking, one rank per SKU",
    key=("ds", "stat_period", "rank_type", "sku_id"),
)

# ---- source facts ----------------------------------------------------------

ORDER_STATUSES = ("CREATED", "PAID", "CANCELLED")
PAYMENT_STATUSES = ("SUCCESS", "FAILED")
PAYMENT_TYPES = ("ALIPAY", "WECHAT", "CARD")
EVENT_TYPES = ("view", "favorite", "cart")

SOURCE = {
    "shop_info": Contract(
        "shop_info",
        key=("shop_id",),
        not_empty=True,
        forbidden={"bad_status": "status not in (0, 1)"},
    ),
    "sku_info": Contract(
        "sku_info",
        key=("sku_id",),
        not_empty=True,
        forbidden={
            "bad_price": "price < 0",
            "bad_status": "status not in (0, 1)",
            "updated_before_created": "update_time < create_time",
        },
    ),
    "order_info": Contract(
        "order_info",
        key=("order_id",),
        forbidden={
            "unknown_status": f"order_status not in {_in(ORDER_STATUSES)}",
            "bad_amount": "order_amount < 0",
            "updated_before_created": "update_time < create_time",
        },
    ),
    "order_detail": Contract(
        "order_detail",
        key=("order_detail_id",),
        forbidden={
            "bad_quantity": "sku_num <= 0",
            "bad_amount": "original_amount < 0 or final_amount < 0",
            "final_above_original": "final_amount > original_amount",
        },
    ),
    "payment_info": Contract(
        "payment_info",
        key=("payment_id",),
        forbidden={
            "unknown_type": f"payment_type not in {_in(PAYMENT_TYPES)}",
            "unknown_status": f"payment_status not in {_in(PAYMENT_STATUSES)}",
            "bad_amount": "payment_amount < 0 or "
            "(payment_status = 'SUCCESS' and payment_amount <= 0)",
            "recorded_before_paid": "create_time < payment_time",
        },
    ),
    "user_behavior": Contract(
        "user_behavior",
        key=("event_id",),
        forbidden={"unknown_type": f"event_type not in {_in(EVENT_TYPES)}"},
    ),
    "rating_info": Contract(
        "rating_info",
        key=("rating_id",),
        forbidden={"bad_score": "shop_score not between 1 and 5"},
    ),
}

# Dimensions as they are stored.
DIM_SHOP = Contract(
    "cdm.dim_shop_df",
    key=("shop_id",),
    required=("shop_id", "shop_name", "province_name"),
    forbidden={"bad_status": "status not in (0, 1)"},
)
DIM_SKU = Contract(
    "cdm.dim_sku_df",
    key=("sku_id",),
    required=("sku_id", "sku_name", "category_id", "category_name", "shop_id", "price"),
    forbidden={"bad_price": "price < 0", "bad_status": "status not in (0, 1)"},
)
