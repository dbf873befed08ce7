"""Result sets: overview, SKU ranking, shop rating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..operators.ranking import top_n_by_metrics
from ..schemas import columns_of


def overview(site: DataFrame) -> DataFrame:
    return site.withColumns(
        {
            "avg_order_amount": m.average_order_amount(
                F.col("gmv"), F.col("paid_order_count")
            ),
            "view_to_pay_rate": m.view_to_pay_rate(
                F.col("paid_user_count"), F.col("uv_count")
            ),
        }
    ).select(*columns_of("ads.ads_biz_overview_df"))


def sku_topn(sku: DataFrame, n: int = m.TOP_N) -> DataFrame:
    """First ``n`` SKUs per period by GMV, items and orders.

    A SKU without sales is not excluded: it may fill the last ranks.
    """
    ranked = top_n_by_metrics(sku, "stat_period", m.RANK_TYPES, "sku_id", n)
    return ranked.withColumn("rank_no", F.col("rank_no").cast("int")).select(
        *columns_of("ads.ads_sku_topn_df")
    )


def shop_rating(shop: DataFrame) -> DataFrame:
    n, good, bad = F.col("rating_count"), F.col("good_count"), F.col("bad_count")
    return (
        shop.where(n > 0)
        .withColumns(
            {
                "avg_score": m.average_score(F.col("score_sum"), n),
                "good_rate": m.share(good, n),
                "bad_rate": m.share(bad, n),
                "wilson_good_rate": m.wilson_lower_bound(good, n),
                "risk_flag": m.risk_flag(bad, n),
            }
        )
        .select(*columns_of("ads.ads_shop_rating_df"))
    )
