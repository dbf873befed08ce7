"""Dimension layer: frozen shop and SKU tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import money
from ..schemas import columns_of


def shops(shop_info: DataFrame) -> DataFrame:
    return shop_info.select(*columns_of("cdm.dim_shop_df"))


def skus(sku_info: DataFrame, shop_info: DataFrame) -> DataFrame:
    """SKUs with the name and province of their shop; SKUs of unknown shops go.

    No join hint: the shop table is broadcast only while its measured size is
    below the session threshold, and joined by shuffle beyond it.
    """
    places = shop_info.select("shop_id", "shop_name", "province_name")
    return (
        sku_info.withColumn("price", money(F.col("price")))
        .join(places, "shop_id")
        .select(*columns_of("cdm.dim_sku_df"))
    )
