"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The newest row of each key.

    ``rank = 1`` lets Spark plan a WindowGroupLimit below the shuffle: every
    map task already keeps one row per key, so a key that holds a large share
    of the input sends at most one row per map task. ``tie_break`` columns make
    the order total, so a rerun or a retried task picks the same row.
    """
    order = [F.col(c).desc() for c in (*newest_first, *tie_break)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def only_member(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Rows whose key occurs exactly once.

    Written as an aggregate (count and max of each value, kept where the count
    is one) rather than a whole-group window, because it combines on the map
    side: a hot key shrinks to one row per task before the shuffle.
    """
    grouped = df.groupBy(key).agg(
        F.count("*").alias("_members"), *[F.max(v).alias(v) for v in values]
    )
    return grouped.where(F.col("_members") == 1).drop("_members")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their ``row_count``."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") > 1)
    )
