"""Comparing two datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Values on one side only, marked ``missing`` or ``unexpected``.

    Empty exactly when both sides hold the same set. One grouped pass over the
    union: it combines on the map side and needs no join.
    """
    columns = expected.columns
    marked = expected.select(*columns, F.lit(1).alias("_e"), F.lit(0).alias("_a")).union(
        actual.select(*columns, F.lit(0).alias("_e"), F.lit(1).alias("_a"))
    )
    return (
        marked.groupBy(*columns)
        .agg(F.max("_e").alias("_e"), F.max("_a").alias("_a"))
        .where(F.col("_e") != F.col("_a"))
        .select(
            *columns,
            F.when(F.col("_e") == 1, "missing").otherwise("unexpected").alias("side"),
        )
    )


def reconcile(source: DataFrame, target: DataFrame, by: str) -> DataFrame:
    """Row counts per ``by`` value on both sides and whether they agree."""
    both = source.select(by, F.lit(1).alias("_s"), F.lit(0).alias("_t")).union(
        target.select(by, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    return (
        both.groupBy(by)
        .agg(F.sum("_s").alias("source_rows"), F.sum("_t").alias("target_rows"))
        .withColumn("is_equal", F.col("source_rows") == F.col("target_rows"))
    )
