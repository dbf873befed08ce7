"""Top-N per group over several metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_by_metrics(
    df: DataFrame, group: str, metrics: Sequence[str], tie: str, n: int
) -> DataFrame:
    """Rank the rows of each group once per metric and keep the first ``n``.

    One scan serves all metrics: each row is repeated per metric and ranked by
    (group, rank_type). WindowGroupLimit keeps ``n`` rows per group in every
    map task before the shuffle, so only n x groups x tasks rows move although
    there are just a dozen groups. Ties go to the smaller ``tie`` value.
    """
    choices = F.array(
        *[
            F.struct(F.lit(m).alias("rank_type"), F.col(m).cast("decimal(24,2)").alias("_v"))
            for m in metrics
        ]
    )
    ranked = df.select("*", F.inline(choices)).withColumn(
        "rank_no",
        F.row_number().over(
            Window.partitionBy(group, "rank_type").orderBy(F.desc("_v"), F.asc(tie))
        ),
    )
    return ranked.where(F.col("rank_no") <= n).drop("_v")
