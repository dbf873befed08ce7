"""Joins planned for co-located and for skewed keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def same(left: Column, right: Column) -> Column:
    """Equality that stays a residual of a join instead of becoming a join key.

    Spark adds every ``a = b`` between the two sides to the join keys, and then
    shuffles both sides again by the longer key list although they are already
    hashed by the shared id. As a range test the condition is only evaluated.
    """
    return left.between(right, right)


def hot_keys(
    counts: DataFrame, key: str, count: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Keys with more rows than one task should take, with their number of salts.

    At most (all rows / rows_per_task) keys can qualify, so the list is small
    by construction: 10^12 rows give at most 10^6 keys of 12 bytes.
    """
    return counts.where(F.col(count) > rows_per_task).select(
        key, F.ceil(F.col(count) / F.lit(rows_per_task)).cast("int").alias("_salts")
    )


def salted_join(
    many: DataFrame, one: DataFrame, key: str, hot: DataFrame, spread_by: str
) -> DataFrame:
    """Inner join ``many`` to ``one`` (unique on ``key``), hot keys spread over tasks.

    ``one`` must carry the ``_salts`` of its key (NULL for ordinary keys). A hot
    key's row is repeated once per salt, and the rows of ``many`` choose a salt
    by hashing ``spread_by``; ordinary keys all use salt 0. The added rows sum
    to at most (all rows / rows_per_task). No row is dropped and no cross
    product is formed. The list of hot keys, small by construction (``hot_keys``),
    is broadcast: left to AQE, ``many`` would be shuffled once before its size is
    known. A session that turns broadcasts off has it joined without, unless it
    turns AQE off too: AQE alone can split the hot keys of that shuffle. Joining
    on (key, salt) shuffles both sides, so AQE's skew join can still split what
    remains uneven.
    """
    conf = many.sparkSession.conf
    off = conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    if not off or conf.get("spark.sql.adaptive.enabled") != "true":
        hot = F.broadcast(hot)
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    spread_one = one.withColumn("_salt", F.explode(salts)).drop("_salts")
    spread_many = (
        many.join(hot, key, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_salts").isNull(), 0).otherwise(
                F.pmod(F.xxhash64(spread_by), F.col("_salts")).cast("int")
            ),
        )
        .drop("_salts")
    )
    return spread_many.join(spread_one, [key, "_salt"]).drop("_salt")
