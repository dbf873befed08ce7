"""A third of all rows on one key: results stay whole, work stays spread."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import facts as f
from stratamart.operators import audits
from stratamart.operators.skew import hot_keys, salted_join
from stratamart.plans import dwd, dws

N = 30_000


@pytest.fixture()
def many(spark):
    """A third of the rows belong to key 0."""
    return spark.range(N).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
    )


def test_salted_join_equals_a_plain_join(spark, many):
    one = many.select("k").distinct().withColumn("v", F.col("k") * 2)
    counts = many.groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counts, "k", "n", 500)
    assert [tuple(r) for r in hot.collect()] == [(0, 20)]
    salted = salted_join(many, one.join(hot, "k", "left"), "k", hot, "row_id")
    plain = many.join(one, "k")
    assert salted.count() == plain.count() == N
    assert salted.select("row_id", "k", "v").exceptAll(plain.select("row_id", "k", "v")).isEmpty()


def test_hot_rows_are_spread_over_their_salts(spark, many):
    counts = many.groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counts, "k", "n", 500)
    marked = many.join(F.broadcast(hot), "k")
    sizes = [r["count"] for r in marked.groupBy(
        F.pmod(F.xxhash64("row_id"), F.col("_salts"))).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 700


def test_one_order_with_a_third_of_all_lines(spark):
    base = spark.range(3_000)
    orders = base.select(
        F.col("id").alias("order_id"), F.lit(7).cast("bigint").alias("user_id"),
        F.lit(3).cast("bigint").alias("shop_id"), F.lit("PAID").alias("order_status"),
        F.when(F.col("id") == 0, 1_501).otherwise(1).cast("decimal(20,2)").alias("order_amount"),
        F.lit(f.NOON).cast("timestamp_ntz").alias("create_time"),
        F.lit(f.NOON).cast("timestamp_ntz").alias("update_time"), F.lit(f.DS).alias("ds"))
    details = spark.range(4_500).select(
        F.col("id").alias("order_detail_id"),
        F.when(F.col("id") >= 3_000, 0).otherwise(F.col("id")).alias("order_id"),
        F.lit(5).cast("bigint").alias("sku_id"), F.lit(1).alias("sku_num"),
        F.lit(1).cast("decimal(20,2)").alias("original_amount"),
        F.lit(1).cast("decimal(20,2)").alias("final_amount"),
        F.lit(f.NOON).cast("timestamp_ntz").alias("create_time"), F.lit(f.DS).alias("ds"))
    payments = orders.select(
        (F.col("order_id") + 9_000).alias("payment_id"), "order_id", "user_id",
        F.lit("SUCCESS").alias("payment_status"), F.col("order_amount").alias("payment_amount"),
        F.col("create_time").alias("payment_time"), "create_time", "ds")
    sku = spark.createDataFrame(f.SKUS, f.SKU)
    lines = dwd.trade(orders, details, payments, sku, f.DS, rows_per_task=100)
    assert lines.count() == 4_500
    assert lines.where("order_id = 0").count() == 1_501
    row = dws.site_stats(
        spark.createDataFrame([], "event_id bigint, user_id bigint, event_type string, "
                                  "event_date date"), lines, orders, f.DS
    ).where("stat_period = '1d'").first()
    assert (row.paid_order_count, row.paid_sku_num, row.gmv) == (3_000, 4_500, 4_500)


def test_popular_sku_through_a_large_dimension(spark):
    """Shuffled join: same rows as the broadcast one, and AQE splits the popular SKU."""
    events = spark.range(120_000).select(
        F.col("id").alias("event_id"), F.lit("s").alias("session_id"),
        (F.col("id") % 7).alias("user_id"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 9).cast("bigint").alias("sku_id"),
        F.lit("view").alias("event_type"),
        F.lit(str(f.NOON)).cast("timestamp_ntz").alias("event_time"), F.lit(f.DS).alias("ds"))
    sku = spark.createDataFrame(f.SKUS, f.SKU)
    plain = dwd.behavior(events, sku, f.DS).collect()
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "2k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        joined = dwd.behavior(events.repartition(8), sku, f.DS)
        shuffled = joined.collect()
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert sorted(shuffled) == sorted(plain) and len(plain) == 66_666
    assert "skew=true" in text


def test_many_copies_of_one_line(spark):
    copies = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("order_detail_id"),
        F.lit(1).cast("bigint").alias("order_id"), F.lit(5).cast("bigint").alias("sku_id"),
        F.lit(1).alias("sku_num"), F.lit(1).cast("decimal(20,2)").alias("original_amount"),
        F.col("id").cast("decimal(20,2)").alias("final_amount"),
        F.lit(f.NOON).cast("timestamp_ntz").alias("create_time"), F.lit(f.DS).alias("ds"))
    got = dwd.latest_details(copies, f.DS)
    assert got.count() == 6_001
    assert got.where("order_detail_id = 0").first().final_amount == 8_997


def test_burst_of_one_user_with_equal_times(spark):
    """All rows of one user at two instants: one group is two rows after counting."""
    rows = spark.range(6_000).select(
        F.lit(1).alias("user_id"),
        F.when(F.col("id") % 2 == 0, F.lit(str(f.NOON)))
        .otherwise(F.lit("2026-08-25 12:01:00")).cast("timestamp_ntz").alias("t"))
    got = {r.t: r.events for r in audits.bursts(rows, "user_id", "t", 60, 6).collect()}
    assert got == {f.NOON: 3_000, f.NOON + dt.timedelta(seconds=60): 6_000}
