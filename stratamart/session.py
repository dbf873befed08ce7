"""Session profile shared by all jobs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

BUSINESS_TIME_ZONE = "Asia/Shanghai"

# One profile for every job. Only a starting shuffle width is set; AQE merges
# small partitions towards the advisory size and splits skewed ones.
PROFILE = {
    "spark.sql.session.timeZone": BUSINESS_TIME_ZONE,
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.orc.compression.codec": "snappy",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even if the aggregate above it then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.broadcastTimeout": "300",
    "spark.driver.maxResultSize": "512m",
}


def session(app: str, master: str | None = None, **overrides: str) -> SparkSession:
    """Build a session with the warehouse profile.

    ``SHUFFLE_PARTITIONS`` and ``HIVE_SUPPORT`` come from the environment, so
    the same job runs on one machine and on a large cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(PROFILE)
    if os.environ.get("SHUFFLE_PARTITIONS"):
        settings["spark.sql.shuffle.partitions"] = os.environ["SHUFFLE_PARTITIONS"]
    settings.update(overrides)
    for key, value in settings.items():
        builder = builder.config(key, value)
    if os.environ.get("HIVE_SUPPORT") == "1":
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()
