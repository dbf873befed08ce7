"""Time the headline queries and the daily jobs, and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.

* A query runs its whole plan from the parquet files into Spark's noop sink.
* A ``job_*`` entry is what production runs per day: it reads stored layers,
  builds one dataset, checks it and replaces one partition. ``job_increments``
  stores the five increment histories the other jobs read.

One query runs once before, so that JVM start-up is not counted.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from stratamart import jobs
from stratamart.queries import CUTOFF, Layers, queries
from stratamart.schemas import TABLES
from stratamart.session import PROFILE
from stratamart.sources.tables import create_all

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "dim_sku",
    "dwd_trade",
    "dwd_behavior",
    "dwd_rating",
    "dws_site",
    "dws_sku",
    "dws_shop_rating",
    "ads_overview",
    "ads_sku_topn",
    "ads_shop_rating",
    "status_vs_payment",
    "burst_failed",
    "event_envelope",
    "event_disorder",
)
INCREMENTS = {
    "ods.ods_order_info_di": "ods_order",
    "ods.ods_order_detail_di": "ods_detail",
    "ods.ods_payment_info_di": "ods_payment",
    "ods.ods_user_behavior_di": "ods_behavior",
    "ods.ods_rating_info_di": "ods_rating",
}


def start(scratch: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    for key, value in PROFILE.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/catalog")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def store_increments(spark: SparkSession, layers: Layers) -> None:
    for table, view in INCREMENTS.items():
        rows = getattr(layers.src, view).select(*TABLES[table].columns, "ds")
        rows.repartition("ds").write.insertInto(table, overwrite=True)


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = start(scratch)
    seconds: dict[str, float] = {}

    def clock(name: str, action) -> None:
        started = time.perf_counter()
        with contextlib.redirect_stdout(io.StringIO()):
            action()
        seconds[name] = round(time.perf_counter() - started, 3)

    def run(name: str) -> None:
        queries()[name](spark, FOLDER).write.format("noop").mode("overwrite").save()

    run("dwd_trade")
    for name in HEADLINE:
        clock(name, lambda: run(name))

    create_all(spark, f"{scratch}/tables")
    layers = Layers(spark, FOLDER)
    clock("job_dimensions", lambda: jobs.load_dimensions(spark, lambda t: getattr(layers.src, t)))
    clock("job_increments", lambda: store_increments(spark, layers))
    for name, job in jobs.LAYER_JOBS.items():
        clock(f"job_{name}", lambda: job(spark, CUTOFF))

    print(
        json.dumps(
            {
                "metric": "headline_queries_and_daily_jobs_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
