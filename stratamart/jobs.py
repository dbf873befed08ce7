"""The daily jobs: read layers, build one dataset, check it, replace one day.

Run one with ``python -m stratamart.jobs JOB --ds yyyyMMdd --root FOLDER``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bizdate import parse_ds
from .errors import DataQualityError
from .operators.fingerprint import differences, fingerprint
from .operators.quality import require
from .plans import ads, audit, contracts, dim, dwd, dws
from .plans.ods import INGESTS, one_day
from .schemas import TABLES
from .sinks import states
from .sinks.results import JdbcResultStore, ResultStore, publish
from .sinks.tables import Staged, replace_day, stage, swap, write_partition
from .sources import jdbc
from .sources.tables import create_all, read_partition, require_partition

SourceReader = Callable[[str], DataFrame]


# ---- dimensions and increments ---------------------------------------------

def load_dimensions(spark: SparkSession, read: SourceReader, *, first_load: bool = False) -> None:
    """Replace both dimension tables together; refuses empty sources and broken rules.

    Each source is read once: SKUs take their shop's names from the shops that
    were just written. Rules are checked on what was written, and a broken one
    leaves both tables as they were. ``first_load`` also refuses when any increment is stored already.
    """
    if first_load:
        require_no_facts({i.target: spark.table(i.target) for i in INGESTS})
    staged: list[Staged] = []
    try:
        staged.append(stage(dim.shops(read("shop_info")), "cdm.dim_shop_df"))
        staged.append(stage(dim.skus(read("sku_info"), staged[0].rows), "cdm.dim_sku_df"))
        for one, contract in zip(staged, (contracts.DIM_SHOP, contracts.DIM_SKU), strict=True):
            if not require(one.rows, contract):
                raise DataQualityError(f"{contract.name} is empty")
        swap(staged)
    except BaseException:
        for one in staged:
            one.drop()
        raise


def require_no_facts(facts: dict[str, DataFrame]) -> None:
    """Guard for a first dimension load: dimensions are frozen once facts exist."""
    filled = [name for name, df in facts.items() if not df.isEmpty()]
    if filled:
        raise DataQualityError(f"dimensions are frozen, facts exist in {filled}")


def load_day(
    spark: SparkSession,
    read: SourceReader,
    ds: str,
    *,
    audited: bool = False,
    announced: dict[tuple[str, str], DataFrame] | None = None,
) -> dict[str, int]:
    """Replace one day of all five increments and reconcile the row counts.

    The source is read once, into versions that nobody sees yet. A reader that
    can tell the ``fingerprint`` of a table (rows and hash sums per hour, computed
    at the source) is held to it: rows lost, doubled or changed on the way leave
    every table as it was. With ``audited``, the rules of single rows are counted while these are written,
    the rules between facts on what was written, and a broken rule leaves every
    table as it was. What was read is compared with what the table holds
    afterwards.
    """
    by_target = {i.target: i.source for i in INGESTS}
    measures = {t: audit.row_measures(s, F.lit(ds)) for t, s in by_target.items()} if audited else None

    def check(staged: dict[str, DataFrame], seen: dict[str, dict]) -> None:
        if audited:
            facts = {by_target[t]: rows for t, rows in staged.items()}
            _audit(spark, facts, {by_target[t]: found for t, found in seen.items()}, announced)
        _reconcile(read, staged)
        for table in by_target:  # before the swap: a state must not outlive what it has read
            states.forget(spark, table, ds)

    read_rows = replace_day(
        {i.target: one_day(read(i.source), i, ds) for i in INGESTS}, ds, measures, check
    )
    for table, rows in read_rows.items():
        stored = read_partition(spark, table, ds).count()
        if rows != stored:
            raise DataQualityError(f"{table} ds={ds}: read {rows}, stored {stored}")
    return read_rows


def _reconcile(read: SourceReader, staged: dict[str, DataFrame]) -> None:
    """Compare what was written with the source's own fingerprints, where it gives them."""
    told = getattr(read, "fingerprint", None)
    if told is None:
        return
    broken = []
    for ingest in INGESTS:
        rows = staged[ingest.target]
        here = fingerprint(rows, TABLES[ingest.target].schema, [F.hour(ingest.time_column).alias("hour")])
        wrong = differences(told(ingest.source), here, ["hour"]).where(~F.col("is_equal"))
        broken += [  # at most 24 rows
            f"{ingest.source} hour {r.hour}: {r.source_row_count} rows at the source, {r.target_row_count} here"
            for r in wrong.orderBy("hour").collect()
        ]
    if broken:
        raise DataQualityError("source and copy differ: " + "; ".join(broken))


def _audit(
    spark: SparkSession,
    facts: dict[str, DataFrame],
    seen: dict[str, dict],
    announced: dict[tuple[str, str], DataFrame] | None,
) -> dict[tuple[str, str], int]:
    facts = facts | {"shop_info": spark.table("cdm.dim_shop_df"), "sku_info": spark.table("cdm.dim_sku_df")}
    counts = {(fact, rule): n for fact, found in seen.items() for rule, n in found.items() if rule != "row_count"}
    # A few dozen rows: one per rule.
    counts |= {(r.fact, r.rule): r.rows for r in audit.cross_report(facts).collect()}
    audit.gate(counts, facts, announced)
    return counts


def audit_day(
    spark: SparkSession, ds: str, announced: dict[tuple[str, str], DataFrame] | None = None
) -> dict[tuple[str, str], int]:
    """Audit one stored day of all five facts; raises if a rule is broken."""
    _needs(spark, ds, *[i.target for i in INGESTS])
    facts = {i.source: read_partition(spark, i.target, ds) for i in INGESTS}
    seen = {
        name: rows.agg(*audit.row_measures(name, F.lit(ds))).first().asDict() for name, rows in facts.items()
    }
    return _audit(spark, facts, seen, announced)


# ---- snapshots, aggregates, results ----------------------------------------

def _needs(spark: SparkSession, ds: str, *tables: str) -> None:
    for table in tables:
        require_partition(spark, table, ds)


def trade(spark: SparkSession, ds: str) -> int:
    sources = ("ods.ods_order_info_di", "ods.ods_order_detail_di", "ods.ods_payment_info_di")
    _needs(spark, ds, *sources)
    orders, details, payments = (
        states.newest(spark, s, ds) for s in (states.ORDERS, states.DETAILS, states.PAYMENTS)
    )
    lines = dwd.trade_of(orders, details, payments, spark.table("cdm.dim_sku_df"))
    rows = write_partition(lines, "cdm.dwd_trd_pay_dtl_df", ds, contracts.TRADE)
    written = read_partition(spark, "cdm.dwd_trd_pay_dtl_df", ds)
    candidates = states.newest(spark, states.CANDIDATES, ds).agg(F.count("order_id").alias("order_count"))
    print(dwd.cleaning_summary_of(candidates, written).first().asDict())
    return rows


def behavior(spark: SparkSession, ds: str) -> int:
    _needs(spark, ds, "ods.ods_user_behavior_di")
    events = states.newest(spark, states.EVENTS, ds)
    rows = dwd.behavior_of(events, spark.table("cdm.dim_sku_df"))
    return write_partition(rows, "cdm.dwd_user_behavior_df", ds, contracts.BEHAVIOR)


def rating(spark: SparkSession, ds: str) -> int:
    _needs(spark, ds, "ods.ods_rating_info_di", "cdm.dwd_trd_pay_dtl_df")
    ratings = states.newest(spark, states.RATINGS, ds)
    lines = read_partition(spark, "cdm.dwd_trd_pay_dtl_df", ds)
    rows = dwd.rating_of(ratings, lines)
    return write_partition(rows, "cdm.dwd_shop_rating_df", ds, contracts.RATING)


def site(spark: SparkSession, ds: str) -> int:
    _needs(spark, ds, "cdm.dwd_user_behavior_df", "cdm.dwd_trd_pay_dtl_df",
           "ods.ods_order_info_di")
    rows = dws.site_stats_of(
        read_partition(spark, "cdm.dwd_user_behavior_df", ds),
        read_partition(spark, "cdm.dwd_trd_pay_dtl_df", ds),
        states.newest(spark, states.ORDERS, ds),
        ds,
    )
    return write_partition(rows, "cdm.dws_site_stats_df", ds, contracts.SITE)


def sku(spark: SparkSession, ds: str) -> int:
    _needs(spark, ds, "cdm.dwd_user_behavior_df", "cdm.dwd_trd_pay_dtl_df")
    rows = dws.sku_trade(
        read_partition(spark, "cdm.dwd_user_behavior_df", ds),
        read_partition(spark, "cdm.dwd_trd_pay_dtl_df", ds),
        ds,
    )
    return write_partition(rows, "cdm.dws_sku_trade_df", ds, contracts.SKU)


def shop(spark: SparkSession, ds: str) -> int:
    _needs(spark, ds, "cdm.dwd_shop_rating_df")
    rows = dws.shop_rating(read_partition(spark, "cdm.dwd_shop_rating_df", ds), ds)
    return write_partition(rows, "cdm.dws_shop_rating_df", ds, contracts.SHOP_RATING)


def ads_overview(spark: SparkSession, ds: str) -> int:
    _needs(spark, ds, "cdm.dws_site_stats_df")
    rows = ads.overview(read_partition(spark, "cdm.dws_site_stats_df", ds))
    return write_partition(rows, "ads.ads_biz_overview_df", ds, contracts.ADS_OVERVIEW)


def ads_topn(spark: SparkSession, ds: str) -> int:
    _needs(spark, ds, "cdm.dws_sku_trade_df")
    rows = ads.sku_topn(read_partition(spark, "cdm.dws_sku_trade_df", ds))
    return write_partition(rows, "ads.ads_sku_topn_df", ds, contracts.ADS_TOPN)


def ads_rating(spark: SparkSession, ds: str) -> int:
    _needs(spark, ds, "cdm.dws_shop_rating_df")
    rows = ads.shop_rating(read_partition(spark, "cdm.dws_shop_rating_df", ds))
    return write_partition(rows, "ads.ads_shop_rating_df", ds, contracts.ADS_RATING)


# Each job after the ones it reads from.
LAYER_JOBS: dict[str, Callable[[SparkSession, str], int]] = {
    "trade": trade,
    "behavior": behavior,
    "rating": rating,
    "site": site,
    "sku": sku,
    "shop": shop,
    "ads_overview": ads_overview,
    "ads_topn": ads_topn,
    "ads_rating": ads_rating,
}

PUBLISH_JOBS = {
    "publish_overview": "ads.ads_biz_overview_df",
    "publish_topn": "ads.ads_sku_topn_df",
    "publish_rating": "ads.ads_shop_rating_df",
}


def publish_result(spark: SparkSession, ds: str, table: str, store: ResultStore) -> int:
    parse_ds(ds)
    return publish(read_partition(spark, table, ds), table, ds, store)


def run_layers(spark: SparkSession, ds: str) -> dict[str, int]:
    """All layer jobs of one day, from stored increments to result sets."""
    parse_ds(ds)
    return {name: job(spark, ds) for name, job in LAYER_JOBS.items()}


def main(argv: list[str] | None = None) -> None:
    from .session import session

    names = ["dimensions", "increments", "audit", *LAYER_JOBS, *PUBLISH_JOBS, "layers"]
    parser = argparse.ArgumentParser(prog="stratamart.jobs")
    parser.add_argument("job", choices=names)
    parser.add_argument("--ds", required=True, help="business date, yyyyMMdd")
    parser.add_argument("--root", required=True, help="folder of the warehouse tables")
    parser.add_argument("--first-load", action="store_true",
                        help="dimensions: refuse when increments exist")
    parser.add_argument("--audited", action="store_true",
                        help="increments: a broken rule leaves the tables as they were")
    parser.add_argument("--slices", type=int, default=24, help="parallel reads of a table")
    args = parser.parse_args(argv)
    parse_ds(args.ds)

    spark = session(f"{args.job} {args.ds}")
    try:
        create_all(spark, args.root)
        if args.job == "dimensions":
            db = jdbc.Endpoint.from_env("BUSINESS_DB")
            load_dimensions(spark, jdbc.DimensionSource(spark, db, args.slices), first_load=args.first_load)
        elif args.job == "increments":
            db = jdbc.Endpoint.from_env("BUSINESS_DB")
            source = jdbc.DaySource(spark, db, args.ds, args.slices)
            load_day(spark, source, args.ds, audited=args.audited)
        elif args.job == "audit":
            for (fact, rule), rows in sorted(audit_day(spark, args.ds).items()):
                print(fact, rule, rows)
        elif args.job in PUBLISH_JOBS:
            store = JdbcResultStore(spark, jdbc.Endpoint.from_env("RESULT_DB"))
            publish_result(spark, args.ds, PUBLISH_JOBS[args.job], store)
        elif args.job == "layers":
            print(run_layers(spark, args.ds))
        else:
            print(LAYER_JOBS[args.job](spark, args.ds))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
