"""Named queries over a star-schema folder, one per dataset or operator.

Every query takes (spark, folder), reads whole tables lazily and returns one
DataFrame without running it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import metrics, temporal
from .functions.money import money
from .operators import audits
from .operators.compare import reconcile, set_difference
from .operators.dedup import repeated_keys
from .operators.fingerprint import differences, fingerprint
from .operators.periods import Periods, period_rows
from .operators.quality import broken_rows, profile
from .plans import ads, audit, contracts, dim, dwd, dws
from .plans.ods import INGESTS, one_day
from .schemas import TABLES
from .sinks.results import publishable
from .sources.star_adapter import StarAdapter
from .streaming import contract, messages, rejects

CUTOFF = "20240130"


class Layers:
    """All layers of one star-schema folder, built on demand and never cached."""

    def __init__(self, spark: SparkSession, path: str, ds: str = CUTOFF):
        self.ds = ds
        self.spark = spark
        self.src = StarAdapter(spark, path)

    # dimensions
    def dim_shop(self) -> DataFrame:
        return dim.shops(self.src.shop_info)

    def dim_sku(self) -> DataFrame:
        return dim.skus(self.src.sku_info, self.src.shop_info)

    # increments
    def day(self, source: str) -> DataFrame:
        ingest = next(i for i in INGESTS if i.source == source)
        return one_day(getattr(self.src, source), ingest, self.ds)

    # snapshots
    def trade(self) -> DataFrame:
        s = self.src
        return dwd.trade(s.ods_order, s.ods_detail_by_id, s.ods_payment, self.dim_sku(), self.ds)

    def behavior(self) -> DataFrame:
        return dwd.behavior(self.src.ods_behavior, self.dim_sku(), self.ds)

    def rating(self) -> DataFrame:
        return dwd.rating(self.src.ods_rating, self.trade(), self.ds)

    # aggregates
    def site(self) -> DataFrame:
        return dws.site_stats(self.behavior(), self.trade(), self.src.ods_order, self.ds)

    def sku(self) -> DataFrame:
        return dws.sku_trade(self.behavior(), self.trade(), self.ds)

    def shop_rating(self) -> DataFrame:
        return dws.shop_rating(self.rating(), self.ds)

    # results
    def overview(self) -> DataFrame:
        return ads.overview(self.site())

    def topn(self) -> DataFrame:
        return ads.sku_topn(self.sku())

    def ads_rating(self) -> DataFrame:
        return ads.shop_rating(self.shop_rating())

    def published(self, result: DataFrame, table: str) -> DataFrame:
        return publishable(result, table, self.ds)

    # messages
    def log(self) -> DataFrame:
        """Messages with their arrival time: in order, but for two seeded delays."""
        s = self.src
        late = (
            "case when event_type <> 'ORDER_CREATED' then 0 "
            "when cast(key as bigint) % 97 = 0 then 90 "
            "when cast(key as bigint) % 997 = 1 then 300 else 0 end"
        )
        return messages.message_log(s.order_info, s.order_detail, s.payment_info).withColumn(
            "arrival_time",
            F.expr(f"event_time + make_dt_interval(0, 0, 0, cast({late} as decimal(18,6)))"),
        )

    def resent_log(self) -> DataFrame:
        """The log with the messages of every 50th order sent twice."""
        return _resent(self.log())

    def deduplicated_log(self) -> DataFrame:
        """The resent log with each message once, its text written after the shuffle."""
        s = self.src
        rows = messages.message_rows(s.order_info, s.order_detail, s.payment_info)
        return messages.written(messages.dedup_events(_resent(rows), messages.ID_PARTS))

    def tampered_log(self) -> DataFrame:
        """The resent log with wrong topics, dates, types and times seeded by key."""
        k = "cast(key as bigint)"
        return self.resent_log().withColumns(
            {
                "topic": F.expr(
                    f"if({k} % 101 = 5 and event_type = 'ORDER_DETAIL', "
                    "'ods_order_info', topic)"
                ),
                "business_date": F.expr(f"if({k} % 103 = 7, '20000101', business_date)"),
                "event_type": F.expr(
                    f"if({k} % 107 = 2 and event_type = 'PAYMENT_SUCCESS', "
                    "'PAYMENT_FAILED', event_type)"
                ),
                "event_time": F.expr(
                    f"if({k} % 109 = 3, event_time + interval 0.000007 seconds, event_time)"
                ),
                "value": F.expr(f"if({k} % 113 = 4, substring(value, 1, 12), value)"),
            }
        )

    def spoilt_log(self) -> DataFrame:
        """Raw messages with texts, keys and topics spoilt by key: one way for each rule."""
        k = "cast(key as bigint)"
        value = f"""
            case when {k} % 113 = 4 then substring(value, 1, 12)
                 when {k} % 127 = 6 then regexp_replace(value, '"user_id":[0-9]+,|"sku_num":[0-9]+,', '')
                 when {k} % 131 = 8 then replace(value, '"event_type":"PAYMENT_SUCCESS"', '"event_type":"PAYMENT_FAILED"')
                 when {k} % 137 = 9 then regexp_replace(value, '"business_date":"[0-9]+"', '"business_date":"20000101"')
                 when {k} % 139 = 10 then regexp_replace(value, '"event_time":"[^"]+"', '"event_time":"2024-01-01 00:00:00"')
                 else value end"""
        topic = f"if({k} % 149 = 11 and topic = 'ods_order_info', 'ods_payment_info', if({k} % 151 = 12, 'other', topic))"
        spoilt_key = f"if({k} % 157 = 13, concat(key, '0'), key)"
        return self.log().select(
            F.expr(topic).alias("topic"), F.expr(spoilt_key).alias("key"), F.expr(value).alias("value")
        )


def _resent(log: DataFrame) -> DataFrame:
    copies = F.expr("sequence(1, if(cast(key as bigint) % 50 = 0, 2, 1))")
    return log.withColumn("_copy", F.explode(copies)).drop("_copy")


def _day_query(source: str) -> Callable[[Layers], DataFrame]:
    return lambda w: w.day(source)


# ---- period operators ------------------------------------------------------

def _data_periods(w: Layers) -> DataFrame:
    """The four periods that end at the last day of the event data."""
    last = w.src.user_behavior.agg(
        F.max(temporal.day_of(F.col("event_time"))).alias("last_day")
    )
    return last.select(period_rows(F.col("last_day")))


def _fan_out_inner(w: Layers) -> DataFrame:
    """Event count and users per period, rows fanned out after a daily pre-aggregate."""
    daily = (
        dwd.valid_events(w.src.ods_behavior, w.ds)
        .withColumn("event_date", temporal.day_of(F.col("event_time")))
        .groupBy("event_date", "event_type")
        .agg(F.count("*").alias("_n"))
    )
    return (
        Periods(w.ds).fan_out(daily, "event_date")
        .groupBy("stat_period", "event_type")
        .agg(F.sum("_n").alias("event_count"))
    )


def _fan_out_outer(w: Layers) -> DataFrame:
    """Event count per period of the day before the data starts: all zeros kept."""
    periods = Periods("20231101")
    daily = (
        dwd.valid_events(w.src.ods_behavior, w.ds)
        .withColumn("event_date", temporal.day_of(F.col("event_time")))
        .groupBy("event_date")
        .agg(F.count("*").alias("_n"))
    )
    counts = periods.fan_out(daily, "event_date").groupBy("stat_period").agg(
        F.sum("_n").alias("event_count")
    )
    current = Periods(w.ds).fan_out(daily, "event_date").groupBy("stat_period").agg(
        F.sum("_n").alias("event_count")
    )
    zeros = {"event_count": "bigint"}
    return (
        periods.fill(counts, zeros).withColumn("ds", F.lit("20231101"))
        .unionByName(Periods(w.ds).fill(current, zeros).withColumn("ds", F.lit(w.ds)))
    )


# ---- quality ---------------------------------------------------------------

def _dirty_trade(w: Layers) -> DataFrame:
    """Trade lines with NULLs, bad amounts and repeated ids seeded by key."""
    return (
        w.trade()
        .withColumns(
            {
                "shop_name": F.expr("if(order_id % 41 = 3, null, shop_name)"),
                "sku_num": F.expr("if(order_id % 43 = 5, 0, sku_num)"),
                "payment_amount": F.expr(
                    "if(order_id % 47 = 1, cast(0 as decimal(20,2)), payment_amount)"
                ),
            }
        )
        .withColumn(
            "_copy", F.explode(F.expr("sequence(1, if(order_detail_id % 53 = 0, 2, 1))"))
        )
        .drop("_copy")
    )


def _dq_nulls(w: Layers) -> DataFrame:
    bad = broken_rows(_dirty_trade(w), contracts.TRADE)
    return bad.where("rule = 'required_is_null'").select("order_detail_id")


def _dq_ranges(w: Layers) -> DataFrame:
    return broken_rows(_dirty_trade(w), contracts.TRADE).where("rule <> 'required_is_null'")


def _dq_profile(w: Layers) -> DataFrame:
    return profile(_dirty_trade(w), contracts.TRADE)


def _dq_rating_counts(w: Layers) -> DataFrame:
    """Shop aggregates whose parts do not add up, seeded on every third shop."""
    shops = w.shop_rating().withColumn(
        "bad_count", F.expr("if(shop_id % 3 = 0, bad_count + 1, bad_count)")
    )
    return broken_rows(shops, contracts.SHOP_RATING)


def _dq_source(table: str, view: str) -> Callable[[Layers], DataFrame]:
    return lambda w: broken_rows(getattr(w.src, view), contracts.SOURCE[table])


def _dq_published(w: Layers) -> DataFrame:
    """Publish rules over the overview: the conversion rate is out of range here."""
    table = "ads.ads_biz_overview_df"
    return broken_rows(w.published(w.overview(), table), contracts.PUBLISH[table])


def _price_ranges(w: Layers) -> DataFrame:
    """Price range per category, its lower end set above the cheapest SKUs."""
    return (
        w.src.sku_info.groupBy("category_id")
        .agg((F.min("price") + 10).alias("price_low"), F.max("price").alias("price_high"))
    )


# ---- scalars ---------------------------------------------------------------

def _scalar_dates(w: Layers) -> DataFrame:
    t = F.col("create_time")
    return w.src.order_info.select(
        "order_id",
        temporal.ds_of(t).alias("ds_text"),
        temporal.day_of(t).alias("order_date"),
        F.to_date(temporal.ds_of(t), "yyyyMMdd").alias("parsed_date"),
        F.date_sub(temporal.day_of(t), 6).alias("week_start"),
        temporal.contract_time(t).alias("contract_time"),
        temporal.ds_of(t).rlike("^[0-9]{8}$").alias("ds_is_valid"),
    )


def _scalar_money(w: Layers) -> DataFrame:
    return w.src.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        money(F.col("l_extendedprice")).alias("price"),
        money(
            money(F.col("l_extendedprice")) * (1 - F.col("l_discount").cast("decimal(4,2)"))
        ).alias("net_price"),
        metrics.share(F.col("l_linenumber"), F.col("l_orderkey") % 8).alias("guarded_share"),
    )


def _scalar_bucket(w: Layers) -> DataFrame:
    good = F.col("order_id") % 23
    n = good + F.col("order_id") % 29 + 1
    return w.src.rating_info.select(
        "rating_id",
        metrics.score_level(F.col("shop_score")).alias("score_level"),
        metrics.wilson_lower_bound(good, n).alias("wilson_rate"),
        metrics.risk_flag(n - good, n).alias("risk_flag"),
    )


def _set_equal(w: Layers) -> DataFrame:
    """Orders with a wrong line sum against orders with a wrong payment amount."""
    s = w.src
    lines = audits.amount_mismatch(s.order_info, s.order_detail).select("order_id")
    paid = audits.payment_amount_differs(s.payment_info, s.order_info).select("order_id")
    return set_difference(lines, paid)


def _reconcile(w: Layers) -> DataFrame:
    """Orders per day in the source and order versions per day in the increments."""
    source = w.src.order_info.withColumn("ds", temporal.ds_of(F.col("create_time")))
    return reconcile(source, w.src.ods_order, "ds")


def _audit_summary(w: Layers) -> DataFrame:
    """All gate rules over the audit views; a row's day is that of its first time."""
    s = w.src
    facts = {
        "shop_info": s.shop_info,
        "sku_info": s.sku_info,
        "order_info": s.audit_order,
        "order_detail": s.audit_detail,
        "payment_info": s.audit_payment,
        "user_behavior": s.audit_behavior,
        "rating_info": s.rating_info,
    }
    days = {fact: temporal.ds_of(F.col(times[0])) for fact, times in audit.TIMES.items()}
    return audit.report(facts, days)


def _fingerprints(w: Layers) -> DataFrame:
    """Fingerprints of each fact and day at the source and in the increments."""
    s, parts = w.src, []
    views = {"order_info": s.ods_order, "order_detail": s.ods_detail_by_id, "payment_info": s.ods_payment,
             "user_behavior": s.ods_behavior, "rating_info": s.ods_rating}
    for ingest in INGESTS:
        schema = TABLES[ingest.target].schema
        day = temporal.ds_of(F.col(ingest.time_column)).alias("ds")
        source = fingerprint(getattr(s, ingest.source), schema, [day])
        target = fingerprint(views[ingest.source], schema, ["ds"])
        parts.append(differences(source, target, ["ds"]).withColumn("fact", F.lit(ingest.source)))
    return reduce(DataFrame.unionByName, parts)


def _parsed(topic: str) -> Callable[[Layers], DataFrame]:
    return lambda w: messages.parse(w.log(), topic)


def _message_facts(w: Layers) -> dict[str, DataFrame]:
    return {
        messages.ORDER_TOPIC: w.src.order_info,
        messages.DETAIL_TOPIC: w.src.order_detail,
        messages.PAYMENT_TOPIC: w.src.payment_info,
    }


BUILDERS: dict[str, Callable[[Layers], DataFrame]] = {
    # increments
    "ods_order_day": _day_query("order_info"),
    "ods_detail_day": _day_query("order_detail"),
    "ods_payment_day": _day_query("payment_info"),
    "ods_behavior_day": _day_query("user_behavior"),
    "ods_rating_day": _day_query("rating_info"),
    # dimensions
    "dim_shop": lambda w: w.dim_shop(),
    "dim_sku": lambda w: w.dim_sku(),
    # snapshots
    "dwd_trade": lambda w: w.trade(),
    "dwd_behavior": lambda w: w.behavior(),
    "dwd_rating": lambda w: w.rating(),
    # aggregates
    "dws_site": lambda w: w.site(),
    "dws_sku": lambda w: w.sku(),
    "dws_shop_rating": lambda w: w.shop_rating(),
    # results and what is published of them
    "ads_overview": lambda w: w.overview(),
    "ads_sku_topn": lambda w: w.topn(),
    "ads_shop_rating": lambda w: w.ads_rating(),
    "pub_overview": lambda w: w.published(w.overview(), "ads.ads_biz_overview_df"),
    "pub_topn": lambda w: w.published(w.topn(), "ads.ads_sku_topn_df"),
    "pub_rating": lambda w: w.published(w.ads_rating(), "ads.ads_shop_rating_df"),
    # scans and reconciliation
    "scan_one_partition": lambda w: w.src.ods_order.where(F.col("ds") == w.ds),
    "scan_history": lambda w: dwd.history(w.src.ods_order, "20240120"),
    "reconcile_counts": _reconcile,
    "reconcile_fingerprint": _fingerprints,
    # filters and dedup
    "success_payments": lambda w: dwd.success_payments(w.src.ods_payment, w.ds),
    "valid_events": lambda w: dwd.valid_events(w.src.ods_behavior, w.ds),
    "valid_ratings": lambda w: dwd.valid_ratings(w.src.ods_rating, w.ds),
    "latest_order": lambda w: dwd.latest_orders(w.src.ods_order, w.ds),
    "latest_detail": lambda w: dwd.latest_details(w.src.ods_detail, w.ds),
    "latest_payment": lambda w: dwd.latest_payments(w.src.ods_payment, w.ds),
    "latest_behavior": lambda w: dwd.latest_events(w.src.ods_behavior, w.ds),
    "latest_rating": lambda w: dwd.latest_ratings(w.src.ods_rating, w.ds),
    "single_success": lambda w: dwd.single_success(w.src.ods_payment, w.ds),
    "detail_amount": lambda w: dwd.detail_amounts(w.src.ods_detail, w.ds),
    "dwd_valid_order": lambda w: dwd.valid_orders(
        w.src.ods_order, w.src.ods_detail_by_id, w.src.ods_payment, w.ds
    ),
    "candidate_orders": lambda w: dwd.candidate_orders(w.src.ods_payment, w.ds),
    "cleaning_summary": lambda w: dwd.cleaning_summary(w.src.ods_payment, w.trade(), w.ds),
    "paid_order": lambda w: dws.paid_orders(w.trade()),
    # periods
    "periods": _data_periods,
    "period_fanout_inner": _fan_out_inner,
    "period_fanout_outer": _fan_out_outer,
    # audits
    "anti_sku_shop": lambda w: audits.missing_parent(
        w.src.audit_sku, w.src.shop_info, "shop_id"
    ).select("sku_id", "shop_id"),
    "anti_order_shop": lambda w: audits.missing_parent(
        w.src.audit_order, w.src.shop_info, "shop_id"
    ).select("order_id", "shop_id"),
    "anti_detail_order": lambda w: audits.missing_parent(
        w.src.audit_detail, w.src.order_info, "order_id"
    ).select("order_detail_id", "order_id"),
    "anti_detail_sku": lambda w: audits.missing_parent(
        w.src.audit_detail, w.src.sku_info, "sku_id"
    ).select("order_detail_id", "sku_id"),
    "anti_payment_order": lambda w: audits.missing_parent(
        w.src.audit_payment, w.src.order_info, "order_id"
    ).select("payment_id", "order_id"),
    "anti_behavior_sku": lambda w: audits.missing_parent(
        w.src.audit_behavior, w.src.sku_info, "sku_id"
    ).select("event_id", "sku_id"),
    "mismatch_shop": lambda w: audits.wrong_shop_lines(
        w.src.order_detail, w.src.order_info, w.src.sku_info
    ),
    "mismatch_user": lambda w: audits.wrong_payer(w.src.payment_info, w.src.order_info),
    "rating_without_success": lambda w: audits.rating_without_success(
        w.src.rating_info, w.src.audit_order, w.src.payment_info
    ),
    "status_vs_payment": lambda w: audits.status_disagrees(
        w.src.order_info, w.src.payment_info
    ),
    "multi_success": lambda w: audits.multiple_success(w.src.payment_info),
    "anomaly_amount_mismatch": lambda w: audits.amount_mismatch(
        w.src.order_info, w.src.order_detail
    ).orderBy("order_id"),
    "anomaly_pay_before_create": lambda w: audits.paid_before_created(
        w.src.payment_info, w.src.order_info
    ).orderBy("order_id"),
    "anomaly_pay_amount": lambda w: audits.payment_amount_differs(
        w.src.payment_info, w.src.order_info
    ),
    "burst_unpaid": lambda w: audits.unpaid_order_bursts(w.src.unpaid_orders),
    "burst_failed": lambda w: audits.failed_payment_bursts(w.src.failed_payments),
    "outside_day": lambda w: audits.outside_day(
        w.src.ods_order, ["create_time", "update_time"], F.col("ds")
    ).select("order_id", "create_time", "update_time", "ds"),
    "audit_summary": _audit_summary,
    # quality rules
    "dq_nulls": _dq_nulls,
    "dq_ranges": _dq_ranges,
    "dq_profile": _dq_profile,
    "dq_rating_counts": _dq_rating_counts,
    "dq_source_order": _dq_source("order_info", "audit_order"),
    "dq_source_detail": _dq_source("order_detail", "audit_detail"),
    "dq_source_payment": _dq_source("payment_info", "payment_info"),
    "dq_source_behavior": _dq_source("user_behavior", "user_behavior"),
    "dq_source_rating": _dq_source("rating_info", "rating_info"),
    "dq_published": _dq_published,
    "dq_dim_names": lambda w: audits.placeholder_names(
        w.src.sku_info, "sku_id", "sku_name", "old ", "i"
    ),
    "dq_dim_price": lambda w: audits.price_outside_category(
        w.src.sku_info, _price_ranges(w)
    ),
    "dup_keys": lambda w: repeated_keys(w.src.ods_detail, "order_detail_id"),
    "distinct_keys": lambda w: w.src.ods_detail.agg(
        F.count("*").alias("row_count"),
        F.countDistinct("order_detail_id").alias("detail_keys"),
        F.countDistinct("order_id", "sku_id", "ds").alias("order_sku_days"),
    ),
    "set_equal_check": _set_equal,
    # messages
    "event_envelope": lambda w: w.log().drop("arrival_time"),
    "event_order": lambda w: messages.in_send_order(w.log()).select(
        "event_time", "event_type", "event_id"
    ),
    "event_counts": lambda w: contract.topic_counts(w.log()),
    "event_parse": _parsed(messages.PAYMENT_TOPIC),
    "event_parse_order": _parsed(messages.ORDER_TOPIC),
    "event_parse_detail": _parsed(messages.DETAIL_TOPIC),
    "event_dedup": lambda w: w.deduplicated_log(),
    "event_contract_check": lambda w: contract.violations(w.tampered_log()),
    "event_rejects": lambda w: rejects.rejected(rejects.checked(w.spoilt_log())),
    "event_missing": lambda w: contract.missing_messages(w.resent_log(), _message_facts(w)),
    "event_disorder": lambda w: contract.disorder(w.log()),
    "event_detail_first": lambda w: contract.detail_before_order(w.log()),
    # scalar functions
    "scalar_dates": _scalar_dates,
    "scalar_money": _scalar_money,
    "scalar_bucket": _scalar_bucket,
}


def _bind(build: Callable[[Layers], DataFrame]):
    return lambda spark, sf_dir: build(Layers(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(build) for name, build in BUILDERS.items()}
