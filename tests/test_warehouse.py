"""Stored tables, daily jobs and publishing, end to end on a small folder."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import facts as f
from conftest import SMALL
from stratamart import jobs
from stratamart.errors import DataQualityError
from stratamart.operators.compare import set_difference
from stratamart.plans.contracts import PUBLISHED_COLUMNS, Contract
from stratamart.plans.ods import INGESTS, one_day
from stratamart.queries import CUTOFF, Layers
from stratamart.schemas import TABLES
from stratamart.sinks import tables as sinks
from stratamart.sinks.results import FolderResultStore, publish
from stratamart.sinks.tables import replace_day, write_partition
from stratamart.sources import jdbc, tables
from stratamart.storage import list_names, names_in

ODS_VIEWS = {
    "ods.ods_order_info_di": "ods_order",
    "ods.ods_order_detail_di": "ods_detail",
    "ods.ods_payment_info_di": "ods_payment",
    "ods.ods_user_behavior_di": "ods_behavior",
    "ods.ods_rating_info_di": "ods_rating",
}


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("root"))
    tables.create_all(spark, root)
    yield root
    for table in TABLES:
        spark.sql(f"DROP TABLE {table}")
    spark.sql("DROP DATABASE IF EXISTS state CASCADE")


def ratings(spark, *rows):
    return spark.createDataFrame(list(rows), f.RATING).drop("ds")


NAME = "ods.ods_rating_info_di"


def stored(spark, ds):
    rows = tables.read_partition(spark, NAME, ds).select("rating_id", "shop_score").collect()
    return sorted(map(tuple, rows))


def test_partition_overwrite_is_idempotent_and_local(spark, warehouse):
    assert not tables.has_partition(spark, NAME, "20200101")
    write_partition(ratings(spark, f.rating(1), f.rating(2)), NAME, "20200101", None)
    write_partition(ratings(spark, f.rating(3)), NAME, "20200102", None)
    for _ in range(2):
        assert write_partition(ratings(spark, f.rating(4, score=2)), NAME, "20200101", None) == 1
    assert stored(spark, "20200101") == [(4, 2)]
    assert stored(spark, "20200102") == [(3, 5)]
    history = tables.read_history(spark, NAME, "20200101")
    assert history.select("ds").distinct().collect() == [("20200101",)]
    assert history.schema["ds"].dataType.simpleString() == "string"


def test_broken_result_leaves_the_partition_as_it_was(spark, warehouse):
    write_partition(ratings(spark, f.rating(1)), NAME, "20200103", None)
    twice = ratings(spark, f.rating(5), f.rating(5))
    with pytest.raises(DataQualityError, match="repeated_keys"):
        write_partition(twice, NAME, "20200103", Contract(NAME, ("rating_id",)))
    assert stored(spark, "20200103") == [(1, 5)]


def versions(spark, ds):
    return names_in(spark, f"{tables.base_of(spark, NAME)}/{tables.VERSIONS}/{ds}")


def test_a_failed_result_leaves_no_version_behind(spark, warehouse):
    write_partition(ratings(spark, f.rating(1)), NAME, "20200104", None)
    kept = versions(spark, "20200104")
    with pytest.raises(DataQualityError, match="repeated_keys"):
        write_partition(ratings(spark, f.rating(5), f.rating(5)), NAME, "20200104",
                        Contract(NAME, ("rating_id",)))
    assert versions(spark, "20200104") == kept and len(kept) == 1


def test_a_swap_keeps_the_version_before_and_no_older(spark, warehouse):
    seen = []
    for score in range(1, 5):
        write_partition(ratings(spark, f.rating(1, score=score)), NAME, "20200108", None)
        seen.append(tables.current_path(spark, NAME, "20200108").rsplit("/", 1)[1])
    assert versions(spark, "20200108") == sorted(seen[-2:])
    assert stored(spark, "20200108") == [(1, 4)]


def test_a_running_query_reads_the_version_it_began_with(spark, warehouse):
    write_partition(ratings(spark, f.rating(1, score=1)), NAME, "20200109", None)
    begun = tables.read_partition(spark, NAME, "20200109")
    begun._jdf.queryExecution().executedPlan()
    write_partition(ratings(spark, f.rating(1, score=2)), NAME, "20200109", None)
    assert [r.shop_score for r in begun.collect()] == [1]
    assert stored(spark, "20200109") == [(1, 2)]


def test_a_failure_between_staging_and_swap_keeps_the_old_rows(spark, warehouse, monkeypatch):
    write_partition(ratings(spark, f.rating(1)), NAME, "20200110", None)
    events = "ods.ods_user_behavior_di"
    event = spark.createDataFrame([f.event()], f.BEHAVIOR).drop("ds")
    write_partition(event, events, "20200110", None)
    moved, real = [], sinks.point

    def lost(spark, name, ds, path):
        if name == events and not moved:
            moved.append(path)
            raise RuntimeError("catalog lost")
        real(spark, name, ds, path)

    monkeypatch.setattr(sinks, "point", lost)
    frames = {NAME: ratings(spark, f.rating(2)), events: event}
    before = versions(spark, "20200110")
    with pytest.raises(RuntimeError, match="catalog lost"):
        replace_day(frames, "20200110")
    assert moved and stored(spark, "20200110") == [(1, 5)]
    assert tables.read_partition(spark, events, "20200110").count() == 1
    assert versions(spark, "20200110") == before
    # The markers agree with the catalog: a new session finds the same rows.
    spark.sql(f"DROP TABLE {NAME}")
    tables.create_all(spark, warehouse)
    assert stored(spark, "20200110") == [(1, 5)]
    replace_day(frames, "20200110")
    assert stored(spark, "20200110") == [(2, 5)]


def test_many_small_files_become_few(spark, warehouse):
    many = spark.range(40).repartition(40).selectExpr(
        "id as rating_id", "id as order_id", "1L as shop_id", "cast(1 as tinyint) as shop_score",
        "timestamp'2020-01-11 00:00:00' as rating_time")
    assert write_partition(many, NAME, "20200111", None) == 40
    files = [n for n in list_names(spark, tables.current_path(spark, NAME, "20200111")) if n.endswith(".orc")]
    assert len(files) == 1 and len(versions(spark, "20200111")) == 1


def test_whole_tables_swap_too(spark, warehouse):
    shop = "cdm.dim_shop_df"
    for n in (1, 2, 3):
        rows = spark.range(n).selectExpr("id as shop_id", "'a' as shop_name", "'b' as province_name",
                                         "timestamp'2020-01-01 00:00:00' as open_time", "1 as status")
        assert sinks.write_whole(rows, shop) == n
        assert spark.table(shop).count() == n
    spark.sql(f"DROP TABLE {shop}")
    tables.create_all(spark, warehouse)
    assert spark.table(shop).count() == 3


def test_guards(spark, warehouse):
    with pytest.raises(DataQualityError, match="no partition"):
        jobs.trade(spark, "19990101")
    with pytest.raises(ValueError):
        tables.has_partition(spark, NAME, "2020' or '1'='1")
    with pytest.raises(DataQualityError, match="empty"):
        jobs.load_dimensions(spark, lambda t: getattr(Layers(spark, SMALL).src, t).limit(0))
    with pytest.raises(DataQualityError, match="frozen"):
        jobs.require_no_facts({"order_info": spark.range(1), "rating_info": spark.range(0)})
    jobs.require_no_facts({"order_info": spark.range(0)})
    write_partition(ratings(spark, f.rating(1)), NAME, "20200107", None)
    with pytest.raises(DataQualityError, match="frozen"):
        jobs.load_dimensions(spark, lambda t: spark.range(1), first_load=True)


def test_replace_day_stages_all_before_replacing(spark, warehouse):
    write_partition(ratings(spark, f.rating(1)), NAME, "20200105", None)
    broken = spark.createDataFrame([f.event()], f.BEHAVIOR).withColumn(
        "event_id", F.raise_error(F.lit("source lost")).cast("bigint"))
    frames = {NAME: ratings(spark, f.rating(2)), "ods.ods_user_behavior_di": broken}
    with pytest.raises(Exception, match="source lost"):
        replace_day(frames, "20200105")
    assert stored(spark, "20200105") == [(1, 5)]
    assert replace_day({NAME: ratings(spark, f.rating(2))}, "20200105") == {NAME: 1}
    assert stored(spark, "20200105") == [(2, 5)]


def test_tables_are_found_again_after_a_restart(spark, warehouse):
    write_partition(ratings(spark, f.rating(1)), NAME, "20200106", None)
    spark.sql(f"DROP TABLE {NAME}")  # external: the files stay
    tables.create_all(spark, warehouse)
    assert stored(spark, "20200106") == [(1, 5)]
    assert set(TABLES) == {
        f"{t.namespace[0]}.{t.name}"
        for db in ("ods", "cdm", "ads") for t in spark.catalog.listTables(db)
        if not t.isTemporary
    }


def test_scans_prune_partitions(spark, warehouse):
    one = tables.read_partition(spark, NAME, "20200101")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan and "(ds" in plan
    history = tables.read_history(spark, NAME, "20200101").select("rating_id")
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "<= 20200101)" in plan and "ReadSchema: struct<rating_id:bigint>" in plan


def test_one_day_is_half_open(spark):
    rows = [f.rating(1, time=f.at("2026-08-24 23:59:59.999999")),
            f.rating(2, time=f.at("2026-08-25 00:00:00")),
            f.rating(3, time=f.at("2026-08-25 23:59:59.999999")),
            f.rating(4, time=f.at("2026-08-26 00:00:00"))]
    ingest = INGESTS[4]
    got = one_day(spark.createDataFrame(rows, f.RATING), ingest, f.DS)
    assert got.columns == ingest.columns
    assert sorted(r.rating_id for r in got.collect()) == [2, 3]


def test_jdbc_slices_are_disjoint_and_cover_the_day():
    predicates = jdbc.day_predicates(INGESTS[2], "20260825", 3)
    assert predicates == [
        "payment_time >= '2026-08-25 00:00:00.000000' and payment_time < '2026-08-25 08:00:00.000000'",
        "payment_time >= '2026-08-25 08:00:00.000000' and payment_time < '2026-08-25 16:00:00.000000'",
        "payment_time >= '2026-08-25 16:00:00.000000' and payment_time < '2026-08-26 00:00:00.000000'",
    ]


def _counter(ids):
    def count(low, high, width):
        return Counter((i - low) // width for i in ids if low <= i < high)
    return count


@pytest.mark.parametrize(
    "ids",
    [
        list(range(1000)),
        [*range(990), *range(10**12, 10**12 + 10)],
        [2**i for i in range(60)] * 1 + list(range(5_000_000, 5_000_900)),
        [7] * 1 + [10**9 + i * i for i in range(2000)],
        list(range(-500, 500)),
    ],
)
def test_id_ranges_are_balanced_however_ids_lie(ids):
    parts, asked = 8, []

    def count(low, high, width):
        asked.append((low, high))
        found = _counter(ids)(low, high, width)
        assert len(found) <= jdbc.FAN
        return found

    ranges = jdbc.balanced_ranges(count, min(ids), max(ids) + 1, len(ids), parts)
    held = [sum(low <= i < high for i in ids) for low, high in ranges]
    share = -(-len(ids) // parts)
    assert sum(held) == len(ids) and max(held) <= 2 * share and len(ranges) <= 2 * parts
    assert [a for a, _ in ranges[1:]] == [b for _, b in ranges[:-1]]
    assert len(asked) < 100


def test_range_predicates_take_every_row_once():
    con = duckdb.connect()
    con.execute("create table t as select unnest([null, -5, 0, 1, 2, 3, 9, 100]) as id")
    for ranges in ([(0, 10)], [(0, 2), (2, 10)], [(0, 1), (1, 3), (3, 10)]):
        predicates = jdbc.range_predicates("id", ranges)
        assert len(predicates) == len(ranges)
        assert sum(con.execute(f"select count(*) from t where {p}").fetchone()[0] for p in predicates) == 8


def test_dimensions_are_read_once_and_checked_before_the_swap(spark, warehouse):
    source, reads = Layers(spark, SMALL).src, []

    def read(table):
        reads.append(table)
        return getattr(source, table)

    jobs.load_dimensions(spark, read)
    assert reads == ["shop_info", "sku_info"]
    before = [tables.current_path(spark, t, tables.WHOLE) for t in ("cdm.dim_shop_df", "cdm.dim_sku_df")]
    rows = spark.table("cdm.dim_sku_df").count()
    assert rows and rows == source.sku_info.count()
    bad = source.sku_info.withColumn("price", F.expr("if(sku_id % 50 = 7, -price, price)"))
    with pytest.raises(DataQualityError, match="dim_sku_df: bad_price="):
        jobs.load_dimensions(spark, {"shop_info": source.shop_info, "sku_info": bad}.__getitem__)
    twice = source.shop_info.unionByName(source.shop_info)
    with pytest.raises(DataQualityError, match="dim_shop_df: repeated_keys="):
        jobs.load_dimensions(spark, {"shop_info": twice, "sku_info": source.sku_info}.__getitem__)
    assert [tables.current_path(spark, t, tables.WHOLE) for t in ("cdm.dim_shop_df", "cdm.dim_sku_df")] == before


def test_endpoint_comes_from_the_environment_and_hides_its_password(monkeypatch):
    for key in ("URL", "USER", "PASSWORD", "DRIVER"):
        monkeypatch.setenv(f"X_{key}", f"my-{key}")
    db = jdbc.Endpoint.from_env("X")
    assert db.properties["password"] == "my-PASSWORD" and "my-PASSWORD" not in repr(db)


# ---- whole chain -----------------------------------------------------------

@pytest.fixture(scope="module")
def day(spark, warehouse):
    """All layers of the cutoff day, built from stored increments by the jobs."""
    w = Layers(spark, SMALL)
    jobs.load_dimensions(spark, lambda t: getattr(w.src, t))
    for table, view in ODS_VIEWS.items():
        rows = getattr(w.src, view).where(F.col("ds") != CUTOFF)
        rows.select(*TABLES[table].columns, "ds").write.insertInto(table)
    # The last day comes through the ingest job, from the versions of that day.
    sources = {i.source: getattr(w.src, ODS_VIEWS[i.target]) for i in INGESTS}
    jobs.load_day(spark, sources.__getitem__, CUTOFF)
    return w, jobs.run_layers(spark, CUTOFF)


BUILDS = {
    "cdm.dwd_trd_pay_dtl_df": Layers.trade,
    "cdm.dwd_user_behavior_df": Layers.behavior,
    "cdm.dwd_shop_rating_df": Layers.rating,
    "cdm.dws_site_stats_df": Layers.site,
    "cdm.dws_sku_trade_df": Layers.sku,
    "cdm.dws_shop_rating_df": Layers.shop_rating,
    "ads.ads_biz_overview_df": Layers.overview,
    "ads.ads_sku_topn_df": Layers.topn,
    "ads.ads_shop_rating_df": Layers.ads_rating,
}


@pytest.mark.parametrize("table", BUILDS)
def test_stored_layers_equal_the_lazy_plans(spark, day, table):
    w, _ = day
    direct = BUILDS[table](w)
    kept = tables.read_partition(spark, table, CUTOFF).drop("ds")
    kept = kept.select(*[F.col(c).cast(t) for c, t in direct.dtypes])
    assert kept.columns == direct.columns
    assert kept.count() == direct.count()
    assert set_difference(direct, kept).isEmpty()


def test_rerun_of_a_job_changes_nothing(spark, day):
    before = tables.read_partition(spark, "ads.ads_sku_topn_df", CUTOFF).collect()
    jobs.ads_topn(spark, CUTOFF)
    after = tables.read_partition(spark, "ads.ads_sku_topn_df", CUTOFF).collect()
    assert sorted(before) == sorted(after)


def test_publish_replaces_one_day(spark, day, tmp_path):
    store = FolderResultStore(spark, str(tmp_path))
    table = "ads.ads_sku_topn_df"
    result = tables.read_partition(spark, table, CUTOFF)
    publish(result, table, "20240129", store)
    for _ in range(2):
        assert publish(result, table, CUTOFF, store) == result.count()
    out = spark.read.parquet(f"{tmp_path}/{table}")
    assert set(out.columns) == set(PUBLISHED_COLUMNS[table])
    assert out.groupBy("ds").count().count() == 2
    assert out.count() == 2 * result.count()


def test_publish_turns_the_flag_into_a_number(spark, day, tmp_path):
    store = FolderResultStore(spark, str(tmp_path))
    table = "ads.ads_shop_rating_df"
    jobs.publish_result(spark, CUTOFF, table, store)
    out = spark.read.parquet(f"{tmp_path}/{table}")
    assert dict(out.dtypes)["risk_flag"] == "tinyint" and "shop_name" not in out.columns


def test_publish_refuses_a_rate_above_one_and_keeps_the_old_day(spark, day, tmp_path):
    store = FolderResultStore(spark, str(tmp_path))
    table = "ads.ads_biz_overview_df"
    result = tables.read_partition(spark, table, CUTOFF)
    fixed = result.withColumn("view_to_pay_rate", F.lit("0.5").cast("decimal(10,6)"))
    assert publish(fixed, table, CUTOFF, store) == 4
    with pytest.raises(DataQualityError, match="bad_rate"):
        publish(result.withColumn("view_to_pay_rate", F.lit("1.000001").cast("decimal(10,6)")),
                table, CUTOFF, store)
    with pytest.raises(DataQualityError, match="row_count=3"):
        publish(fixed.where("stat_period <> '7d'"), table, CUTOFF, store)
    assert spark.read.parquet(f"{tmp_path}/{table}").count() == 4


def test_publish_reads_back(spark, day, tmp_path):
    class Lossy(FolderResultStore):
        def append(self, df, table):
            super().append(df.limit(2), table)

    result = tables.read_partition(spark, "ads.ads_shop_rating_df", CUTOFF)
    with pytest.raises(DataQualityError, match="found rows and keys"):
        publish(result, "ads.ads_shop_rating_df", CUTOFF, Lossy(spark, str(tmp_path)))
