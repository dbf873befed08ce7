"""Incremental snapshots: equal to the full rebuild day by day, no shuffle of the state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import facts as f
from stratamart import jobs
from stratamart.plans import dwd, dws
from stratamart.plans.ods import INGESTS
from stratamart.sinks import states
from stratamart.sinks.tables import write_partition
from stratamart.sources import tables
from stratamart.storage import names_in

DAYS = ["20260821", "20260822", "20260823", "20260824", "20260825"]
SHAPES = {"ods.ods_order_info_di": f.ORDER, "ods.ods_order_detail_di": f.DETAIL,
          "ods.ods_payment_info_di": f.PAYMENT, "ods.ods_user_behavior_di": f.BEHAVIOR,
          "ods.ods_rating_info_di": f.RATING}


def increments(day, rng):
    """A day with new orders, later and late versions of old ones, and invalid rows."""
    noon = dt.datetime.strptime(day, "%Y%m%d") + dt.timedelta(hours=12)

    def near():  # days back, the day itself, or a day ahead of its partition
        return noon + dt.timedelta(days=rng.choice([-2, -1, 0, 0, 0, 1, 2]), seconds=rng.randrange(900))

    orders, details, payments, events, ratings = [], [], [], [], []
    for order in rng.sample(range(1, 40), 22):
        amount, at = rng.choice([10, 10, 10, 12]), near()
        status = rng.choice(["PAID", "PAID", "PAID", "CREATED", "CANCELLED"])
        orders.append(f.order(order, shop=3, amount=amount, status=status, created=noon - dt.timedelta(days=9),
                              updated=at, ds=day))
        details.append(f.detail(order * 10, order, final=rng.choice([10, 10, 12]), created=at, ds=day))
        payments.append(f.payment(order * 10 + rng.choice([1, 1, 1, 2]), order, amount=amount,
                                  status=rng.choice(["SUCCESS", "SUCCESS", "FAILED"]), paid=at, ds=day))
        ratings.append(f.rating(order + rng.choice([0, 100]), order, score=rng.choice([0, 1, 3, 5, 5]), time=near(), ds=day))
    for event in rng.sample(range(1, 80), 45):
        events.append(f.event(event, kind=rng.choice(["view", "cart", "error"]), time=near(), ds=day,
                              session=rng.choice(["s", None])))
    details.append((None, 1, 5, 1, f.money(1), f.money(1), noon, day))
    return dict(zip(SHAPES, (orders, details, payments, events, ratings)))


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("states"))
    tables.create_all(spark, root)
    spark.createDataFrame(f.SKUS, f.SKU).write.insertInto("cdm.dim_sku_df")
    yield root
    for table in tables.TABLES:
        spark.sql(f"DROP TABLE {table}")
    spark.sql("DROP DATABASE IF EXISTS state CASCADE")


def load(spark, day, rows):
    for table, shape in SHAPES.items():
        states.forget(spark, table, day)
        write_partition(spark.createDataFrame(rows[table], shape).drop("ds"), table, day, None)


def rebuilt(spark, state, day):
    history = spark.table(state.table).where(F.col("ds") <= day)
    return state.newest.of(state.valid(history, day))


def bag(df):
    return sorted(map(repr, df.collect()))


def compare(spark, day):
    for state in states.ALL:
        wanted = rebuilt(spark, state, day)
        got = states.newest(spark, state, day).select(*wanted.columns)
        if state is states.CANDIDATES:
            wanted, got = wanted.select("order_id"), got.select("order_id")
        assert bag(got) == bag(wanted), (state.name, day)


def test_states_equal_the_full_rebuild_over_five_days(spark, warehouse):
    rng = random.Random(4)
    days = {day: increments(day, rng) for day in DAYS}
    for day in DAYS:
        load(spark, day, days[day])
        if day in DAYS[2::2]:
            compare(spark, day)
        for state in states.ALL:  # the last two days are kept
            states.newest(spark, state, day)
            assert sorted(states._days(spark, state)) == DAYS[: DAYS.index(day) + 1][-2:]
    skus, day = spark.table("cdm.dim_sku_df"), DAYS[-1]
    of = {s.name: states.newest(spark, s, day) for s in states.ALL}
    whole = {t: spark.table(t).where(F.col("ds") <= day) for t in SHAPES}
    orders, details, payments, events, ratings = whole.values()
    lines = dwd.trade(orders, details, payments, skus, day)
    assert lines.count() and bag(dwd.trade_of(of["orders"], of["details"], of["payments"], skus)) == bag(lines)
    views = dwd.behavior(events, skus, day)
    assert views.count() and bag(dwd.behavior_of(of["events"], skus)) == bag(views)
    rated = dwd.rating(ratings, lines, day)
    assert rated.count() and bag(dwd.rating_of(of["ratings"], lines)) == bag(rated)
    assert bag(dws.site_stats_of(views, lines, of["orders"], day)) == bag(dws.site_stats(views, lines, orders, day))
    summary = dwd.cleaning_summary_of(of["candidates"].agg(F.count("order_id").alias("order_count")), lines)
    assert bag(summary) == bag(dwd.cleaning_summary(payments, lines, day))

    # A day that is loaded again forgets what has read it, and later days too.
    load(spark, DAYS[-1], increments(DAYS[-1], rng))
    assert sorted(states._days(spark, states.ORDERS)) == [DAYS[-2]]
    compare(spark, DAYS[-1])
    load(spark, DAYS[1], increments(DAYS[1], rng))
    assert not states._days(spark, states.ORDERS)
    compare(spark, DAYS[-1])


def test_a_build_that_was_cut_off_does_not_count(spark, warehouse, monkeypatch):
    load(spark, "20260826", increments("20260826", random.Random(9)))
    monkeypatch.setattr(states, "create_marker", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        states.newest(spark, states.ORDERS, "20260826")
    assert "20260826" not in states._days(spark, states.ORDERS)
    monkeypatch.undo()
    compare(spark, "20260826")


def test_the_state_is_not_shuffled(spark, warehouse):
    """Only the increments are exchanged; the state is read by bucket and written by bucket."""
    load(spark, "20260826", increments("20260826", random.Random(9)))
    compare(spark, "20260826")
    state, day = states.ORDERS, "20260826"
    buckets = states._days(spark, state)[day]
    kept = states._read(spark, state, day, buckets)
    fresh = spark.table(state.table).where(F.col("ds") == day)
    merged = states.merge(kept, fresh, state.newest, buckets)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Bucketed: true" in plan and f"SelectedBucketsCount: {buckets} out of {buckets}" in plan
    assert "SortMergeJoin" in plan and "FullOuter" in plan
    join = plan[plan.index("FullOuter"):]
    state_side = join[: join.index("Scan orc spark_catalog.state.orders")]
    assert "Exchange" not in state_side and "Exchange" in join[len(state_side):]
    folder = f"{states._folder(spark, state)}/{day}_{buckets}/rows"
    files = [n for n in names_in(spark, folder) if n.endswith(".orc")]
    assert len(files) <= buckets


def test_load_day_forgets_states_before_it_swaps(spark, warehouse, monkeypatch):
    day = "20260827"
    rows = increments(day, random.Random(2))
    frames = {i.source: spark.createDataFrame(rows[i.target], SHAPES[i.target]) for i in INGESTS}
    jobs.load_day(spark, frames.__getitem__, day)
    states.newest(spark, states.ORDERS, day)
    seen = []
    monkeypatch.setattr("stratamart.sinks.tables.swap", lambda staged: seen.append(states._days(spark, states.ORDERS)))
    jobs.load_day(spark, frames.__getitem__, day)
    assert day not in seen[0]
