"""Newest rows per key, kept from day to day.

A full snapshot reads the whole history of increments and shuffles it to find
the newest version of each key. A state holds that result: one row per key as of
a day, bucketed and sorted by the key. The next day's state is the last one
joined to the newest rows of the days since, which alone are shuffled, into as
many partitions as there are buckets: the state is read bucket by bucket where
it lies, and written so again. Late versions lose by the same order as in the
full snapshot, and a newer version that makes an order invalid wins.

Rows that are valid but lie after the cutoff (``pending``) may count on a later
day; they are kept beside the state and join the next day's increments.

A state is used only if its ``_done`` mark is there. Replacing a stored day of
increments forgets all states that have read it (``forget``); then the newest
older state is the base, or the whole history if there is none. Increments must
be replaced through ``jobs.load_day`` for that.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..bizdate import parse_ds
from ..operators.dedup import latest_by
from ..plans import dwd
from ..sources.tables import base_of
from ..storage import create_marker, delete_folder, names_in

STATES, DONE = "_states", "_done"
KEPT_DAYS = 2
KEY = "_key"
#: Stands for a NULL key, which keeps one newest row like any other.
NO_KEY = -(2**63)


@dataclass(frozen=True)
class State:
    """Newest rows of one increment table by one key."""

    name: str
    table: str
    newest: dwd.Newest
    #: Valid rows up to a cutoff, and valid rows that lie after it.
    valid: Callable[[DataFrame, str], DataFrame] = dwd.history
    later: Callable[[DataFrame, str], DataFrame] | None = None


def _success(payments: DataFrame, ds: str) -> DataFrame:
    return dwd.history(payments, ds).where(F.col("payment_status") == "SUCCESS")


ORDERS = State("orders", "ods.ods_order_info_di", dwd.ORDERS)
DETAILS = State("details", "ods.ods_order_detail_di", dwd.DETAILS)
PAYMENTS = State("payments", "ods.ods_payment_info_di", dwd.PAYMENTS)
#: Orders with any success payment in any version.
CANDIDATES = State("candidates", "ods.ods_payment_info_di", dwd.CANDIDATES, _success)
EVENTS = State("events", "ods.ods_user_behavior_di", dwd.EVENTS, dwd.valid_events, dwd.later_events)
RATINGS = State("ratings", "ods.ods_rating_info_di", dwd.RATINGS, dwd.valid_ratings, dwd.later_ratings)
ALL = (ORDERS, DETAILS, PAYMENTS, CANDIDATES, EVENTS, RATINGS)


def _folder(spark: SparkSession, state: State) -> str:
    return f"{base_of(spark, state.table)}/{STATES}/{state.name}"


def _days(spark: SparkSession, state: State) -> dict[str, int]:
    """Finished states: day and number of buckets."""
    folder = _folder(spark, state)
    found = [name.split("_") for name in names_in(spark, folder) if name[0].isdigit()]
    return {
        day: int(buckets) for day, buckets in found if DONE in names_in(spark, f"{folder}/{day}_{buckets}")
    }


def forget(spark: SparkSession, table: str, ds: str) -> None:
    """Drop every state of a table that has read the increments of ``ds``."""
    for state in ALL:
        if state.table == table:
            for name in names_in(spark, _folder(spark, state)):
                if name >= ds:
                    delete_folder(spark, f"{_folder(spark, state)}/{name}")


def rank(newest: dwd.Newest) -> Column:
    """Newest last; NULLs are least, as in the full snapshot."""
    return F.struct(*newest.newest_first, *newest.ties)


def keyed(df: DataFrame, newest: dwd.Newest) -> DataFrame:
    return df.withColumn(KEY, F.coalesce(F.col(newest.key).cast("bigint"), F.lit(NO_KEY)))


def merge(state: DataFrame, fresh: DataFrame, newest: dwd.Newest, buckets: int) -> DataFrame:
    """The newer row of each key of a bucketed state and of fresh rows.

    ``fresh`` shrinks to one row per key in its map tasks, then goes to the
    buckets; the state is not shuffled.
    """
    best = latest_by(fresh.select(*newest.columns), [newest.key], newest.newest_first, newest.ties)
    new = keyed(best, newest).repartition(buckets, KEY)
    sides = [
        df.select(KEY, F.struct(*newest.columns).alias(side), rank(newest).alias(f"{side}_rank"))
        for df, side in ((state, "old"), (new, "new"))
    ]
    joined = sides[0].join(sides[1], KEY, "full_outer")
    newer = F.col("old").isNull() | (F.col("new").isNotNull() & (F.col("new_rank") > F.col("old_rank")))
    row = F.when(newer, F.col("new")).otherwise(F.col("old")).alias("row")
    return joined.select(KEY, row).select(KEY, "row.*")


def _read(spark: SparkSession, state: State, ds: str, buckets: int) -> DataFrame:
    """The stored state as a bucketed table over its folder."""
    spark.sql("CREATE DATABASE IF NOT EXISTS state")
    name, path = f"state.{state.name}_{ds}", f"{_folder(spark, state)}/{ds}_{buckets}/rows"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.orc(path).schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING orc CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def _write(rows: DataFrame, state: State, ds: str, buckets: int) -> None:
    spark = rows.sparkSession
    spark.sql("CREATE DATABASE IF NOT EXISTS state")
    name = f"state.{state.name}_{ds}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        rows.write.format("orc")
        .bucketBy(buckets, KEY)
        .sortBy(KEY)
        .option("path", f"{_folder(spark, state)}/{ds}_{buckets}/rows")
        .mode("overwrite")
        .saveAsTable(name)
    )


def build(spark: SparkSession, state: State, ds: str) -> None:
    """Build the state of ``ds`` from the newest older one, or from the whole history."""
    folder, days = _folder(spark, state), _days(spark, state)
    older = max((d for d in days if d < ds), default=None)
    increments = spark.table(state.table)
    if older is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        whole = increments.where(F.col("ds") <= ds)
        rows = latest_by(
            state.valid(whole, ds).select(*state.newest.columns),
            [state.newest.key], state.newest.newest_first, state.newest.ties,
        )
        rows, source = keyed(rows, state.newest).repartition(buckets, KEY), whole
    else:
        buckets = days[older]
        source = increments.where((F.col("ds") > older) & (F.col("ds") <= ds))
        if state.later:
            kept = spark.read.schema(source.schema).orc(f"{folder}/{older}_{buckets}/pending")
            source = source.unionByName(kept)
        rows = merge(_read(spark, state, older, buckets), state.valid(source, ds), state.newest, buckets)
    for name in names_in(spark, folder):
        if name.split("_")[0] == ds:  # a build that was cut off
            delete_folder(spark, f"{folder}/{name}")
    _write(rows, state, ds, buckets)
    if state.later:
        state.later(source, ds).write.mode("overwrite").orc(f"{folder}/{ds}_{buckets}/pending")
    create_marker(spark, f"{folder}/{ds}_{buckets}/{DONE}")
    _tidy(spark, state)


def _tidy(spark: SparkSession, state: State) -> None:
    folder, days = _folder(spark, state), _days(spark, state)
    for day in sorted(days)[:-KEPT_DAYS]:
        spark.sql(f"DROP TABLE IF EXISTS state.{state.name}_{day}")
        delete_folder(spark, f"{folder}/{day}_{days[day]}")


def newest(spark: SparkSession, state: State, ds: str) -> DataFrame:
    """Newest rows of each key as of ``ds``; built first if there is no state of that day."""
    parse_ds(ds)
    if ds not in _days(spark, state):
        build(spark, state, ds)
    return _read(spark, state, ds, _days(spark, state)[ds]).drop(KEY)
