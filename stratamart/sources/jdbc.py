"""JDBC source: one business day of a fact table, or a whole dimension."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..bizdate import day_slices
from ..operators.fingerprint import in_database
from ..plans.ods import INGESTS, Ingest
from ..schemas import TABLES

BY_SOURCE = {i.source: i for i in INGESTS}


@dataclass(frozen=True)
class Endpoint:
    """Connection of one database; credentials come from the environment."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str

    @classmethod
    def from_env(cls, prefix: str) -> Endpoint:
        def value(name: str) -> str:
            return os.environ[f"{prefix}_{name}"]

        return cls(value("URL"), value("USER"), value("PASSWORD"), value("DRIVER"))

    @property
    def properties(self) -> dict[str, str]:
        return {"user": self.user, "password": self.password, "driver": self.driver}


def day_predicates(ingest: Ingest, ds: str, slices: int) -> list[str]:
    """Disjoint half-open time ranges that together are exactly the day."""

    def text(moment) -> str:
        return moment.strftime("%Y-%m-%d %H:%M:%S.%f")

    return [
        f"{ingest.time_column} >= '{text(low)}' and {ingest.time_column} < '{text(high)}'"
        for low, high in day_slices(ds, slices)
    ]


def read_day(
    spark: SparkSession, db: Endpoint, ingest: Ingest, ds: str, slices: int = 24
) -> DataFrame:
    """One day of a fact table, read by ``slices`` parallel connections.

    Each slice's range goes into the database's WHERE clause and the column
    selection into its SELECT list, so only needed rows and columns travel.
    """
    return spark.read.jdbc(
        db.url,
        ingest.source,
        predicates=day_predicates(ingest, ds, slices),
        properties={**db.properties, "fetchsize": "10000"},
    ).select(*ingest.columns)


class DaySource:
    """One business day of every fact: rows by table name, and their fingerprints.

    The fingerprint is computed by the database itself, per hour of the fact's
    time, so at most 24 rows a table travel for it.
    """

    def __init__(self, spark: SparkSession, db: Endpoint, ds: str, slices: int = 24) -> None:
        self.spark, self.db, self.ds, self.slices = spark, db, ds, slices

    def __call__(self, table: str) -> DataFrame:
        return read_day(self.spark, self.db, BY_SOURCE[table], self.ds, self.slices)

    def fingerprint(self, table: str) -> DataFrame:
        return self.spark.read.jdbc(
            self.db.url, fingerprint_query(BY_SOURCE[table], self.ds), properties=self.db.properties
        )


def fingerprint_query(ingest: Ingest, ds: str) -> str:
    (day,) = day_predicates(ingest, ds, 1)
    by = {"hour": f"hour({ingest.time_column})"}
    return in_database(TABLES[ingest.target].schema, ingest.source, day, by)


#: Parts that a range of ids is counted in at once.
FAN = 64
DIMENSION_KEYS = {"shop_info": "shop_id", "sku_info": "sku_id"}
Count = Callable[[int, int, int], dict[int, int]]


def balanced_ranges(count: Count, low: int, high: int, rows: int, parts: int) -> list[tuple[int, int]]:
    """Half-open id ranges over [low, high) with about equal rows, whatever ids are in use.

    ``count(low, high, width)`` gives the rows of each part of ``width`` ids, by
    the part's number. A part with more than its share is counted again in finer
    parts, so a range holds at most twice its share (a single id may hold more).
    """
    share = max(1, -(-rows // max(1, parts)))
    leaves: list[tuple[int, int, int]] = []

    def refine(begin: int, end: int) -> None:
        width = max(1, -(-(end - begin) // FAN))
        for number, n in sorted(count(begin, end, width).items()):
            first = begin + number * width
            last = min(first + width, end)
            if n > share and last - first > 1:
                refine(first, last)
            else:
                leaves.append((first, last, n))

    refine(low, high)
    edges, held = [low], 0
    for first, _, n in leaves:
        if held and held + n > share and first > edges[-1]:
            edges.append(first)
            held = 0
        held += n
    return list(zip(edges, [*edges[1:], high], strict=True))


def range_predicates(key: str, ranges: list[tuple[int, int]]) -> list[str]:
    """Disjoint conditions that cover every row: open at both ends, NULL in the first."""
    inner = [low for low, _ in ranges][1:]
    if not inner:
        return ["1 = 1"]
    between = [f"{key} >= {a} and {key} < {b}" for a, b in zip(inner, inner[1:])]
    return [f"{key} < {inner[0]} or {key} is null", *between, f"{key} >= {inner[-1]}"]


class DimensionSource:
    """Whole dimensions, read by parallel connections over balanced id ranges.

    The database counts the ids; a few rows of counts travel to plan the ranges.
    """

    def __init__(self, spark: SparkSession, db: Endpoint, slices: int = 24) -> None:
        self.spark, self.db, self.slices = spark, db, slices

    def _ask(self, query: str) -> DataFrame:
        return self.spark.read.jdbc(self.db.url, query, properties=self.db.properties)

    def ranges(self, table: str) -> list[str]:
        key = DIMENSION_KEYS[table]
        size = self._ask(f"(select min({key}) as low, max({key}) as high, count(*) as n from {table}) q").first()
        if size.low is None:
            return ["1 = 1"]

        def count(low: int, high: int, width: int) -> dict[int, int]:
            part = f"floor(({key} - {low}) / {width})"
            where = f"{key} >= {low} and {key} < {high}"
            rows = self._ask(f"(select {part} as part, count(*) as n from {table} where {where} group by {part}) q")
            return {int(r.part): int(r.n) for r in rows.collect()}  # FAN rows at most

        found = balanced_ranges(count, int(size.low), int(size.high) + 1, int(size.n), self.slices)
        return range_predicates(key, found)

    def __call__(self, table: str) -> DataFrame:
        properties = {**self.db.properties, "fetchsize": "10000"}
        return self.spark.read.jdbc(self.db.url, table, predicates=self.ranges(table), properties=properties)
