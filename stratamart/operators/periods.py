"""Statistic periods 1d, 7d, 30d and all, which end at the same cutoff day.

The periods are nested, which gives two cheap forms:

* an additive metric of every period is a conditional sum in one pass, with no
  row multiplied;
* an entity (user, order) is active in a period exactly when its *latest* day
  not after the cutoff reaches the period start, so distinct counts need one
  ``max(day)`` per entity instead of one distinct set per period.

``fan_out`` (one row per row and period) stays for metrics that fit neither.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..bizdate import parse_ds

# Period label and days before the cutoff (None = open start).
PERIOD_DAYS = {"1d": 0, "7d": 6, "30d": 29, "all": None}
PERIODS = tuple(PERIOD_DAYS)
OPEN_START = date(1900, 1, 1)


def period_rows(cutoff: Column) -> Column:
    """Generate four rows (stat_period, start_date) from a cutoff date."""
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(p).alias("stat_period"),
                    (F.lit(OPEN_START) if n is None else F.date_sub(cutoff, n)).alias(
                        "start_date"
                    ),
                )
                for p, n in PERIOD_DAYS.items()
            ]
        )
    )


class Periods:
    """The four periods that end at ``ds``."""

    def __init__(self, ds: str):
        self.cutoff = parse_ds(ds)
        self.starts = {
            label: OPEN_START if back is None else self.cutoff - timedelta(days=back)
            for label, back in PERIOD_DAYS.items()
        }

    def table(self, spark: SparkSession) -> DataFrame:
        """Four rows: stat_period, start_date."""
        return spark.range(0, 1, 1, 1).select(period_rows(F.lit(self.cutoff)))

    def known(self, day: Column) -> Column:
        """The day lies in the widest period."""
        return day.between(F.lit(OPEN_START), F.lit(self.cutoff))

    def hit(self, day: Column, period: str) -> Column:
        return day.between(F.lit(self.starts[period]), F.lit(self.cutoff))

    def each(self, name: str, build: Callable[[str], Column]) -> list[Column]:
        """One aliased column ``name__period`` per period."""
        return [build(p).alias(f"{name}__{p}") for p in PERIODS]

    def count_hits(self, name: str, day: Column, *when: Column) -> list[Column]:
        """Rows whose day falls in the period (and which meet ``when``)."""
        return self.each(name, lambda p: F.count_if(_all(self.hit(day, p), *when)))

    def sum_hits(self, name: str, day: Column, value: Column) -> list[Column]:
        return self.each(name, lambda p: F.sum(F.when(self.hit(day, p), value)))

    def sums(self, name: str) -> list[Column]:
        """Second-level sum of columns made by ``count_hits`` or ``sum_hits``."""
        return self.each(name, lambda p: F.sum(f"{name}__{p}"))

    def long_form(
        self,
        wide: DataFrame,
        keys: Sequence[str],
        metrics: Mapping[str, str],
        present: str | None = None,
    ) -> DataFrame:
        """Turn one wide row per key into one row per key and period.

        ``metrics`` maps a metric name to its type; NULL becomes zero.
        ``present`` names a day column: periods it does not reach are dropped.
        """
        rows = []
        for p in PERIODS:
            fields = [F.lit(p).alias("stat_period")] + [
                F.coalesce(F.col(f"{m}__{p}"), F.lit(0)).cast(t).alias(m)
                for m, t in metrics.items()
            ]
            rows.append(F.when(self._reaches(p, present), F.struct(*fields)))
        packed = wide.select(*keys, F.explode(F.array_compact(F.array(*rows))).alias("_p"))
        return packed.select("_p.stat_period", *keys, *[f"_p.{m}" for m in metrics])

    def _reaches(self, period: str, day: str | None) -> Column:
        return F.lit(True) if day is None else F.col(day) >= F.lit(self.starts[period])

    def reached_by(self, name: str, day: Column, *when: Column) -> list[Column]:
        """Entities whose latest day reaches the period (distinct counts)."""
        return self.each(
            name, lambda p: F.count_if(_all(day >= F.lit(self.starts[p]), *when))
        )

    def fan_out(self, df: DataFrame, day: str) -> DataFrame:
        """One row per row and period it falls in; rows in no period vanish."""
        labels = F.array_compact(
            F.array(*[F.when(self.hit(F.col(day), p), F.lit(p)) for p in PERIODS])
        )
        return df.withColumn("stat_period", F.explode(labels))

    def fill(self, aggregated: DataFrame, zeros: Mapping[str, str]) -> DataFrame:
        """Left join the four periods to an aggregate so that empty ones give zeros."""
        filled = [
            F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c) for c, t in zeros.items()
        ]
        periods = self.table(aggregated.sparkSession).select("stat_period")
        return periods.join(aggregated, "stat_period", "left").select(
            "stat_period", *filled
        )


def _all(first: Column, *rest: Column) -> Column:
    for condition in rest:
        first = first & condition
    return first
