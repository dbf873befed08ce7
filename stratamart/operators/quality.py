"""Data-quality rules.

A ``Contract`` lists what a dataset must satisfy. ``profile`` measures every
rule in one grouped pass (one shuffle on the key, combined on the map side),
instead of one job per rule; ``require`` raises when a rule is broken, and
``broken_rows`` returns the offending rows for a report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DataQualityError


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def outside(column: str, allowed: Sequence) -> Column:
    return ~F.col(column).isin(*allowed)


def negative(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns])


def not_between(column: str, low, high) -> Column:
    return ~F.col(column).between(low, high)


@dataclass(frozen=True)
class Contract:
    name: str
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    #: rule name -> SQL condition that is true for a bad row
    forbidden: Mapping[str, str] = field(default_factory=dict)
    rows: int | None = None
    not_empty: bool = False
    columns: tuple[str, ...] = ()

    def row_rules(self) -> dict[str, Column]:
        rules = {rule: F.expr(text) for rule, text in self.forbidden.items()}
        if self.required:
            rules = {"required_is_null": any_null(self.required), **rules}
        return rules


def profile(df: DataFrame, contract: Contract) -> DataFrame:
    """One row: row_count, repeated_keys and the bad rows of each rule."""
    rules = contract.row_rules()
    per_key = df.groupBy(*contract.key).agg(
        F.count("*").alias("_rows"),
        *[F.count_if(bad).alias(f"_r{i}") for i, bad in enumerate(rules.values())],
    )

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return per_key.agg(
        total("_rows").alias("row_count"),
        F.count_if(F.col("_rows") > 1).alias("repeated_keys"),
        *[total(f"_r{i}").alias(rule) for i, rule in enumerate(rules)],
    )


def broken_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Each bad row once per rule it breaks: rule name and key."""
    rules = contract.row_rules()
    hits = F.array_compact(
        F.array(*[F.when(bad, F.lit(rule)) for rule, bad in rules.items()])
    )
    return df.select(F.explode(hits).alias("rule"), *contract.key)


def require(df: DataFrame, contract: Contract) -> int:
    """Check ``df`` with one job, raise DataQualityError, return the row count."""
    if contract.columns and tuple(df.columns) != contract.columns:
        raise DataQualityError(
            f"{contract.name}: column order {df.columns} is not {list(contract.columns)}"
        )
    seen = profile(df, contract).first().asDict()
    rows = seen.pop("row_count")
    broken = [f"{rule}={count}" for rule, count in seen.items() if count]
    if contract.rows is not None and rows != contract.rows:
        broken.append(f"row_count={rows}, expected {contract.rows}")
    if contract.not_empty and rows == 0:
        broken.append("no rows")
    if broken:
        raise DataQualityError(f"{contract.name}: " + ", ".join(broken))
    return rows
