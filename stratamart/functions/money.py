"""Exact decimal expressions. Money never passes through double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,2)"
RATE = "decimal(10,6)"


def money(value: Column) -> Column:
    """Half-up rounding to cents."""
    return value.cast(MONEY)


def rate(value: Column) -> Column:
    return value.cast(RATE)


def ratio(numerator: Column, denominator: Column, as_type: str) -> Column:
    """``numerator / denominator`` as a decimal, zero where the denominator is zero."""
    exact = numerator.cast("decimal(22,2)") / denominator
    return F.when(denominator == 0, F.lit(0)).otherwise(exact).cast(as_type)


def count_of(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")
