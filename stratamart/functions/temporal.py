"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..bizdate import parse_ds

CONTRACT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def ds_date(ds: str) -> Column:
    return F.lit(parse_ds(ds))


def ds_of(time: Column) -> Column:
    """The yyyyMMdd day a time falls on."""
    return F.date_format(time, "yyyyMMdd")


def day_of(time: Column) -> Column:
    return F.to_date(time)


def on_or_before(time: Column, ds: str) -> Column:
    """``time`` falls on or before ``ds``, as a plain comparison scans can push down."""
    return F.to_date(time) <= ds_date(ds)


def contract_time(time: Column) -> Column:
    """Millisecond text form used in event messages (finer digits are cut)."""
    return F.date_format(time, CONTRACT_TIME_FORMAT)


def has_sub_millis(time: Column) -> Column:
    """True where a time carries digits below one millisecond."""
    return F.date_format(time, "SSSSSS").substr(4, 3) != F.lit("000")
