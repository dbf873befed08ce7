"""Daily increments: which source columns to take, and by which time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..bizdate import day_bounds
from ..schemas import columns_of


@dataclass(frozen=True)
class Ingest:
    source: str
    target: str
    time_column: str

    @property
    def columns(self) -> list[str]:
        return columns_of(self.target)


INGESTS = (
    Ingest("order_info", "ods.ods_order_info_di", "create_time"),
    Ingest("order_detail", "ods.ods_order_detail_di", "create_time"),
    Ingest("payment_info", "ods.ods_payment_info_di", "payment_time"),
    Ingest("user_behavior", "ods.ods_user_behavior_di", "event_time"),
    Ingest("rating_info", "ods.ods_rating_info_di", "rating_time"),
)


def one_day(source: DataFrame, ingest: Ingest, ds: str) -> DataFrame:
    """Rows of [ds 00:00, next day 00:00), listed columns only.

    Plain comparisons on the time column, so they reach a file or JDBC scan.
    """
    start, end = day_bounds(ds)
    kind = source.schema[ingest.time_column].dataType.simpleString()
    time = F.col(ingest.time_column)
    return source.where(
        (time >= F.lit(str(start)).cast(kind)) & (time < F.lit(str(end)).cast(kind))
    ).select(*ingest.columns)
