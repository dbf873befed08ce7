"""Publishing result sets: check, delete the day, append, read back."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..bizdate import parse_ds
from ..errors import DataQualityError
from ..operators.quality import require
from ..plans.contracts import PUBLISH, PUBLISHED_COLUMNS, RANKED_ONCE
from ..sources.jdbc import Endpoint
from ..storage import delete_folder


class ResultStore(Protocol):
    def delete_day(self, table: str, ds: str) -> None: ...

    def append(self, df: DataFrame, table: str) -> None: ...

    def day_counts(self, table: str, ds: str, keys: list[str]) -> tuple[int, int]: ...


class JdbcResultStore:
    """A result database reached over JDBC.

    The delete runs in the driver in its own transaction (DataFrames cannot
    delete). The append is done by the executors, one transaction per task, so
    a reader may see part of a day until it ends.
    """

    def __init__(self, spark: SparkSession, db: Endpoint, schema: str = ""):
        self.spark = spark
        self.db = db
        self.schema = schema

    def _name(self, table: str) -> str:
        bare = table.split(".")[-1]
        return f"{self.schema}.{bare}" if self.schema else bare

    def delete_day(self, table: str, ds: str) -> None:
        jvm = self.spark.sparkContext._jvm
        jvm.java.lang.Class.forName(self.db.driver)
        connection = jvm.java.sql.DriverManager.getConnection(
            self.db.url, self.db.user, self.db.password
        )
        # One statement, which the connection commits by itself or not at all.
        gone = f"DELETE FROM {self._name(table)} WHERE ds = ?"
        try:
            query = connection.prepareStatement(gone)
            query.setString(1, ds)
            query.executeUpdate()
        finally:
            connection.close()

    def append(self, df: DataFrame, table: str) -> None:
        df.write.jdbc(
            self.db.url, self._name(table), mode="append", properties=self.db.properties
        )

    def day_counts(self, table: str, ds: str, keys: list[str]) -> tuple[int, int]:
        """Counted by the database, so one row travels."""
        query = (
            f"SELECT count(1) AS row_count, count(DISTINCT {', '.join(keys)}) AS key_count "
            f"FROM {self._name(table)} WHERE ds = '{ds}'"
        )
        row: Row = (
            self.spark.read.format("jdbc")
            .options(url=self.db.url, query=query, **self.db.properties)
            .load()
            .first()
        )
        return row["row_count"], row["key_count"]


class FolderResultStore:
    """Result tables as parquet folders partitioned by ds."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def delete_day(self, table: str, ds: str) -> None:
        delete_folder(self.spark, f"{self._path(table)}/ds={ds}")

    def append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").partitionBy("ds").parquet(self._path(table))

    def day_counts(self, table: str, ds: str, keys: list[str]) -> tuple[int, int]:
        day = self.spark.read.parquet(f"{self._path(table)}/ds={ds}")
        row = day.agg(
            F.count("*").alias("row_count"), F.countDistinct(*keys).alias("key_count")
        ).first()
        return row["row_count"], row["key_count"]


def publishable(result: DataFrame, table: str, ds: str) -> DataFrame:
    """The published columns of one day; the risk flag becomes 0 or 1."""
    rows = result.withColumn("ds", F.lit(ds))
    if "risk_flag" in rows.columns:
        rows = rows.withColumn("risk_flag", F.col("risk_flag").cast("tinyint"))
    return rows.select(*PUBLISHED_COLUMNS[table])


def publish(result: DataFrame, table: str, ds: str, store: ResultStore) -> int:
    """Replace one day of a result table; raises before touching it if a rule is broken.

    Result sets are small by definition (4 rows, 3 x 4 x 10 rows, or 4 rows
    per shop), so caching them for the check and the append is bounded.
    """
    parse_ds(ds)
    rows = publishable(result, table, ds).persist()
    try:
        count = require(rows, PUBLISH[table])
        if table == "ads.ads_sku_topn_df":
            require(rows, RANKED_ONCE)
        store.delete_day(table, ds)
        store.append(rows, table)
        keys = [k for k in PUBLISH[table].key if k != "ds"]
        seen = store.day_counts(table, ds, keys)
        if seen != (count, count):
            raise DataQualityError(
                f"{table} ds={ds}: sent {count} rows, found rows and keys {seen}"
            )
        return count
    finally:
        rows.unpersist()
