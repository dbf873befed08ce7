"""Warehouse tables: ORC, partitioned by ``ds``, registered in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..bizdate import parse_ds
from ..errors import DataQualityError
from ..schemas import TABLES, Table
from ..storage import make_folder, names_in

# Folders of a table that scans of its root pass over, and the name that stands
# for ``ds`` in tables without partitions.
VERSIONS, POINTERS, WHOLE = "_versions", "_pointers", "all"


def create_statement(table: Table, root: str) -> str:
    columns = table.ddl + (", ds string" if table.partitioned else "")
    layout = " PARTITIONED BY (ds)" if table.partitioned else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}) USING orc "
        f"OPTIONS ('orc.compress' 'SNAPPY'){layout} LOCATION '{location(table.name, root)}'"
    )


def location(name: str, root: str) -> str:
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def create_all(spark: SparkSession, root: str) -> None:
    """Declare every table over its folder and find the partitions already there.

    A catalog that outlives the session knows its tables, and nothing is listed.
    Otherwise plain ``ds=`` folders are found by name, then the markers say where
    the current versions lie.
    """
    for database in sorted({name.split(".")[0] for name in TABLES}):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in TABLES.values():
        if spark.catalog.tableExists(table.name):
            continue
        base = location(table.name, root)
        make_folder(spark, base)
        spark.sql(create_statement(table, root))
        if table.partitioned:
            spark.catalog.recoverPartitions(table.name)
        for ds in names_in(spark, f"{base}/{POINTERS}"):
            markers = names_in(spark, f"{base}/{POINTERS}/{ds}")
            if markers:
                point(spark, table.name, ds, f"{base}/{VERSIONS}/{ds}/{markers[-1].split('_')[1]}")


def _place(spark: SparkSession, name: str, ds: str) -> str:
    spec = "" if ds == WHOLE else f" PARTITION (ds='{ds}')"
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}{spec}").where("col_name = 'Location'")
    return rows.first().data_type.removeprefix("file:")


def base_of(spark: SparkSession, name: str) -> str:
    """The table's folder, whichever version it points to."""
    return _place(spark, name, WHOLE).split(f"/{VERSIONS}/")[0].rstrip("/")


def current_path(spark: SparkSession, name: str, ds: str) -> str | None:
    """The folder that the catalog names for one ``ds`` or a whole table."""
    if ds != WHOLE and not has_partition(spark, name, ds):
        return None
    return _place(spark, name, ds)


def point(spark: SparkSession, name: str, ds: str, path: str | None) -> None:
    """Let the catalog name another folder for one ``ds`` or a whole table, or none."""
    if ds == WHOLE:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    elif path is None:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (ds='{ds}')")
    elif has_partition(spark, name, ds):
        spark.sql(f"ALTER TABLE {name} PARTITION (ds='{ds}') SET LOCATION '{path}'")
    else:
        spark.sql(f"ALTER TABLE {name} ADD PARTITION (ds='{ds}') LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def has_partition(spark: SparkSession, name: str, ds: str) -> bool:
    """Ask the catalog only; no data is read."""
    parse_ds(ds)
    return not spark.sql(f"SHOW PARTITIONS {name} PARTITION (ds='{ds}')").isEmpty()


def require_partition(spark: SparkSession, name: str, ds: str) -> None:
    if not has_partition(spark, name, ds):
        raise DataQualityError(f"{name} has no partition ds={ds}")


def read_partition(spark: SparkSession, name: str, ds: str) -> DataFrame:
    """One ``ds`` (with the ds column); the scan lists that partition alone."""
    return spark.table(name).where(F.col("ds") == ds)


def read_history(spark: SparkSession, name: str, ds: str) -> DataFrame:
    """All partitions up to ``ds``; text order of yyyyMMdd is date order."""
    return spark.table(name).where(F.col("ds") <= ds)
