"""Writing warehouse tables: write a version, audit it, move the pointer.

A result is computed once, into a folder of its own under the table: a version,
which no reader sees. The checks read its ORC files (only the columns they
need), and publishing changes nothing but the place that the catalog names for
the partition, so a reader sees the old rows or the new ones, never a part, and
no row is copied. A result that breaks a rule, or a failure before the pointer
moves, leaves the table as it was. The version before the current one is kept
for queries that are still reading it; older ones go with the next swap.

The pointer is also an empty marker file, named by a growing number and its
version: a session whose catalog does not outlive it finds the current versions
by these (``sources.tables.create_all``).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..bizdate import parse_ds
from ..operators.quality import Contract, require
from ..schemas import TABLES
from ..sources.tables import POINTERS, VERSIONS, WHOLE, base_of, current_path, point
from ..storage import create_marker, delete_folder, files_of, names_in, size_of

FILE_BYTES = 256 * 1024 * 1024
#: A version of up to so many files, or so many times what its size needs, stays as it is.
FEW_FILES, MOST_TIMES = 8, 4


@dataclass(frozen=True)
class Staged:
    """A version of a table that is written but not published."""

    name: str
    ds: str
    rows: DataFrame
    path: str

    def drop(self) -> None:
        delete_folder(self.rows.sparkSession, self.path)


def _version(spark: SparkSession, name: str, ds: str) -> str:
    return f"{base_of(spark, name)}/{VERSIONS}/{ds}/{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, ds: str = WHOLE, watch: Observation | None = None,
          measures: list | None = None) -> Staged:
    """Compute ``df`` into a new version, in the table's column types.

    ``watch`` takes aggregate ``measures`` of the rows while they are written.
    """
    spark = df.sparkSession
    schema = TABLES[name].schema
    typed = df.select(*[F.col(c.name).cast(c.dataType) for c in schema])
    if watch is not None:
        typed = typed.observe(watch, *measures)
    path = _version(spark, name, ds)
    typed.write.orc(path)
    return _compacted(Staged(name, ds, spark.read.schema(schema).orc(path), path))


def _compacted(staged: Staged) -> Staged:
    """The version in fewer files, if tasks left many more than its size needs.

    Results of large shuffles come in files of AQE's advisory size and stay as
    they are; what is written again is many small files.
    """
    spark = staged.rows.sparkSession
    wanted = max(1, math.ceil(size_of(spark, staged.path) / FILE_BYTES))
    files = files_of(spark, staged.path) - 1  # but for the _SUCCESS mark
    if files <= max(FEW_FILES, MOST_TIMES * wanted):
        return staged
    path = _version(spark, staged.name, staged.ds)
    staged.rows.coalesce(wanted).write.orc(path)
    staged.drop()
    return Staged(staged.name, staged.ds, spark.read.schema(staged.rows.schema).orc(path), path)


def swap(staged: list[Staged]) -> None:
    """Publish versions together: all pointers move, or after a failure none.

    Spark has no transaction over tables: between two pointers a reader may see
    one table's new version and another's old one, for as long as the catalog
    takes, not as long as the rows take.
    """
    undo: list[Callable[[], None]] = []
    try:
        for one in staged:
            _move(one, undo)
    except BaseException:
        for step in reversed(undo):
            step()
        raise
    for one in staged:
        _tidy(one)


def _move(one: Staged, undo: list[Callable[[], None]]) -> None:
    spark, folder = one.rows.sparkSession, f"{base_of(one.rows.sparkSession, one.name)}/{POINTERS}/{one.ds}"
    before = current_path(spark, one.name, one.ds)
    last = names_in(spark, folder)
    number = int(last[-1].split("_")[0]) + 1 if last else 1
    marker = f"{folder}/{number:012d}_{one.path.rsplit('/', 1)[1]}"
    create_marker(spark, marker)
    undo.append(lambda: delete_folder(spark, marker))
    undo.append(lambda: point(spark, one.name, one.ds, before))
    point(spark, one.name, one.ds, one.path)


def _tidy(one: Staged) -> None:
    """Keep the current version and the one before it."""
    spark, base = one.rows.sparkSession, base_of(one.rows.sparkSession, one.name)
    markers = names_in(spark, f"{base}/{POINTERS}/{one.ds}")
    kept = {m.split("_")[1] for m in markers[-2:]}
    for marker in markers[:-2]:
        delete_folder(spark, f"{base}/{VERSIONS}/{one.ds}/{marker.split('_')[1]}")
        delete_folder(spark, f"{base}/{POINTERS}/{one.ds}/{marker}")
    if len(kept) == 2 and one.ds != WHOLE:
        delete_folder(spark, f"{base}/ds={one.ds}")  # rows that no pointer ever named


def _checked(staged: Staged, contract: Contract | None) -> int:
    return require(staged.rows, contract) if contract else staged.rows.count()


def _publish(df: DataFrame, name: str, ds: str, contract: Contract | None) -> int:
    staged = stage(df, name, ds)
    try:
        rows = _checked(staged, contract)
        swap([staged])
    except BaseException:
        staged.drop()
        raise
    return rows


def write_partition(df: DataFrame, name: str, ds: str, contract: Contract | None) -> int:
    """Replace one ``ds`` of a table by checked rows; other days stay as they are."""
    parse_ds(ds)
    return _publish(df, name, ds, contract)


def write_whole(df: DataFrame, name: str, contract: Contract | None = None) -> int:
    """Replace an unpartitioned table."""
    return _publish(df, name, WHOLE, contract)


def replace_day(
    frames: dict[str, DataFrame],
    ds: str,
    measures: dict[str, list] | None = None,
    check: Callable[[dict[str, DataFrame], dict[str, dict]], None] | None = None,
) -> dict[str, int]:
    """Replace one day of several tables together.

    All tables are staged before the first pointer moves, so a failing source,
    or a ``check`` of the staged rows and of the ``measures`` taken while they
    were written, leaves every table as it was.
    """
    parse_ds(ds)
    staged: list[Staged] = []
    seen: dict[str, dict] = {}
    try:
        for name, df in frames.items():
            watch = Observation()
            taken = [F.count(F.lit(1)).alias("row_count"), *(measures or {}).get(name, [])]
            staged.append(stage(df, name, ds, watch, taken))
            seen[name] = watch.get
        if check:
            check({one.name: one.rows for one in staged}, seen)
        swap(staged)
    except BaseException:
        for one in staged:
            one.drop()
        raise
    return {name: found["row_count"] for name, found in seen.items()}
