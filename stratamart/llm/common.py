"""Shared helpers: tables, the shared scratch folder, words, positions in groups."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Keys of one cell (``cells``) and rows of one range (``numbered``) on average at most.
CELL_ROWS = 4096
RANGE_ROWS = 65536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors share.

    Only a session without that setting (a test on one machine) gets a local
    folder of its own, kept for the rest of the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.

    Cuts the lineage like a checkpoint: a lost executor costs a re-read, not a
    recomputation, and every later use sees the same rows.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def part_of_md5(text: Column, first_digit: int, digits: int) -> Column:
    """Hexadecimal digits of the MD5 of a text, as a whole number (13 at most)."""
    return F.conv(F.substring(F.md5(text), first_digit, digits), 16, 10).cast("long")


def drawn(docs: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows (text) of ``docs`` (doc_id, text), drawn by a hash of doc_id and text.

    Rows without doc_id are drawn like others, by their text. The numbers alone
    are sorted first, each with its count, so copies of one row fill no task;
    texts of rows beyond the last number drawn leave no task, and of the rows of
    one number no more than ``most`` do.
    """
    text = F.coalesce("text", F.lit(""))
    turn = part_of_md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(text)), 1, 12)
    numbered_ = docs.select(turn.alias("turn"), "text")
    turns = numbered_.groupBy("turn").agg(F.count(F.lit(1)).alias("rows"))
    last = turns.orderBy("turn").limit(most).agg(F.max("turn").alias("turn")).first().turn
    near = numbered_.filter(F.col("turn") <= F.lit(-1 if last is None else last))
    # Rows of one number are copies of one row, up to chance.
    once = near.groupBy("turn").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("rows"))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.least("rows", F.lit(most).cast("long"))))
    return once.select("turn", "text", again.alias("copy")).orderBy("turn", "copy").limit(most).select("text")


def crc_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def fresh(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str, size: str) -> DataFrame:
    """``rows`` with ``name``, the place from 0 within the group in the given order,
    and ``size``, the rows of the group.

    Rows are dealt in ranges of (group, order), the place is the rows in ranges
    before plus the place within the range: a group with any share of all rows is
    spread. ``order`` must end in a column without ties, such as a row number, so
    that equal rows are spread too. ``rows`` is read twice: store it if it is dear.
    """
    part, before = "__range", "__before"
    ranges = max(1, math.ceil(rows.count() / RANGE_ROWS))
    dealt = rows.repartitionByRange(ranges, *group, *order)
    dealt = stored(dealt.withColumn(part, F.spark_partition_id()))
    counts = dealt.groupBy(*group, part).agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *group,
        part,
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias(before),
        F.sum("__rows").over(Window.partitionBy(*group)).alias(size),
    )
    place = F.row_number().over(Window.partitionBy(*group, part).orderBy(*order))
    return (
        dealt.join(starts, [*group, part])
        .withColumn(name, (F.col(before) + place - 1).cast("long"))
        .drop(part, before)
    )


def cells(key: Column, rows: int) -> tuple[Column, Column]:
    """Two whole numbers of a key that spread keys over about ``rows`` / ``CELL_ROWS`` cells."""
    side = max(1, math.ceil(math.sqrt(rows / CELL_ROWS)))
    text = F.coalesce(key.cast("string"), F.lit(""))
    return tuple((part_of_md5(text, first, 8) % side).cast("int") for first in (1, 9))
