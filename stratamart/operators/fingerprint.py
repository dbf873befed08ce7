"""Order-independent fingerprints of tables, for comparing a source with its copy.

A row becomes a text of its values, each with its length, and that text an MD5.
Two 32-bit parts of it are summed over all rows of a slice: the sums do not
depend on order or partitioning, they change if a row is lost, doubled or
altered, and they are plain aggregates, so a database can compute them where the
rows are (``in_database``) while Spark computes them on what it stored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SUMS = ("row_count", "hash_a", "hash_b")


def value_text(column: Column, kind: str) -> Column:
    """The text that a value has in both systems; ``kind`` is the type in the target."""
    if kind.startswith("timestamp"):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return column.cast(kind).cast("string")


def row_text(schema: StructType) -> Column:
    """Each value with its number of characters; ``-`` for NULL."""
    texts = [value_text(F.col(f.name), f.dataType.simpleString()) for f in schema]
    return F.concat(
        *[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    )


def _parts(text: Column) -> Column:
    """The first 64 bits of the MD5, which hold both parts, as a signed number."""
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("bigint")


def _sum(part: Column) -> Column:
    """Exact sum of 32-bit numbers, in halves: as decimals they would cost more than
    the texts, and as whole numbers overflow 64 bits at two billion rows."""
    high, low = F.shiftright(part, 16), part.bitwiseAND(F.lit(0xFFFF))
    whole = [F.coalesce(F.sum(half), F.lit(0)).cast("decimal(20,0)") for half in (high, low)]
    return (whole[0] * F.lit(1 << 16).cast("decimal(5,0)") + whole[1]).cast("decimal(38,0)")


def fingerprint(df: DataFrame, schema: StructType, by: Sequence[Column | str] = ()) -> DataFrame:
    """``row_count``, ``hash_a``, ``hash_b`` of each slice; combined before the shuffle."""
    slices = [F.col(c) if isinstance(c, str) else c for c in by]
    rows = df.select(*slices, _parts(row_text(schema)).alias("_parts"))
    parts = F.col("_parts")
    return rows.groupBy(*rows.columns[:-1]).agg(
        F.count(F.lit(1)).alias("row_count"),
        _sum(F.shiftrightunsigned(parts, 32)).alias("hash_a"),
        _sum(parts.bitwiseAND(F.lit(0xFFFFFFFF))).alias("hash_b"),
    )


def in_database(schema: StructType, table: str, where: str, by: Mapping[str, str]) -> str:
    """The same as a query that a MySQL-like database runs: one row per slice goes out."""
    def text(field) -> str:
        kind, name = field.dataType.simpleString(), field.name
        if kind.startswith("timestamp"):
            value = f"date_format({name}, '%Y-%m-%d %H:%i:%s.%f')"
        else:
            value = f"cast({name} as char)"
        return f"coalesce(concat(char_length({value}), ':', {value}), '-')"

    row = f"md5(concat({', '.join(text(f) for f in schema)}))"
    keys = ", ".join(f"{expression} as {name}" for name, expression in by.items())
    sums = ", ".join(
        f"sum(cast(conv(substr({row}, {first}, 8), 16, 10) as decimal(38,0))) as {name}"
        for name, first in (("hash_a", 1), ("hash_b", 9))
    )
    group = ", ".join(str(i + 1) for i in range(len(by)))
    return f"(select {keys}, count(*) as row_count, {sums} from {table} where {where} group by {group}) f"


def differences(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """Slices of either side and whether they agree; a slice that one side lacks has no rows there."""
    empty = {c: F.lit(0).cast("decimal(38,0)") for c in SUMS}

    def side(df: DataFrame, name: str) -> DataFrame:
        own = {f"{name}_{c}": F.col(c).cast("decimal(38,0)") for c in SUMS}
        other = {f"{'target' if name == 'source' else 'source'}_{c}": empty[c] for c in SUMS}
        columns = own | other
        return df.select(*by, *[columns[c].alias(c) for c in sorted(columns)])

    both = side(source, "source").unionByName(side(target, "target"))
    sums = both.groupBy(*by).agg(*[F.sum(f"{s}_{c}").alias(f"{s}_{c}") for s in ("source", "target") for c in SUMS])
    equal = [F.col(f"source_{c}") == F.col(f"target_{c}") for c in SUMS]
    return sums.withColumn("is_equal", equal[0] & equal[1] & equal[2])
