"""Sharding by rendezvous hashing over weighted shards.

A record's key is hashed with every shard's number to a uniform value u; the
record goes to the shard with the least -ln(u) / weight. A shard more can only
win records for itself, so no record moves between old shards.

Defined results: a null text counts no bytes and has the checksum of the empty
text; null keys are hashed as the empty text; repeated rows go to one shard and
get slots of their own; an empty table gives an empty one; other columns stay,
except that ``shard`` replaces columns named like the two that it adds. Slots are
given in ranges of rows that a row number ends, so a key may hold any share of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import cells, fresh, numbered, part_of_md5, stored, table

SHARDS = 16
SHARD, SLOT = "__shard", "__slot"


def owner(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a record key; ties go to the smaller number."""
    text = F.coalesce(key.cast("string"), F.lit(""))

    def cost(shard: int, weight: float) -> Column:
        mixed = part_of_md5(F.concat(text, F.lit(f":{shard}")), 1, 13)
        uniform = (mixed + F.lit(0.5)) / F.lit(float(2**52))
        return F.struct((-F.log(uniform) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard"))

    return F.array_min(F.array(*[cost(i, w) for i, w in enumerate(weights)])).getField("shard")


def slots(rows: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS) -> DataFrame:
    """``rows`` (row, key, ...), stored, with ``shard`` and ``slot``, the gapless place in it."""
    high, low = cells(F.col("key"), rows.count() // max(1, len(weights)))
    placed = rows.withColumns({"shard": owner(F.col("key"), weights), "high": high, "low": low})
    return numbered(placed, ["shard"], ["high", "low", "key", "row"], "slot", "rows").drop("high", "low", "rows")


def shard(docs: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS) -> DataFrame:
    """``docs`` with ``__shard`` and ``__slot``, the gapless place in the shard."""
    docs = docs.drop(SHARD, SLOT)
    row = fresh("__shard_row", docs)
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    placed = slots(kept.select(F.col(row).alias("row"), F.col(key).alias("key")), weights)
    found = placed.select(F.col("row").alias(row), F.col("shard").alias(SHARD), F.col("slot").alias(SLOT))
    # The slim side is built in memory, so the texts are not sorted.
    return kept.join(found.hint("shuffle_hash"), row).drop(row)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").alias("key"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
    )
    return slots(slim).select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        owner(F.col("key"), (1.0,) * (SHARDS + 1)).alias("grown_shard"),
    )


#: CRC-32 (reflected polynomial 0xEDB88320) runs over the low, then the high
#: half of each byte with a table of 16 values that the polynomial gives.
OP8_SQL = r"""
with half as (
  select list(v order by i) as steps from (
    select i, list_reduce([i::bigint, 0, 0, 0, 0],
           lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) as v
    from range(16) t(i))),
texts as (
  select distinct coalesce(text, '') as text from documents),
sums as (
  select text, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
         list_transform(string_split(regexp_replace(hex(encode(text)), '(.)(.)', '\2\1', 'g'), ''),
                        lambda d: (position(d in '0123456789ABCDEF') - 1)::bigint)),
         lambda a, d: xor(a >> 4, steps[((xor(a, d) & 15) + 1)::int]))) as crc
  from texts, half where text <> ''),
owners as (
  select coalesce(doc_id::varchar, '') as k, n, arg_min(s, (cost, s)) as shard
  from (select distinct doc_id from documents), (values (16), (17)) c(n), range(17) t(s),
       lateral (select -ln((('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || s), 1, 13))::bigint + 0.5)
                / 4503599627370496.0::double) as cost)
  where s < n group by 1, 2),
placed as (
  select d.doc_id, strlen(coalesce(d.text, ''))::bigint + 1 as size, coalesce(sums.crc, 0) as text_crc32,
         a.shard::int as shard, b.shard::int as grown_shard, md5(a.k) as h,
         greatest(1, ceil(sqrt(((select count(*) from documents) // 16) / 4096.0)))::bigint as side
  from documents d
  join owners a on a.k = coalesce(d.doc_id::varchar, '') and a.n = 16
  join owners b on b.k = a.k and b.n = 17
  left join sums on sums.text = d.text)
select doc_id, size, text_crc32, 'key' as law, shard,
       row_number() over (partition by shard order by ('0x' || substr(h, 1, 8))::bigint % side,
         ('0x' || substr(h, 9, 8))::bigint % side, doc_id) - 1 as slot, grown_shard
from placed
"""
