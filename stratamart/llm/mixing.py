"""Mix sources to target weights by systematic sampling.

Each source gets a target in words. Every document of a source has the same
expected number of copies, target / size of the source. Documents are laid out
in a line within their source, each as long as its expected copies; one random
offset per source is added, and a document is emitted once per whole number
that its stretch of the line crosses. The line runs from short to long
documents (by the leading digits of their size), so the words taken stay within
about one long document of the target. Within a size band the order is by cells of the
doc_id's MD5, whose number grows with the table: a document of a larger table may
stand elsewhere in the line and be taken though it was not before.

Sizes are computed once and stored with a row number; the plan works on these slim
rows in ranges of the line, which the row number ends, so neither a source nor a
doc_id nor a text with any share of all rows gathers in one task. Texts meet their
copies by row number.

Defined results: a null text has size 0; null sources are one source, the last
one; empty documents take copies like others but no words; repeated rows are
separate documents; an empty table gives an empty one; other columns are kept,
except that ``mix`` replaces columns named like those it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.common import cells, fresh, numbered, part_of_md5, stored, table

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
SIZE, SOURCE_SIZE, TARGET, COPIES = "__mix_size", "__mix_source_size", "__mix_target", "__mix_copies"
KEY, BAND, HIGH, LOW, PLACE = "key", "band", "high", "low", "place"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Target of each source from (key, source, source_size): one row per source.

    All words of the corpus are shared by weight; a source stops at ``cap``
    times its size and the excess goes to the others. Sorted by cap per weight,
    the capped sources come first, so the level of the rest is the first one
    that its source does not exceed. This holds one row per source name: a
    dimension, not the corpus.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn(
        "weight", F.element_at(kinds, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    )
    limit = F.col("source_size") * F.lit(float(cap))
    line = Window.orderBy(limit / F.col("weight"), KEY)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    after = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(after)
    marked = ranked.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= limit)
    turn = F.struct((limit / F.col("weight")).alias("turn"), KEY, "level")
    first = F.min(F.when(F.col("free"), turn)).over(everything).getField("level")
    return marked.withColumn("target", F.least(limit, first * F.col("weight"))).select(
        KEY, "source_size", "target"
    )


def plan(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED
) -> DataFrame:
    """(row, doc_id, size, source_size, target, copies) from (row, doc_id, source, size)."""
    digits = F.col("size").cast("string")
    high, low = cells(F.col("doc_id"), rows.count())
    slim = rows.withColumns(
        {
            KEY: F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
            BAND: (F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")).cast("int"),
            HIGH: high,
            LOW: low,
        }
    )
    per_source = slim.groupBy(KEY, "source").agg(F.sum("size").alias("source_size"))
    line = slim.select("row", "doc_id", "size", KEY, BAND, HIGH, LOW)
    placed = numbered(line, [KEY], [BAND, HIGH, LOW, "size", "doc_id", "row"], PLACE, "rows")
    offset = part_of_md5(F.concat(F.lit(seed), F.col(KEY)), 1, 13) / F.lit(float(2**52))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(offset + (F.col(PLACE) + 1) * rate) - F.floor(offset + F.col(PLACE) * rate)
    return placed.join(targets(per_source, weights, cap), KEY).select(
        "row", "doc_id", "size", "source_size", "target", F.least(crossed, F.lit(cap).cast("long")).alias("copies")
    )


def sized(docs: DataFrame, row: Column, text: str) -> DataFrame:
    """The slim rows, written once: the texts are counted here and nowhere else."""
    return stored(docs.select(row.alias("row"), "doc_id", "source", words(F.col(text)).alias("size")))


def mix(
    docs: DataFrame,
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    seed: str = SEED,
) -> DataFrame:
    """All columns of ``docs`` plus ``__mix_size``, ``__mix_source_size``,
    ``__mix_target`` and ``__mix_copies``: how often the mix takes the row."""
    docs = docs.drop(SIZE, SOURCE_SIZE, TARGET, COPIES)
    row = fresh("__mix_row", docs)
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    copies = plan(sized(kept, F.col(row), text), weights, cap, seed).select(
        F.col("row").alias(row),
        F.col("size").alias(SIZE),
        F.col("source_size").alias(SOURCE_SIZE),
        F.col("target").alias(TARGET),
        F.col("copies").alias(COPIES),
    )
    # The slim side is built in memory, so the texts are not sorted.
    return kept.join(copies.hint("shuffle_hash"), row).drop(row)


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken, with its own columns."""
    row, times = fresh("__mix_row", docs), fresh("__mix_times", docs)
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    taken = plan(sized(kept, F.col(row), "text")).filter("copies > 0")
    joined = kept.join(taken.select(F.col("row").alias(row), F.col("copies").alias(times)).hint("shuffle_hash"), row)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))
    return joined.select(*docs.columns, again.alias(row)).drop(row)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return plan(sized(docs, F.monotonically_increasing_id(), "text")).select(
        "doc_id", "size", "source_size", "target", taken
    )


#: The same in SQL, up to the corpus size that decides the number of cells.
OP6_SQL = r"""
with sized as (
  select doc_id, source, coalesce('=' || source, '') as k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
  from documents),
cells as (
  select *, length(size::varchar) * 100 + left(size::varchar, 2)::int as band,
         md5(coalesce(doc_id::varchar, '')) as h,
         greatest(1, ceil(sqrt((select count(*) from documents) / 4096.0)))::bigint as side
  from sized),
placed as (
  select *, row_number() over (partition by k order by band,
         ('0x' || substr(h, 1, 8))::bigint % side, ('0x' || substr(h, 9, 8))::bigint % side,
         size, doc_id) - 1 as place
  from cells),
sources as (
  select k, source, sum(size)::bigint as source_size,
         [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
  from sized group by k, source),
total as (select sum(source_size) as words from sources),
levels as (
  select a.k, (any_value(words) - coalesce(sum(3.0 * b.source_size) filter (
           (3.0 * b.source_size / b.weight, b.k) < (3.0 * a.source_size / a.weight, a.k)), 0))
         / sum(b.weight) filter (
           (3.0 * b.source_size / b.weight, b.k) >= (3.0 * a.source_size / a.weight, a.k)) as level
  from sources a, sources b, total group by a.k),
level as (
  select arg_min(level, (3.0 * source_size / weight, k)) filter (level * weight <= 3.0 * source_size) as level
  from levels join sources using (k)),
goal as (
  select k, source_size, least(3.0 * source_size, level * weight)::double as target,
         case when source_size > 0 then target / source_size else 0 end::double as rate,
         ('0x' || substr(md5('mix-1' || k), 1, 13))::bigint / 4503599627370496.0::double as shift
  from sources, level)
select doc_id, size::bigint as size, source_size, target,
       (least(floor(shift + (place + 1) * rate) - floor(shift + place * rate), 3)::bigint * size)::bigint as taken
from placed join goal using (k)
"""
