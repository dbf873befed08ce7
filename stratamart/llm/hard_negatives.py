"""Hard negatives by score bounds along spanning trees of anchors.

For each anchor, the rows of its label with the highest scores are its positives;
a positive's negatives are the best rows of other labels whose score lies in a
window of shares of the positive's score. Rows stand in packs of ``PACK_BYTES``,
anchors in blocks of about ``BLOCK`` that share their nearest pivot, and every
pack meets every block once, joined by a cell number.

A block holds a minimum spanning tree of its anchors. Only the root is scored
against all rows of a pack. From parent to child, a row's score changes by the
product with the edge, so by at most edge length times the row's norm: an interval
for the child. A row whose interval meets a window of the child is scored and its
interval becomes a point; for the others the interval goes down the tree. A first
pass over a few cells finds bars: the ``top``-th score in each window, below which
nothing is wanted; the windows of the second pass, over all cells, begin there.

Scores are whole numbers, bounds are widened beyond their rounding, and every row
that a bound leaves in doubt is scored, so the result is exact.

Defined results: rows with a null label, a null vector or a null, NaN or infinite
component take no part; a row without vec_id is no anchor but may be positive or
negative, with a null id that ranks last among ties; repeated rows are rows of
their own, as anchors too, an anchor's own row being the only one left out;
shorter vectors count as padded with zeros; anchors without positives and
positives without negatives give no rows; an empty table gives none; other columns
are ignored. Products must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.common import part_of_md5, stored, table
from stratamart.llm.pivot_search import EXACT, padded, quantised, rows_of, usable

#: Bytes of the vectors of one pack: 4,096 vectors of 64 numbers.
PACK_BYTES = 1 << 21
BLOCK = 256
PIVOTS = 32
#: Cells that the first pass looks at.
FIRST_CELLS = 4
POSITIVES, TOP = 5, 10
#: A negative's score times 100 lies between these multiples of the positive's.
LOW, HIGH, WHOLE = 30, 90, 100
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
NO_ID = np.iinfo(np.int64).max
PACKED = "cell int, ids binary, unnamed binary, pack_labels binary, pack_rids binary, xs binary"
ANCHORS = "vec_id long, label int, rid long, x binary, pivot int"
BLOCKS = "block string, rids binary, labels binary, vectors binary, tree binary, edges binary"
FOUND = "anchor long, positive int, rid long, vec_id long, unnamed boolean, score long"


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order from the root (the vector nearest the mean), parent and edge length of each."""
    x = x.astype(np.float64)
    n = len(x)
    root = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    parent, edge, order = np.full(n, -1), np.zeros(n), [root]
    near = ((x - x[root]) ** 2).sum(1)
    link, left = np.full(n, root), np.ones(n, bool)
    left[root] = False
    for _ in range(n - 1):
        new = int(np.where(left, near, np.inf).argmin())
        parent[new], edge[new], left[new] = link[new], np.sqrt(near[new]), False
        order.append(new)
        closer = ((x - x[new]) ** 2).sum(1)
        link, near = np.where(closer < near, new, link), np.minimum(near, closer)
    return np.array(order), parent, edge


class Vectors:
    """Whole-number vectors and the same as floating point numbers, made once."""

    def __init__(self, buffer: bytes, dims: int) -> None:
        self.whole = np.frombuffer(buffer, np.int64).reshape(-1, dims)
        self.floats = self.whole.astype(np.float64)
        self.largest = float(np.abs(self.floats).max(initial=0))

    def scores(self, other: Vectors, mine: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Products of the vectors ``mine`` with the rows ``at`` of ``other``, in whole
        numbers: by floating point where no sum of products can be rounded."""
        if self.largest * other.largest * max(self.whole.shape[1], 1) >= EXACT:
            return self.whole[mine] @ other.whole[at].T
        if 4 * len(at) > len(other.whole):  # a copy of so many rows costs more than their products
            return (self.floats[mine] @ other.floats.T)[:, at].astype(np.int64)
        return (self.floats[mine] @ other.floats[at].T).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores; ties by id, none last."""
    at = np.arange(len(scores))
    if len(at) > top:
        at = np.flatnonzero(scores >= np.partition(scores, len(at) - top)[len(at) - top])
    return at[np.lexsort((ids[at], unnamed[at], -scores[at]))][:top]


class Pack:
    """Rows of one pack: ids, marks of null ids, labels, row numbers and vectors."""

    def __init__(self, row, dims: int) -> None:
        self.ids = np.frombuffer(row.ids, np.int64)
        self.unnamed = np.frombuffer(row.unnamed, np.bool_)
        self.labels = np.frombuffer(row.pack_labels, np.int32)
        self.rids = np.frombuffer(row.pack_rids, np.int64)
        self.x = Vectors(row.xs, dims)
        # Widened, so that a rounded bound is never too narrow.
        self.norms = np.sqrt((self.x.floats**2).sum(1)) * (1 + 1e-6)


class Block:
    """Anchors of one block, their tree and, in the second step, their windows."""

    def __init__(self, row, dims: int) -> None:
        self.rids = np.frombuffer(row.rids, np.int64)
        self.labels = np.frombuffer(row.labels, np.int32)
        self.x = Vectors(row.vectors, dims)
        order, parent = np.frombuffer(row.tree, np.int64).reshape(2, -1)
        self.tree = order, parent, np.frombuffer(row.edges, np.float64)


def stretch(windows: list[tuple[int, int, int]]) -> tuple[float, float]:
    held = [(low, high) for _, low, high in windows if low <= high]
    return (min(w[0] for w in held), max(w[1] for w in held)) if held else (np.inf, -np.inf)


def candidates(
    pack: Pack, block: Block, wanted: list[list[tuple[int, int, int]]]
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Every anchor along the tree with rows of other labels and their scores, all rows
    within its windows ``wanted`` (positive, low, high) among them, and how many were scored.

    The windows of one anchor overlap or lie close, so the bounds are held against
    the stretch from the lowest to the highest of them.
    """
    order, parent, edge = block.tree
    lower: dict[int, np.ndarray] = {}
    upper: dict[int, np.ndarray] = {}
    children = np.bincount(parent[parent >= 0], minlength=len(order))
    for a in order.tolist():
        up = int(parent[a])
        if up < 0:
            doubt = np.ones(len(pack.ids), bool)
            least, most = np.zeros(len(doubt)), np.zeros(len(doubt))
        else:
            reach = edge[a] * pack.norms
            least, most = lower[up] - reach, upper[up] + reach
            low, high = stretch(wanted[a])
            doubt = (most >= low) & (least <= high) & (pack.labels != block.labels[a])
            children[up] -= 1
            if not children[up]:
                del lower[up], upper[up]
        at = np.flatnonzero(doubt)
        scores = block.x.scores(pack.x, np.array([a]), at)[0]
        if children[a]:
            # A whole number beyond 2 ** 53 is rounded: one part in 10 ** 15 and 1 cover it.
            slack = np.abs(scores) * 1e-15 + 1
            least[at], most[at] = scores - slack, scores + slack
            lower[a], upper[a] = least, most
        low, high = stretch(wanted[a])
        fits = (scores >= low) & (scores <= high) & (pack.labels[at] != block.labels[a])
        yield a, at[fits], scores[fits], len(at)


def pack_rows(dims: int) -> int:
    return max(1, PACK_BYTES // (8 * max(dims, 1)))


def packed(vectors: DataFrame, dims: int, cells: int) -> DataFrame:
    """Rows in packs, each in a cell: no shuffle, so no key decides a pack's size."""

    rows = pack_rows(dims)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.iloc[at : at + rows]
                rids = part.rid.to_numpy(np.int64)
                unnamed = part.vec_id.isna().to_numpy()
                ids = np.array([NO_ID if u else int(i) for i, u in zip(part.vec_id, unnamed)], np.int64)
                cell = int(pd.util.hash_array(rids[:1])[0] % np.uint64(cells))
                yield pd.DataFrame(
                    {
                        "cell": [cell],
                        "ids": [ids.tobytes()],
                        "unnamed": [unnamed.tobytes()],
                        "pack_labels": [part.label.to_numpy(np.int32).tobytes()],
                        "pack_rids": [rids.tobytes()],
                        "xs": [padded(part.x, dims).tobytes()],
                    }
                )

    return vectors.select("rid", F.col("vec_id").cast("string"), "label", "x").mapInPandas(pack, PACKED)


def blocks_of(anchors: DataFrame, dims: int) -> tuple[DataFrame, DataFrame]:
    """One row per block of anchors, with its spanning tree, and the block of each anchor."""
    spark = anchors.sparkSession
    turn = part_of_md5(F.col("rid").cast("string"), 1, 12)
    drawn = anchors.withColumn("turn", turn).orderBy("turn", "rid").limit(PIVOTS).select("x").collect()
    pivots = padded(pd.Series([r.x for r in drawn]), dims).astype(np.float64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = padded(batch.x, dims)
            far = (x.astype(np.float64) ** 2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)
            out = batch[["vec_id", "label", "rid"]].assign(x=[r.tobytes() for r in x], pivot=far.argmin(1).astype(np.int32))
            yield out

    near = stored(anchors.select("vec_id", "label", "rid", "x").mapInPandas(place, ANCHORS))
    counts = near.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    part = F.pmod(F.hash("rid"), F.col("parts"))
    keyed = near.join(counts, "pivot").withColumn("block", F.concat_ws(".", "pivot", part))

    def tree(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["vec_id", "rid"])
        x = rows_of([bytes(v) for v in block.x], dims)
        order, parent, edge = spanning_tree(x)
        out = {"block": block.block.iloc[0], "rids": block.rid.to_numpy(np.int64).tobytes()}
        out |= {"labels": block.label.to_numpy(np.int32).tobytes(), "vectors": x.tobytes()}
        out |= {"tree": np.stack([order, parent]).astype(np.int64).tobytes(), "edges": edge.tobytes()}
        return pd.DataFrame([out])

    blocks = stored(keyed.groupBy("block").applyInPandas(tree, BLOCKS))
    return blocks, keyed.select("rid", "vec_id", "block")


def meet(blocks: DataFrame, packs: DataFrame, cells: Column) -> DataFrame:
    """Every block with the packs of its cells."""
    asked = blocks.withColumn("cell", F.explode(cells))
    return asked.join(packs.hint("shuffle_hash"), "cell").drop("cell")


class Found:
    """The best rows of anchors, gathered for one table per batch."""

    def __init__(self, top: int) -> None:
        self.top, self.parts = top, []

    def add(self, anchor: int, positive: int, pack: Pack, at: np.ndarray, scores: np.ndarray) -> None:
        kept = best(scores, pack.ids[at], pack.unnamed[at], self.top)
        at = at[kept]
        named = np.full(len(at), anchor), np.full(len(at), positive, np.int32)
        self.parts.append((*named, pack.rids[at], pack.ids[at], pack.unnamed[at], scores[kept]))

    def table(self) -> pd.DataFrame:
        columns = [c.split()[0] for c in FOUND.split(", ")]
        if not self.parts:
            return pd.DataFrame(columns=columns)
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(columns, zip(*self.parts))})


def first_in(df: DataFrame, by: list[str], ties: list[str], top: int, name: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "unnamed", "vec_id", *ties)
    return df.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= top)


def positives(pairs: DataFrame, dims: int, count: int) -> DataFrame:
    """(anchor, positive, vec_id, unnamed, score): the best other rows of the anchor's label."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Found(count)
            for row in batch.itertuples(index=False):
                pack, block = Pack(row, dims), Block(row, dims)
                for label in np.intersect1d(pack.labels, block.labels):
                    at = np.flatnonzero(pack.labels == label)
                    mine = np.flatnonzero(block.labels == label)
                    for a, scores in zip(mine, block.x.scores(pack.x, mine, at)):
                        other = pack.rids[at] != block.rids[a]
                        found.add(block.rids[a], 0, pack, at[other], scores[other])
            yield found.table()

    found = pairs.mapInPandas(score, FOUND).drop("positive")
    return first_in(found, ["anchor"], ["rid"], count, "positive").drop("rid")


def in_windows(pairs: DataFrame, dims: int, top: int) -> DataFrame:
    """Best rows in each window of each anchor; ``windows`` (anchor, positive, low, high)."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Found(top)
            for row in batch.itertuples(index=False):
                pack, block = Pack(row, dims), Block(row, dims)
                at = {rid: i for i, rid in enumerate(block.rids.tolist())}
                wanted: list[list[tuple[int, int, int]]] = [[] for _ in at]
                for w in row.windows:
                    wanted[at[w["anchor"]]].append((w["positive"], w["low"], w["high"]))
                for a, rows, scores, _ in candidates(pack, block, wanted):
                    for positive, low, high in wanted[a]:
                        inside = (scores >= low) & (scores <= high)
                        if inside.any():
                            found.add(block.rids[a], positive, pack, rows[inside], scores[inside])
            yield found.table()

    found = pairs.mapInPandas(score, FOUND).drop("rid")
    return first_in(found, ["anchor", "positive"], [], top, "rank")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    count: int = POSITIVES,
    top: int = TOP,
    low: int = LOW,
    high: int = HIGH,
    whole: int = WHOLE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors``: vec_id, label and x, an array of whole numbers, all usable. A
    negative's score times ``whole`` lies between ``low`` and ``high`` times the positive's.
    """
    spark = vectors.sparkSession
    rows = stored(
        vectors.select(
            "vec_id", "label", "x", F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")
        ).withColumn("rid", F.monotonically_increasing_id())
    )
    anchors = rows.filter(F.col("is_anchor") & F.col("vec_id").isNotNull())
    size = rows.agg(F.max(F.size("x")).alias("dims"), F.count(F.lit(1)).alias("rows")).first()
    if not size.rows or anchors.isEmpty():
        return spark.createDataFrame([], RESULT)
    cells = -(-size.rows // pack_rows(size.dims))
    packs = stored(packed(rows, size.dims, cells))
    blocks, members = blocks_of(anchors, size.dims)
    every = F.sequence(F.lit(0), F.lit(cells - 1))
    some = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(FIRST_CELLS)), lambda i: F.pmod(F.hash("block", i), F.lit(cells))))
    near = stored(positives(meet(blocks, packs, every), size.dims, count))

    def windows(bars: DataFrame | None) -> DataFrame:
        least = -F.expr(f"(score * -{low}L - pmod(score * -{low}L, {whole}L)) div {whole}L")
        most = F.expr(f"(score * {high}L - pmod(score * {high}L, {whole}L)) div {whole}L")
        begun = near if bars is None else near.join(bars, ["anchor", "positive"], "left")
        start = least if bars is None else F.greatest(least, F.col("bar"))
        own = begun.select("anchor", "positive", start.alias("low"), most.alias("high"))
        by_block = own.join(members, own.anchor == members.rid).groupBy("block")
        return blocks.join(by_block.agg(F.collect_list(F.struct("anchor", "positive", "low", "high")).alias("windows")), "block")

    first = in_windows(meet(windows(None), packs, some), size.dims, top)
    bars = first.filter(F.col("rank") == top).select("anchor", "positive", F.col("score").alias("bar"))
    barred = stored(windows(bars))
    found = in_windows(meet(barred, packs, every), size.dims, top)
    named = members.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    positive = near.select("anchor", "positive", unnulled().alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        found.select("anchor", "positive", "rank", unnulled().alias("negative_id"), F.col("score").alias("negative_score"))
        .join(positive, ["anchor", "positive"])
        .join(named, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def unnulled() -> Column:
    return F.when(~F.col("unnamed"), F.col("vec_id"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = rows.filter(F.col("label").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        shifted.cast("int").alias("label"),
        quantised(F.col("embedding"), 256.0).alias("x"),
    )
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


OP12_SQL = """
with whole as (
  select row_number() over () as rid, vec_id,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda v: floor(256 * v::double)) as x
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
scored as (
  select a.rid as anchor, a.vec_id as anchor_id, a.label as anchor_label, c.vec_id, c.label,
         list_dot_product(a.x, c.x)::bigint as score
  from whole a join whole c on c.rid <> a.rid
  where a.vec_id % 100 = 0),
positives as (
  select *, row_number() over (partition by anchor order by score desc, vec_id nulls last) as positive
  from scored where label = anchor_label
  qualify positive <= 5)
select p.anchor_id, p.vec_id as positive_id,
       row_number() over (partition by p.anchor, positive order by n.score desc, n.vec_id nulls last)::int as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scored n on n.anchor = p.anchor and n.label <> n.anchor_label
  and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify rank <= 10
"""
