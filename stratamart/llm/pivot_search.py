"""Exact top-k inner products through a pivot-distance index.

Inner products become distances by one coordinate more: with M the largest
norm, x maps to (x, sqrt(M^2 - |x|^2)) and a query q to (q, 0); then
distance^2 = |q|^2 + M^2 - 2 <q, x>, so near means a high score. Every vector is
keyed by its nearest pivot and, within it, by its distance: rings of equal width
(annuli). By the triangle inequality a ring of pivot p with distances [a, b] holds
nothing nearer to q than max(0, a - d(q, p), d(q, p) - b). Each query first searches
the rings with the least bounds until they hold enough vectors; its k-th best score
so far is then the bar, and the rings whose bound can still reach it are expanded.

Rings are laid end to end and cut into bundles of bounded size. A query goes once to
each bundle that holds a ring it wants, and there meets the rows of those rings only,
in chunks; vectors and queries come to a bundle by one shuffle of single rows, which
no estimate of sizes can turn into a broadcast. Scores are whole numbers; they are
multiplied as floats where these hold every sum of products exactly.

Pivots are ``PIVOTS`` vectors drawn by hash: a bounded fit of the index; all
vectors are indexed, and the result is exact whatever the pivots.

Defined results: vectors that are null or hold a null, NaN or infinity take no
part; shorter vectors count as padded with zeros; a query with fewer than k
candidates gets all of them; ties go to the smaller vec_id; repeated vectors are
candidates of their own; no vectors, no rows. Products must fit a long.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.common import part_of_md5, stored, table

PIVOTS = 32
RINGS = 16
CHUNK_ROWS = 4096
QUERY_BLOCK = 256
TOP = 10
#: Bundles of a table: so many, but none below these rows and none above these numbers.
BUNDLES = 64
BUNDLE_ROWS = 512
BUNDLE_NUMBERS = 2**22
#: Parts in which the rows of a ring are dealt along the bundles.
DEAL = 2**20
EXACT = float(2**53)
#: The bar of a query that has none.
LEAST = -(2**63)
#: The place of queries among the rings: after them.
LAST = 2**31 - 1
FOUND = "query_id long, vec_id long, score long"
#: From the best scores of rings and the bars of queries to the rings that each wants.
Wanted = Callable[[np.ndarray, np.ndarray, int], np.ndarray]


def quantised(vector: Column, scale: float = 1024.0) -> Column:
    return F.transform(vector, lambda v: F.floor(F.lit(scale) * v.cast("double")))


def usable(vector: Column) -> Column:
    def finite(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf")))

    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def kind_of(norms: float) -> type:
    """Numbers that hold every sum of products of vectors whose norms have this product."""
    norms *= 1 + 1e-9
    return np.float32 if norms < 2**24 else np.float64 if norms < EXACT else np.int64


class Space:
    """Distances between augmented vectors."""

    def __init__(self, dims: int, norm2: float, pivots: np.ndarray) -> None:
        self.dims, self.norm2, self.pivots = dims, norm2, pivots.astype(np.float64)
        self.pivot_extra = np.sqrt(np.maximum(norm2 - (self.pivots**2).sum(1), 0.0))
        self.width = max(1.0, 2 * math.sqrt(norm2) / RINGS)
        # No number exceeds the largest norm.
        self.kept = next((k for k in (np.int16, np.int32) if norm2 < float(np.iinfo(k).max) ** 2), np.int64)

    def rows(self, buffers: pd.Series) -> np.ndarray:
        return np.frombuffer(b"".join(buffers), self.kept).reshape(len(buffers), self.dims)

    def of_data(self, x: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.norm2 - (x**2).sum(1), 0.0))
        dot = x @ self.pivots.T + np.outer(extra, self.pivot_extra)
        return np.sqrt(np.maximum(2 * self.norm2 - 2 * dot, 0.0))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((q**2).sum(1)[:, None] + self.norm2 - 2 * (q @ self.pivots.T), 0.0))

    def best_scores(self, q: np.ndarray, near: np.ndarray, far: np.ndarray, pivot: np.ndarray) -> np.ndarray:
        """Highest score that each ring can hold for each query."""
        d = self.of_queries(q)[:, pivot]
        bound = np.maximum(np.maximum(near - d, d - far) - 1e-6 * (1 + d), 0.0)
        return ((q**2).sum(1)[:, None] + self.norm2 - bound**2) / 2 + 1.0


def rows_of(buffers: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(buffers), np.int64).reshape(len(buffers), dims)


def padded(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def build_index(vectors: DataFrame, space: Space) -> DataFrame:
    """(vec_id, x, pivot, distance, ring, is_query, deal) of every vector."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = padded(batch.x, space.dims)
            d = space.of_data(x.astype(np.float64))
            pivot = d.argmin(1)
            nearest = d[np.arange(len(d)), pivot]
            yield pd.DataFrame(
                {
                    "vec_id": batch.vec_id,
                    "x": [row.tobytes() for row in x.astype(space.kept)],
                    "pivot": pivot.astype(np.int32),
                    "distance": nearest,
                    "ring": (nearest // space.width).astype(np.int32),
                    "is_query": batch.is_query,
                    "deal": batch.deal,
                }
            )

    return vectors.mapInPandas(
        place, "vec_id long, x binary, pivot int, distance double, ring int, is_query boolean, deal long"
    )


class Rings:
    """The rings laid end to end and cut into bundles of equal size: a bounded summary of the index."""

    def __init__(self, rings: pd.DataFrame, dims: int) -> None:
        self.pivot, self.near, self.far, self.rows = (rings[c].to_numpy() for c in ("pivot", "near", "far", "rows"))
        self.start = self.rows.cumsum() - self.rows
        whole = int(self.rows.sum())
        share = min(math.ceil(whole / BUNDLES), BUNDLE_NUMBERS // max(1, dims))
        self.bundles = math.ceil(whole / max(BUNDLE_ROWS, share))
        self.share = math.ceil(whole / self.bundles)
        every = np.arange(self.bundles)
        self.first = np.searchsorted((self.start + self.rows - 1) // self.share, every)
        self.last = np.searchsorted(self.start // self.share, every, side="right") - 1

    def nearest(self, best: np.ndarray, bar: np.ndarray, top: int) -> np.ndarray:
        """The rings with the least bounds, until they hold enough beside the query itself."""
        order = np.argsort(-best, axis=1, kind="stable")
        before = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        wants = np.zeros(best.shape, bool)
        np.put_along_axis(wants, order, before <= top, axis=1)
        return wants

    def reaching(self, best: np.ndarray, bar: np.ndarray, top: int) -> np.ndarray:
        """The rings that can still reach the bar."""
        return best >= np.where(bar == LEAST, -np.inf, bar.astype(float))[:, None]


class Bundle:
    """Rows of one bundle, by ring and vec_id."""

    def __init__(self, rows: pd.DataFrame, space: Space, first: int) -> None:
        rows = rows.sort_values(["place", "vec_id"])
        self.ids, x = rows.vec_id.to_numpy(np.int64), space.rows(rows.x)
        places, starts = np.unique(rows.place.to_numpy(), return_index=True)
        self.rings = list(zip(places - first, starts, [*starts[1:], len(rows)], strict=True))
        norms = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        self.norms = [norms[start:end].max() for _, start, end in self.rings]
        self.x = {x.dtype.type: x}

    def best(self, q_ids: np.ndarray, q: np.ndarray, bar: np.ndarray, wants: np.ndarray, top: int) -> pd.DataFrame:
        """The ``top`` best rows for each query of the rings it wants, of those that reach its bar."""
        bar, who = bar.copy(), np.empty(0, np.int64)
        ids = scores = who
        norm = math.sqrt((q.astype(np.float64) ** 2).sum(1).max())
        for (place, start, end), longest in zip(self.rings, self.norms, strict=True):
            asks = np.flatnonzero(wants[:, place])
            if not len(asks):
                continue
            kind = kind_of(norm * longest)
            if kind not in self.x:
                self.x[kind] = next(iter(self.x.values())).astype(kind)
            asked = q[asks].astype(kind)
            for at in range(start, end, CHUNK_ROWS):
                chunk = slice(at, min(end, at + CHUNK_ROWS))
                i, at_ids, s = reaching(asked, q_ids[asks], bar[asks], self.x[kind][chunk], self.ids[chunk], top)
                if not len(i):
                    continue
                who, ids, scores = (np.concatenate(x) for x in ((who, asks[i]), (ids, at_ids), (scores, s)))
                order = np.lexsort((ids, -scores, who))
                begins = np.searchsorted(who[order], np.arange(len(q)))
                order = order[np.arange(len(order)) - begins[who[order]] < top]
                who, ids, scores = who[order], ids[order], scores[order]
                full = np.flatnonzero(np.bincount(who, minlength=len(q)) == top)
                bar[full] = scores[np.searchsorted(who, full, side="right") - 1]
        return pd.DataFrame({"query_id": q_ids[who], "vec_id": ids, "score": scores})


def reaching(
    q: np.ndarray, q_ids: np.ndarray, bar: np.ndarray, x: np.ndarray, ids: np.ndarray, top: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, score) of rows that reach the bars, ``ids`` ascending; not all where
    there are many, but the ``top`` best, ties to the first."""
    s = q @ x.T
    own = np.flatnonzero(np.isin(ids, q_ids))
    if len(own):
        lowest = LEAST if s.dtype == np.int64 else -np.inf
        s[:, own] = np.where(ids[own] == q_ids[:, None], lowest, s[:, own])
    hit = s >= bar.astype(s.dtype)[:, None]
    if np.count_nonzero(hit) > 4 * top * len(q):
        many = np.flatnonzero(hit.sum(1) > top)
        part = s[many]
        least = np.partition(part, -top, axis=1)[:, -top, None]
        above, level = part > least, part == least
        hit[many] = above | (level & (level.cumsum(1) <= top - above.sum(1)[:, None]))
    i, j = np.nonzero(hit)
    others = ids[j] != q_ids[i]
    i, j = i[others], j[others]
    return i, ids[j], s[i, j].astype(np.int64)


def search(rows: DataFrame, queries: DataFrame, space: Space, rings: Rings, wanted: Wanted, top: int) -> DataFrame:
    """Best rows of the rings that each query (vec_id, x, bar) wants, merged to ``top``."""

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query once for every bundle with a ring that it wants."""
        for batch in batches:
            for at in range(0, len(batch), QUERY_BLOCK):
                block = batch[at : at + QUERY_BLOCK]
                best = space.best_scores(space.rows(block.x).astype(float), rings.near, rings.far, rings.pivot)
                wants = wanted(best, block.bar.to_numpy(), top)
                out = []
                for bundle in range(rings.bundles):
                    own = wants[:, rings.first[bundle] : rings.last[bundle] + 1]
                    asks = np.flatnonzero(own.any(1))
                    out.append(block.iloc[asks].assign(bundle=bundle, wants=[row.tobytes() for row in own[asks]]))
                yield pd.concat(out)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of a bundle come before its queries."""
        number, found, held = -1, [], None
        for batch in batches:
            for (bundle, asking), part in batch.groupby([batch.bundle, batch.place == LAST], sort=False):
                if bundle != number:
                    number, found, held = bundle, [], None
                if not asking:
                    found.append(part)
                    continue
                if found:
                    held, found = Bundle(pd.concat(found), space, rings.first[bundle]), []
                for at in range(0, len(part) if held else 0, QUERY_BLOCK):
                    block = part[at : at + QUERY_BLOCK]
                    wants = np.frombuffer(b"".join(block.wants), bool).reshape(len(block), -1)
                    yield held.best(block.vec_id.to_numpy(), space.rows(block.x), block.bar.to_numpy(), wants, top)

    sent = "vec_id long, x binary, bar long, bundle int, wants binary"
    asked = queries.select("vec_id", "x", "bar").mapInPandas(plan, sent)
    met = rows.unionByName(asked.withColumn("place", F.lit(LAST)), allowMissingColumns=True)
    met = met.repartition(rings.bundles, "bundle").sortWithinPartitions("bundle", "place")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.mapInPandas(score, FOUND)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
    )


def top_k(
    table_: DataFrame, is_query: Column, vec: str = "embedding", top: int = TOP, pivots: int = PIVOTS
) -> DataFrame:
    """(query_id, rank, vec_id, score) of all rows where ``is_query`` holds."""
    spark = table_.sparkSession
    usable_rows = table_.filter(F.col("vec_id").isNotNull() & usable(F.col(vec)))
    vectors = usable_rows.select(
        "vec_id",
        quantised(F.col(vec)).alias("x"),
        part_of_md5(F.col("vec_id").cast("string"), 1, 12).alias("spread"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    size = vectors.agg(
        F.max(F.size("x")).alias("dims"), F.max(square).alias("norm2"), F.sum(F.col("is_query").cast("long")).alias("q")
    ).first()
    if size.dims is None or not size.q:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    chosen = vectors.orderBy("spread", "vec_id").limit(pivots).select("x").collect()
    space = Space(size.dims, size.norm2, padded(pd.Series([r.x for r in chosen]), size.dims))
    # Rows of one vec_id are dealt apart, too.
    deal = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(DEAL)).alias("deal")
    index = stored(build_index(vectors.select("vec_id", "x", "is_query", deal), space))
    # At most pivots * (2 * RINGS + 1) rings: a bounded summary of the index.
    summary = (
        index.groupBy("pivot", "ring")
        .agg(F.min("distance").alias("near"), F.max("distance").alias("far"), F.count(F.lit(1)).alias("rows"))
        .orderBy("pivot", "ring")
        .toPandas()
    )
    rings = Rings(summary, space.dims)
    laid = summary[["pivot", "ring", "rows"]].assign(place=range(len(summary)), start=rings.start)
    laid = F.broadcast(spark.createDataFrame(laid, "pivot int, ring int, rows long, place int, start long"))
    bundle = F.expr(f"int((start + deal * rows div {DEAL}) div {rings.share})").alias("bundle")
    rows = index.join(laid, ["pivot", "ring"]).select("vec_id", "x", F.lit(LEAST).alias("bar"), bundle, "place")
    queries = index.filter("is_query").select("vec_id", "x", F.lit(LEAST).alias("bar"))
    first = search(rows, queries, space, rings, rings.nearest, top)
    bars = first.filter(F.col("rank") == top).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bar"))
    bar = F.coalesce("bar", F.lit(LEAST)).alias("bar")
    barred = stored(queries.drop("bar").join(bars, "vec_id", "left").select("vec_id", "x", bar))
    barred = barred.repartition(math.ceil(size.q / QUERY_BLOCK))
    last = search(rows, barred, space, rings, rings.reaching, top)
    return last.select("query_id", "rank", "vec_id", "score")


def op2_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP2_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda v: floor(1024 * v::double)) as x
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.x, c.x)::bigint as score
  from whole q join whole c on c.vec_id <> q.vec_id
  where q.vec_id % 100 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""
