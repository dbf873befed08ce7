"""Benchmark decontamination by q-gram filtering and banded alignment.

Texts are compared lower-cased with runs of white space as one space. A passage
of length L within k = floor(BUDGET * L) edits of a stretch of a document shares
at least L + 1 - q - k q of its q-grams with it (the q-gram lemma), on diagonals
(document position minus passage position) that differ by k at most. Shared
q-grams are counted in diagonal bands, each overlapping the next by k so that
one band holds them all; bands that reach the bound are retained and verified by
an alignment restricted to the band. Short passages get the largest k for which
the bound is still a fifth of L, lest common phrases pass the filter.

Benchmark items are sent to the tasks in blocks of at most ``BLOCK_CHARS``
characters; a larger benchmark takes several passes over the documents.

Defined results: null and empty documents match nothing; null items and items
shorter than q match nothing; repeated items and documents each give their
rows; of several places where a document meets an item the best counts; long
documents are read whole, in overlapping pieces; an empty table on either side
gives no rows; other columns are kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import table

Q = 10
BUDGET = 0.08
BLOCK_CHARS = 4_000_000
#: Characters that are filtered at once in a task.
PIECE = 500_000
MIX = np.uint64(0x9E3779B97F4A7C15)
BITS = 22
LEAK = "array<struct<item_id:long,distance:int,start:long,end:long>>"


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def q_grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of every q-gram, by doubling the length of the pieces."""
    piece, length, factor = codes.astype(np.uint64), 1, MIX
    whole, done = None, 0
    with np.errstate(over="ignore"):
        while True:
            if q & length:
                if whole is None:
                    whole = piece
                else:
                    n = len(codes) - done - length + 1
                    whole = whole[:n] * factor + piece[done : done + n]
                done += length
            if done == q:
                return whole
            n = len(piece) - length
            piece = piece[:n] * factor + piece[length:]
            length, factor = 2 * length, factor * factor


class Passages:
    """A block of benchmark items and the index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, budget: float = BUDGET) -> None:
        self.q = q
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        lengths = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.minimum(
            (budget * lengths).astype(np.int64), np.maximum(lengths + 1 - q - lengths // 5, 0) // q
        )
        self.least = lengths + 1 - q - self.edits * q
        self.width = np.maximum(2 * self.edits, 16)
        self.reach = int(max((lengths + self.width + 2 * self.edits).max(initial=0), q))
        self.grams = grams = [q_grams(code_points(t), q) for t in self.texts]
        sizes = np.array([len(g) for g in grams], np.int64)
        gram = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        order = np.argsort(gram, kind="stable")
        self.item = np.repeat(np.arange(len(grams)), sizes)[order].astype(np.int64)
        self.place = np.concatenate([np.arange(n) for n in sizes] or [np.empty(0, np.int64)])[order]
        self.gram, self.first = np.unique(gram[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(gram)))
        self.known = np.zeros(1 << BITS, bool)
        self.known[self.gram >> np.uint64(64 - BITS)] = True
        self.fewest = int(self.least.min()) if items else 1

    def bands(self, text: str) -> list[tuple[int, int]]:
        """(item, first diagonal of the band) where enough q-grams are shared."""
        if len(text) < self.q or not len(self.gram):
            return []
        gram = q_grams(code_points(text), self.q)
        at = np.flatnonzero(self.known[gram >> np.uint64(64 - BITS)])
        if len(at) < self.fewest:
            return []
        # A band needs its q-grams within the reach of one passage.
        later = np.searchsorted(at, at + self.reach)
        earlier = np.searchsorted(at, at - self.reach)
        at = at[later - earlier >= self.fewest]
        found = np.searchsorted(self.gram, gram[at])
        found[found == len(self.gram)] = 0
        same = self.gram[found] == gram[at]
        at, found = at[same], found[same]
        times = self.count[found]
        total = int(times.sum())
        if not total:
            return []
        which = np.repeat(self.first[found] - np.append(0, np.cumsum(times)[:-1]), times) + np.arange(total)
        item = self.item[which]
        diagonal = np.repeat(at, times) - self.place[which] + self.reach  # never negative
        width, edits = self.width[item], self.edits[item]
        band = diagonal // width
        also = (diagonal - band * width <= edits) & (band > 0)
        span = np.int64(len(text) + 2 * self.reach)
        keys = np.concatenate([item * span + band, item[also] * span + band[also] - 1])
        keys, counts = np.unique(keys, return_counts=True)
        keys = keys[counts >= self.least[keys // span]]
        return [(int(k // span), int(k % span) * int(self.width[k // span]) - self.reach) for k in keys]

    def leaks(self, text: str) -> dict[int, tuple[int, int, int]]:
        """Best (distance, start, end) in a normal text by item number."""
        best: dict[int, tuple[int, int, int]] = {}
        step = PIECE
        for begin in range(0, max(1, len(text)), step):
            piece = text[begin : begin + step + 2 * self.reach]
            for item, diagonal in self.bands(piece):
                if best.get(item, (1,))[0] == 0:
                    continue
                k = int(self.edits[item])
                low = diagonal - k
                region = piece[max(low, 0) : low + len(self.texts[item]) + int(self.width[item]) + 3 * k]
                # Repeated phrases fill a band; the bound holds for the passage's own q-grams.
                if len(region) < self.q:
                    continue
                shared = np.isin(self.grams[item], q_grams(code_points(region), self.q))
                if shared.sum() < self.least[item]:
                    continue
                hit = aligned(self.texts[item], region, k)
                if hit and hit < best.get(item, (k + 1, 0, 0)):
                    start = begin + max(low, 0)
                    best[item] = (hit[0], start + hit[1], start + hit[2])
        return best


def aligned(passage: str, region: str, edits: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the nearest stretch of ``region``, if within ``edits``.

    Row by row over the passage; the region is the band's width wider than the
    passage, and the stretch may begin and end anywhere in it. Starts are
    carried along, so ties go to the earliest end.
    """
    found = region.find(passage)
    if found >= 0:
        return 0, found, found + len(passage)
    p, r = code_points(passage), code_points(region)
    n = len(r)
    if n < len(p) - edits:
        return None
    columns = np.arange(n + 1)
    cost, start = np.zeros(n + 1, np.int64), columns.copy()
    slack = n - len(p) + edits
    for i, c in enumerate(p, 1):
        low, high = max(0, i - edits), min(n, i + slack)
        step = np.full(n + 1, 1 << 30)
        came = np.zeros(n + 1, np.int64)
        up = cost[low : high + 1] + 1
        step[low : high + 1], came[low : high + 1] = up, start[low : high + 1]
        from_ = max(low, 1)
        across = cost[from_ - 1 : high] + (r[from_ - 1 : high] != c)
        better = across < step[from_ : high + 1]
        step[from_ : high + 1][better] = across[better]
        came[from_ : high + 1][better] = start[from_ - 1 : high][better]
        # Insertions: the least of (cost - column) so far, plus the column.
        flat = step - columns
        least = np.minimum.accumulate(flat)
        source = np.maximum.accumulate(np.where(flat == least, columns, 0))
        cost, start = least + columns, came[source]
    end = int(np.argmin(cost))
    return (int(cost[end]), int(start[end]), end) if cost[end] <= edits else None


def leaks(text: Column, passages: Passages) -> Column:
    """Leaked items of each text, best place each (offsets in the normal text)."""

    @F.pandas_udf(LEAK)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = [normal(t) if t else "" for t in batch]
            out: list[list[dict]] = [[] for _ in texts]
            for first, last in runs(texts):
                # Documents are filtered together; only those with a band are read alone.
                if last - first > 1 and not passages.bands("\n".join(texts[first:last])):
                    continue
                for i in range(first, last):
                    for item, (distance, start, end) in sorted(passages.leaks(texts[i]).items()):
                        out[i].append(
                            {"item_id": passages.ids[item], "distance": distance, "start": start, "end": end}
                        )
            yield pd.Series(out, dtype=object)

    return found(text)


def runs(texts: list[str], most: int = 20_000) -> Iterator[tuple[int, int]]:
    """Neighboring texts of at most ``most`` characters together, long ones alone."""
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > most:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if texts:
        yield first, len(texts)


def blocks(benchmark: DataFrame) -> Iterator[Passages]:
    """Benchmark items in blocks of bounded size, read one block at a time."""
    items: list[tuple[int, str]] = []
    size = 0
    rows = benchmark.filter("text is not null and item_id is not null").select("item_id", "text")
    for row in rows.toLocalIterator():
        text = normal(row.text)
        if len(text) < Q:
            continue
        if items and size + len(text) > BLOCK_CHARS:
            yield Passages(items)
            items, size = [], 0
        items.append((row.item_id, text))
        size += len(text)
    if items:
        yield Passages(items)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """One row (doc_id, item_id, distance, start, end) per document and leaked item."""
    out = docs.sparkSession.createDataFrame(
        [], "doc_id long, item_id long, distance int, start long, end long"
    )
    for passages in blocks(benchmark):
        found = docs.select("doc_id", F.explode(leaks(F.col(text), passages)).alias("leak"))
        out = out.unionByName(found.select("doc_id", "leak.*"))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage."""
    for passages in blocks(benchmark):
        docs = docs.filter(F.size(leaks(F.col(text), passages)) == 0)
    return docs


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark"))
