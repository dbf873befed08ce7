"""Near-duplicate classes by BagMinHash over five-word shingles.

A document is the multiset of its five-word shingles; two documents are linked
if their multisets overlap by ``SIMILARITY`` or more (weighted Jaccard: sum of
minima over sum of maxima of the multiplicities). Classes are the connected
components of the links.

BagMinHash: the weight axis of a shingle is discretised into [0, 1), [1, 2),
[2, 4), [4, 8) ... Each interval carries a Poisson process of unit rate; a point
has a time, a place in the interval and one of ``M`` signature components, all
from the hash of (shingle, interval, number of the point). Points whose place
lies beyond the multiplicity do not exist for the document, which splits the
last interval. A component keeps its earliest point; two signatures agree in a
component with the probability of the weighted Jaccard similarity. Points are
drawn up to a time by which all components are hit with high probability, and
further where they are not.

Steps: equal multisets are one node: of copies in one batch of rows only the first
carries its bands and multiset on, and what comes from several batches is one from
the first shuffle on; signatures are cut
into ``BANDS`` bands and nodes that agree in a band share a bucket (at
similarity 0.8 a pair misses all buckets with probability 8e-5); each bucket's
node with most copies is compared with the others exactly; buckets that still
hold several components are searched in full, every pair of nodes of different
components, in chunks of bounded size. Verification compares sets of 32-bit
hashes of (shingle, occurrence). Nothing is dropped from large buckets, and no
pairs are written but links.

Words are split at white space, lower-cased, and stripped of punctuation at
their ends. Defined results: a text of fewer than five words is one shingle of
all of them; null texts and texts without words form one class; a null doc_id
stays a row; repeated rows share a class; the class id is the least doc_id in
it, and as one doc_id may carry texts of several classes, ``class_root`` tells
these apart (the hash of the class's least multiset); an empty table gives an
empty one; ``keep_one`` keeps all columns and one row of each class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import stored, table
from stratamart.llm.components import components

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 40, 7
M = BANDS * ROWS
MARK = "__near_dedup_mark"
#: Nodes of a bucket that are compared as one block.
CHUNK = 512
#: Characters of text that are worked on at once.
BATCH_CHARS = 2_000_000
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»“”„‘’…–—|"
SKETCH = "bag binary, size int, bands array<long>, grams binary"

U = np.uint64
STEP = U(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x + U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def waiting(x: np.ndarray) -> np.ndarray:
    """Exponential waiting times from 64-bit hashes."""
    return -np.log(((x >> U(40)).astype(np.float32) + np.float32(1)) * np.float32(2.0**-24))


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(document number, shingle hash) in order of the texts."""
    lists = [t.lower().split() for t in texts]
    lengths = np.array([len(x) for x in lists], np.int64)
    flat = np.empty(int(lengths.sum()), object)
    flat[:] = [w for x in lists for w in x]
    codes, unique = pd.factorize(flat)
    bare = [w.strip(PUNCTUATION) for w in unique]
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in bare], U)
    real = np.array([bool(w) for w in bare], bool)
    doc = np.repeat(np.arange(len(texts)), lengths)
    if len(flat):
        doc, codes = doc[real[codes]], codes[real[codes]]
    word = hashes[codes] if len(codes) else np.empty(0, U)
    count = np.bincount(doc, minlength=len(texts))
    first = np.append(0, np.cumsum(count)[:-1])
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(word) - words + 1), U)
        for j in range(words):
            rolled = rolled * STEP + word[j : j + len(rolled)]
        inside = np.flatnonzero(doc[: len(rolled)] == doc[words - 1 :]) if len(rolled) else np.empty(0, np.int64)
        few = np.flatnonzero((count > 0) & (count < words))
        short = np.zeros(len(few), U)
        for j in range(words - 1):
            has = count[few] > j
            short[has] = short[has] * STEP + word[first[few[has]] + j]
    at = np.concatenate([doc[inside], few])
    gram = np.concatenate([mixed(rolled[inside]), mixed(short + U(1))])
    order = np.lexsort((gram, at))
    return at[order], gram[order]


def signatures(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, docs: int, m: int = M) -> np.ndarray:
    """BagMinHash signatures (docs, m) of multisets given as distinct
    (doc, gram) with their counts; documents without grams get zeros."""
    weight = np.bincount(doc, weights=count, minlength=docs)
    best = np.full(docs * m, np.inf)
    sign = np.zeros(docs * m, U)
    # One row per shingle and interval that its count reaches.
    parts = []
    level, low, length = 0, 0, 1
    left = np.arange(len(doc))
    while len(left):
        with np.errstate(over="ignore"):
            key = mixed(gram[left] ^ mixed(np.full(len(left), level, U)))
        cover = np.minimum((count[left] - low) / length, 1.0)
        parts.append((doc[left], key, np.full(len(left), float(length)), cover))
        level, low, length = level + 1, low + length, low + length
        left = left[count[left] > low]
    owner, key, rate, cover = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (doc, gram, count, count)
    need = np.flatnonzero(weight > 0)
    limit = np.zeros(docs)
    limit[need] = m * (math.log(m) + 3) / weight[need]
    while len(need):
        wanted = np.zeros(docs, bool)
        wanted[need] = True
        rows = np.flatnonzero(wanted[owner])
        expected = rate[rows] * limit[owner[rows]]
        kinds = np.minimum(np.ceil(np.log2(np.maximum(expected, 1.0))), 8).astype(int)
        for kind in np.unique(kinds):
            active = rows[kinds == kind]
            clock, number, block = np.zeros(len(active)), 0, 1 << int(kind)
            while len(active):
                index = np.arange(number, number + block, dtype=U)
                with np.errstate(over="ignore"):
                    point = mixed(key[active][:, None] + index * U(0xD1342543DE82EF95))
                time = clock[:, None] + np.cumsum(waiting(point) / rate[active][:, None], axis=1)
                of = owner[active]
                row, column = np.nonzero(time <= limit[of][:, None])
                early, drawn = time[row, column], point[row, column]
                # The high half places the point in its interval, the rest picks the component.
                second = mixed(drawn)
                real = (second >> U(32)).astype(np.float64) * 2.0**-32 < cover[active][row]
                slot = of[row] * m + ((second & U(0xFFFFFFFF)) % U(m)).astype(np.int64)
                early, drawn, slot = early[real], drawn[real], slot[real]
                np.minimum.at(best, slot, early)
                won = early == best[slot]
                sign[slot[won]] = drawn[won]
                going = time[:, -1] < limit[of]
                active, clock, number = active[going], time[going, -1], number + block
        need = need[np.isinf(best.reshape(docs, m)[need]).any(1)]
        limit[need] *= 2
    return sign.reshape(docs, m)


def sketches(texts: list[str], known: set[bytes]) -> pd.DataFrame:
    """bag (hash of the multiset), size, band keys and hashed multiset per text.

    Bands and multiset are given with the first text of a bag and left out with
    those after it: ``known`` holds the bags that had them before.
    """
    doc, gram = shingles(texts)
    new = np.append(True, (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])) if len(doc) else np.empty(0, bool)
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(doc)))
    sign = signatures(doc[starts], gram[starts], count.astype(float), len(texts))
    with np.errstate(over="ignore"):
        occurrence = np.arange(len(doc)) - np.repeat(starts, count)
        small = (mixed(gram + mixed(occurrence.astype(U))) >> U(32)).astype(np.uint32)
        key = np.tile(np.arange(BANDS, dtype=U), (len(texts), 1))
        for row in range(ROWS):
            key = mixed(key + sign[:, row::ROWS])
    ends = np.cumsum(np.bincount(doc, minlength=len(texts)))
    out = []
    for i, end in enumerate(ends):
        begin = ends[i - 1] if i else 0
        bag = xxhash.xxh128_digest(gram[begin:end].tobytes())
        if bag in known:
            out.append((bag, int(end - begin), None, None))
            continue
        known.add(bag)
        bands = key[i].view(np.int64).tolist() if end > begin else []
        out.append((bag, int(end - begin), bands, np.unique(small[begin:end]).tobytes()))
    return pd.DataFrame(out, columns=["bag", "size", "bands", "grams"])


def sketched(docs: DataFrame, text: str = "text", *also: str) -> DataFrame:
    """(doc_id, bag, size, bands, grams) of every row, and the binary columns ``also``;
    bands and grams are null for a bag that the row's batch had before."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch.text]
            first = size = 0
            known: set[bytes] = set()
            for i, t in enumerate(texts):
                size += len(t)
                if size >= BATCH_CHARS or i == len(texts) - 1:
                    part = sketches(texts[first : i + 1], known)
                    for at, name in enumerate(["doc_id", *also]):
                        part.insert(at, name, batch[name].iloc[first : i + 1].to_numpy())
                    yield part
                    first, size = i + 1, 0

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), *also)
    # pandas would turn longs beside nulls into doubles
    marked = slim.withColumn("doc_id", F.col("doc_id").cast("string"))
    shape = ", ".join(["doc_id string", *[f"{name} binary" for name in also], SKETCH])
    return marked.mapInPandas(work, shape).withColumn("doc_id", F.col("doc_id").cast("long"))


def overlap(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both)


def similar(a: Column, b: Column) -> Column:
    @F.pandas_udf("boolean")
    def enough(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in pairs:
            yield pd.Series([overlap(p, q) >= SIMILARITY for p, q in zip(x, y, strict=True)], dtype=bool)

    return enough(a, b)


def bucket_links(bags: list[bytes], roots: list[bytes], sets: list[bytes], side: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Links that join different components among the nodes of one block.

    ``side`` 0 or 1 tells the chunk; with both present only pairs across count.
    """
    arrays = [np.frombuffer(s, np.uint32) for s in sets]
    sizes = np.array([len(x) for x in arrays])
    names, at = np.unique(np.concatenate(arrays), return_inverse=True)
    starts = np.append(0, np.cumsum(sizes)[:-1])
    _, part = np.unique(np.array([r.hex() for r in roots]), return_inverse=True)
    across = side.min() != side.max()
    most = np.bincount(part).argmax()
    links = []
    for i in range(len(bags)):
        if part[i] == most:  # its pairs come up from the other node
            continue
        mark = np.zeros(len(names), np.int64)
        mark[at[starts[i] : starts[i] + sizes[i]]] = 1
        both = np.add.reduceat(mark[at], starts)
        good = (part != part[i]) & (both >= SIMILARITY * (sizes + sizes[i] - both))
        if across:
            good &= side != side[i]
        for j in np.flatnonzero(good):
            if part[j] != part[i]:
                links.append((bags[i], bags[j]))
                part[part == part[j]] = part[i]
    return links


def in_buckets(buckets: DataFrame) -> DataFrame:
    """(a, b) links within blocks (ids, roots, sets, sides)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                links = bucket_links(list(row.bags), list(row.roots), list(row.sets), np.asarray(row.sides))
                if links:
                    yield pd.DataFrame(links, columns=["a", "b"])

    return buckets.mapInPandas(work, "a binary, b binary")


def linked(sketch: DataFrame) -> DataFrame:
    """(a, b): enough links between nodes to give the components, from a stored sketch."""
    firsts = sketch.filter(F.col("grams").isNotNull())
    entries = firsts.select("bag", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.min("bag").alias("lo"), F.max("bag").alias("hi"))
    shared = shared.filter("lo <> hi").select("key")
    members = stored(entries.join(shared, "key").groupBy("key", "bag").agg(F.count(F.lit(1)).alias("copies")))
    nodes = members.select("bag").distinct()
    sets = stored(
        firsts.select("bag", "grams").join(nodes, "bag", "left_semi").groupBy("bag").agg(F.first("grams").alias("grams"))
    )
    hubs = members.groupBy("key").agg(F.max(F.struct("copies", "bag")).alias("hub"))
    hubs = hubs.select("key", F.col("hub.bag").alias("a"))
    pairs = stored(
        members.join(hubs, "key").filter(F.col("a") != F.col("bag")).select("a", F.col("bag").alias("b")).distinct()
    )
    with_a = stored(pairs.join(sets.select(F.col("bag").alias("a"), F.col("grams").alias("x")), "a"))
    with_b = with_a.join(sets.select(F.col("bag").alias("b"), F.col("grams").alias("y")), "b")
    stars = stored(with_b.filter(similar(F.col("x"), F.col("y"))).select("a", "b"))
    roots = components(stars)
    rooted = stored(
        members.join(roots.withColumnRenamed("node", "bag"), "bag", "left").select(
            "key", "bag", F.coalesce("root", "bag").alias("root")
        )
    )
    open_ = rooted.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("nodes")
    )
    open_ = open_.filter("lo <> hi").select("key", F.ceil(F.col("nodes") / CHUNK).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("bag"), "chunks").cast("int")
    # A node goes to the blocks that pair its chunk with each chunk of its bucket.
    placed = rooted.join(open_, "key").withColumn("chunk", chunk)
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    placed = stored(
        placed.select(
            "key",
            F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"),
            (F.col("chunk") > F.col("other")).cast("int").alias("side"),
            "bag",
            "root",
        )
    )
    blocks = (
        placed.join(sets, "bag")
        .groupBy("key", "i", "j")
        .agg(F.collect_list(F.struct("bag", "root", "grams", "side")).alias("rows"))
        .select(
            F.col("rows.bag").alias("bags"),
            F.col("rows.root").alias("roots"),
            F.col("rows.grams").alias("sets"),
            F.col("rows.side").alias("sides"),
        )
    )
    return stored(stars.unionByName(in_buckets(blocks)))


def rooted(sketch: DataFrame) -> DataFrame:
    """(bag, root, least, copies) of every multiset of a stored sketch: its class,
    least doc_id and rows."""
    roots = components(linked(sketch)).withColumnRenamed("node", "bag")
    bags = sketch.groupBy("bag").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    return stored(bags.join(roots, "bag", "left").withColumn("root", F.coalesce("root", "bag")))


def classes(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, class_id, class_size, class_root) of every row of ``docs``."""
    sketch = stored(sketched(docs, text))
    placed = rooted(sketch)
    sums = placed.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    of_bag = stored(placed.select("bag", "root").join(sums, "root"))
    return sketch.select("doc_id", "bag").join(of_bag, "bag").select(
        "doc_id", "class_id", "class_size", F.hex("root").alias("class_root")
    )


def content_mark(docs: DataFrame) -> Column:
    """128 bits that name a row by all its columns; nulls differ from every value."""
    parts = [x for c in docs.columns for x in (F.col(c), F.col(c).isNull())]
    halves = [F.hex(F.xxhash64(F.lit(seed), *parts)) for seed in (1, 2)]
    return F.unhex(F.concat(*[F.lpad(h, 16, "0") for h in halves]))


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: of its least doc_id, else of no doc_id,
    the least by multiset and content. Rows that agree in all columns are one."""
    marked = docs.withColumn(MARK, content_mark(docs))
    sketch = stored(sketched(marked, text, MARK))
    # One row per bag first, so that copies are combined before the shuffle.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "bag", MARK))
    of_bag = sketch.groupBy("bag").agg(first.alias("first"))
    of_class = of_bag.join(rooted(sketch), "bag").groupBy("root").agg(F.min("first").alias("first"))
    kept = stored(of_class.select(F.col(f"first.{MARK}").alias(MARK)))
    # Repeated rows are combined before the shuffle too.
    return marked.dropDuplicates([MARK]).join(kept, MARK, "left_semi").select(docs.columns)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
