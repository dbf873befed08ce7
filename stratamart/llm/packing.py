"""Pack documents into sequences along a space-filling curve.

Each document's subword ids give signed counts in ``BUCKETS`` hashed places; the
unit vector of these counts is projected to ``DIMS`` numbers. A coordinate is cut
into 2 ** BITS cells by the mean and spread of all documents, and the cell's place
on a Hilbert curve is the document's key, so documents of similar words follow one
another. Rows are range-sorted by that key, laid end to end, and a sequence ends
every ``LENGTH`` ids: neighbours on the curve share sequences, a document is cut
where a sequence is full, and only the last sequence is padded.

The ids are written once with a row number. The order is made from the slim rows
(number, key, length): prefix sums of the ranges' totals give each row its place,
no task sees more than one range, and the number breaks ties of equal texts, so a
text may have any number of copies. The places then meet the ids by row number.

Texts are split at ASCII white space, which this vocabulary drops, and distinct
words are encoded once for many texts. Sums are of whole numbers, so reruns agree.

Defined results: a null or empty text, or one of white space only, is one piece
that holds the end id alone; repeated rows are documents of their own; long texts
are read whole and cut into as many pieces as they need; an empty table gives no
pieces; other columns are ignored; the last sequence may be shorter than the rest.
"""

from __future__ import annotations

import json
import math
import os
import re
import string
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.common import shared_folder, stored, table

VOCABULARY = "word_bpe_49k.json"
LENGTH = 2048
END = 1
DIMS, BITS = 4, 8
BUCKETS = 256
SEED = 11
#: One unit of a projected coordinate.
UNIT = 1 << 16
#: Rows of one range of the order at most on average; distinct words that a task remembers.
RANGE_ROWS = 65536
WORDS_KEPT = 1_000_000
IDS_AT_ONCE = 1_000_000
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: What a vocabulary must do before its merges for ``Encoder`` to work word by word
#: (fixed values of the published vocabulary).
NORMAL = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Letters that are composed already and have one lower-case letter.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017f]+")


class Encoder:
    """Ids of whole texts, as bytes of ``dtype``.

    A vocabulary of the known kind drops white space and never looks across it, so
    words are encoded once each and remembered. Its normal form and split do no more
    to a word of composed Latin letters than lower case: such a word goes to the merges
    directly, and ASCII marks after it are a word of their own. Others take the whole way.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(vocabulary)
        small = max(self.tokenizer.get_vocab_size(), END + 1) <= 1 << 16
        self.dtype = np.dtype("<u2" if small else "<u4")
        self.code = "H" if small else "I"
        self.end = array(self.code, [END]).tobytes()
        parts = json.loads(vocabulary)
        normal = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        split = [n.get("pattern", {}).get("Regex") for n in (parts["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_words = normal == NORMAL and split == [SPLIT, None]
        self.merges = self.tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        letters = filter(LATIN.fullmatch, map(chr, range(0xC0, 0x180)))
        self.spelled = str.maketrans({c: as_bytes(c)[0][0] for c in letters})
        self.words: dict[str, bytes] = {"": b""}

    def learn(self, words: Iterable[str]) -> None:
        others, tails = [], {}
        for word in words:
            bare = word.rstrip(string.punctuation)
            if LATIN.fullmatch(bare):
                known = self.words.get(bare)
                if known is None:
                    spelled = bare.lower().translate(self.spelled)
                    ids = [piece.id for piece in self.merges.tokenize(spelled)]
                    known = self.words[bare] = array(self.code, ids).tobytes()
                if len(bare) < len(word):
                    tails[word] = known, word[len(bare) :]
            else:
                others.append(word)
        others += {tail for _, tail in tails.values()}.difference(self.words)
        if others:
            found = self.tokenizer.encode(others, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, self.dtype)
            ends = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(others) + 1)).tolist()
            for i, word in enumerate(others):
                self.words[word] = ids[ends[i] : ends[i + 1]].tobytes()
        for word, (known, tail) in tails.items():
            self.words[word] = known + self.words[tail]

    def encode(self, text: str | None) -> bytes:
        if not self.by_words:
            return np.array(self.tokenizer.encode(text or "", add_special_tokens=False).ids, self.dtype).tobytes() + self.end
        words = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        found = list(map(self.words.get, words))
        new = {word for word, ids in zip(words, found) if ids is None}
        if new:
            if len(self.words) + len(new) > WORDS_KEPT:
                self.words, new = {"": b""}, {w for w in words if w}
            self.learn(new)
            found = map(self.words.__getitem__, words)
        return b"".join(found) + self.end


class Projection:
    """Hashed signed counts of ids and their projection, in whole numbers."""

    def __init__(self, ids: int) -> None:
        draw = np.random.default_rng(SEED)
        self.bucket = draw.integers(0, BUCKETS, ids)
        self.sign = draw.choice(np.array([-1.0, 1.0]), ids)
        self.onto = np.rint(draw.standard_normal((BUCKETS, DIMS)) * 1024).astype(np.int64)

    def of(self, texts: list[np.ndarray]) -> np.ndarray:
        """One row of ``DIMS`` whole numbers per text; few ids at a time."""
        ends = np.cumsum([len(t) for t in texts]) // IDS_AT_ONCE
        cuts = np.flatnonzero(np.diff(ends, prepend=-1))
        return np.concatenate([self.some(texts[a:b]) for a, b in zip(cuts, [*cuts[1:], len(texts)])])

    def some(self, texts: list[np.ndarray]) -> np.ndarray:
        lengths = np.array([len(t) for t in texts])
        ids = np.concatenate(texts)
        at = np.repeat(np.arange(len(texts)), lengths) * BUCKETS + self.bucket[ids]
        # Sums of +1 and -1 are exact in floating point.
        counts = np.bincount(at, self.sign[ids], len(texts) * BUCKETS).reshape(len(texts), BUCKETS)
        counts = counts.astype(np.int64)
        norm = np.sqrt(np.maximum((counts**2).sum(1), 1).astype(np.float64))
        return np.rint((counts @ self.onto) * float(UNIT // 1024) / norm[:, None]).astype(np.int64)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of rows of cell numbers (below 2 ** bits).

    From the highest bit down, the axes are turned so that each half of the cube
    is walked from where the half before it ended; the Gray code of the turned
    bits then counts along the curve.
    """
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in range(dims):
            upper = (x[:, axis] >> bit) & 1 == 1
            swap = np.where(upper, 0, (x[:, 0] ^ x[:, axis]) & low)
            x[:, 0] ^= np.where(upper, low, swap)
            if axis:
                x[:, axis] ^= swap
    for axis in range(1, dims):
        x[:, axis] ^= x[:, axis - 1]
    flip = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, -1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip[:, None]
    place = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(dims):
            place = place << 1 | (x[:, axis] >> bit) & 1
    return place


def encoded(docs: DataFrame, vocabulary: str, ids: int, text: str = "text") -> DataFrame:
    """(rid, doc_id as text, n, p0..., ids) of every row, written once."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)  # one vocabulary file: a fixed size

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, projection = Encoder(sent.value), Projection(ids)
        for batch in batches:
            seen: dict[str | None, bytes] = {}
            for t in batch.text:
                if t not in seen:
                    seen[t] = encoder.encode(t)
            distinct = list(seen)
            lists = [np.frombuffer(seen[t], encoder.dtype) for t in distinct]
            at = {t: i for i, t in enumerate(distinct)}
            place = np.array([at[t] for t in batch.text], np.int64)
            if not len(place):
                continue
            points = projection.of(lists)[place]
            out = {"rid": batch.rid, "doc_id": batch.doc_id, "n": [len(lists[i]) for i in place]}
            out |= {f"p{d}": points[:, d] for d in range(DIMS)}
            yield pd.DataFrame(out | {"ids": [seen[t] for t in batch.text]})

    slim = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("string"), F.col(text).alias("text")
    )
    points = ", ".join(f"p{d} long" for d in range(DIMS))
    shape = f"rid long, doc_id string, n long, {points}, ids binary"
    path = shared_folder(spark)
    slim.mapInPandas(rows, shape).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(shape).parquet(path)


def curve_key(points: DataFrame) -> Column:
    """The Hilbert key from p0...: cells of equal width over three spreads of all rows."""
    sums = points.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(f"p{d}").alias(f"s{d}") for d in range(DIMS)],
        *[F.sum(F.col(f"p{d}").cast("decimal(38,0)") * F.col(f"p{d}")).alias(f"q{d}") for d in range(DIMS)],
    ).first()
    rows = max(1, sums.rows)
    mean = np.array([(sums[f"s{d}"] or 0) / rows for d in range(DIMS)])
    square = np.array([float(sums[f"q{d}"] or 0) / rows for d in range(DIMS)])
    spread = np.sqrt(np.maximum(square - mean**2, 1.0))

    @F.pandas_udf("long")
    def key(p0: pd.Series, p1: pd.Series, p2: pd.Series, p3: pd.Series) -> pd.Series:
        x = (np.stack([p0, p1, p2, p3], 1) - mean) / spread
        cells = np.floor((x + 3) / 6 * (1 << BITS)).clip(0, (1 << BITS) - 1)
        return pd.Series(hilbert(cells.astype(np.int64)))

    return key(*[F.col(f"p{d}") for d in range(DIMS)])


def laid_out(slim: DataFrame) -> DataFrame:
    """(rid, at): the ids before each row in the order of (key, rid)."""
    slim = stored(slim)
    ranges = max(1, math.ceil(slim.count() / RANGE_ROWS))
    dealt = slim.repartitionByRange(ranges, "key", "rid").withColumn("part", F.spark_partition_id())
    dealt = stored(dealt)
    totals = dealt.groupBy("part").agg(F.sum("n").alias("total"))
    # One row per range.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy("key", "rid").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return placed.join(starts, "part").select("rid", (F.col("start") + F.col("inside")).alias("at"))


def pack(
    docs: DataFrame, path: str | None = None, text: str = "text", length: int = LENGTH, with_ids: bool = True
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and ``ids``, the piece itself as little-endian unsigned 32-bit numbers (null
    if they are not wanted)."""
    from tokenizers import Tokenizer

    with open(path or vocabulary_path(), encoding="utf-8") as file:
        vocabulary = file.read()
    ids = max(Tokenizer.from_str(vocabulary).get_vocab_size(), END + 1)
    dtype = "<u2" if ids <= 1 << 16 else "<u4"
    rows = encoded(docs, vocabulary, ids, text)
    slim = rows.select("rid", curve_key(rows).alias("key"), "n")
    places = laid_out(slim)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, buffer, n, at in zip(batch.doc_id, batch.ids, batch.n, batch["at"]):
                whole, start = np.frombuffer(buffer, dtype).astype("<u4"), 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(n - start, length - offset)
                    piece = whole[start : start + size].tobytes()
                    out.append((doc_id, start, size, zlib.crc32(piece), n, sequence, offset, piece if with_ids else None))
                    start += size
            yield pd.DataFrame(out, columns=[*[c.split()[0] for c in PIECE.split(", ")], "ids"])

    # The slim side is built in memory, so the ids are not sorted.
    meet = rows.select("rid", "doc_id", "ids", "n").join(places.hint("shuffle_hash"), "rid")
    pieces = meet.select("doc_id", "ids", "n", "at").mapInPandas(
        cut, PIECE.replace("doc_id long", "doc_id string") + ", ids binary"
    )
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, with_ids=False).drop("ids")
