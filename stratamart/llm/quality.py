"""Quality scores: random-indexing word vectors pooled per document, then a
two-layer network with temperature-calibrated probabilities.

Random indexing: every word has a fixed sparse index vector (``SEEDS`` entries
of +1 or -1 out of ``DIMS``), drawn from its hash bucket; the vector of a word
is the sum of the index vectors of its neighbors, two on either side, over the
fitting sample. Words are runs of letters and digits or of other signs; digits
count as one, and a word in capitals adds the mark of capitals. A document is
the mean of its words' vectors, the mean of their index vectors (whose length
tells how much words repeat), the share of words without a vector, the share
that repeat the word before, and its length. A network of ``HIDDEN`` units learns quality by Adam; one temperature,
chosen on a part of the sample kept from training, scales its logits.

The fit takes at most ``SAMPLE`` labelled rows, chosen by hash, none of them
held out; it never sees label, language, source or id as a feature. Everything
that is sent to tasks is bounded by ``BUCKETS`` and ``DIMS``.

Defined results: null and empty texts are scored like any other (all features
but the length are 0); a row without doc_id is not held out; several labels of
one doc_id are averaged, null labels ignored; with no labels of one kind the
score is the share of good labels (0.5 without labels); repeated rows get equal
scores; other columns are kept.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import crc_of_id, part_of_md5, stored, table

SAMPLE = 12_000
BUCKETS = 1 << 15
DIMS = 32
SEEDS = 4
WINDOW = 2
HIDDEN = 32
THRESHOLD = 0.3
#: Words that are gathered at once in a task.
WORDS_AT_ONCE = 10_000
#: Tokens of up to so many words are added up together, longer ones one by one.
FEW = 6
#: Distinct tokens whose buckets a task keeps.
CACHE = 300_000
PIECES = re.compile(r"\d+|[^\W\d_]+|[^\w\s]+|_+")
CAPITALS = zlib.crc32(b"<capitals>") % BUCKETS


def index_vectors() -> np.ndarray:
    """The sparse ternary index vector of each bucket."""
    rng = np.random.default_rng(20240130)
    out = np.zeros((BUCKETS, DIMS), np.float32)
    places = rng.random((BUCKETS, DIMS)).argsort(1)[:, :SEEDS]
    signs = rng.choice(np.array([-1.0, 1.0], np.float32), (BUCKETS, SEEDS))
    np.put_along_axis(out, places, signs, axis=1)
    return out


def buckets_of(token: str) -> list[int]:
    """Word buckets of a token between white space."""
    out = []
    for piece in PIECES.findall(token):
        word = "0" if piece[0].isdigit() else piece
        if len(word) > 1 and word.isupper():
            out.append(CAPITALS)
        # A run of one sign is one word, whatever its length.
        out.append(zlib.crc32((word if word[0].isalnum() else word[:3]).encode()) % BUCKETS)
    return out


def token_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(code of each token, tokens per text, distinct tokens)."""
    lists = [t.split() for t in texts]
    lengths = np.array([len(x) for x in lists], np.int64)
    flat = np.empty(int(lengths.sum()), object)
    flat[:] = [w for x in lists for w in x]
    codes, unique = pd.factorize(flat)
    return codes, lengths, list(unique)


def slices(texts: list[str], most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most or i == len(texts) - 1:
            yield first, i + 1
            first, size = i + 1, 0


def context_sums(texts: list[str]) -> np.ndarray:
    """Random-indexing sums of this part of the sample, per bucket."""
    index, total = index_vectors(), np.zeros((BUCKETS, DIMS), np.float32)
    for text in texts:
        codes, _, unique = token_codes([text])
        parts = [buckets_of(w) for w in unique]
        word = np.array([b for c in codes for b in parts[c]], np.int64)
        near = np.zeros((len(word), DIMS), np.float32)
        for d in range(1, WINDOW + 1):
            near[d:] += index[word[:-d]]
            near[:-d] += index[word[d:]]
        order = np.argsort(word, kind="stable")
        if len(order):
            names, heads = np.unique(word[order], return_index=True)
            total[names] += np.add.reduceat(near[order], heads)
    return total


def word_table(vectors: np.ndarray, known: np.ndarray) -> np.ndarray:
    """What each word bucket adds to a text: vector, index vector, unknown, one."""
    one = np.ones((BUCKETS, 1), np.float32)
    return np.hstack([vectors, index_vectors(), one - known[:, None], one]).astype(np.float32)


def pooled(texts: list[str], words_: np.ndarray, seen: dict[str, list[int]]) -> np.ndarray:
    """Features of each text: (texts, 2 * DIMS + 5). ``seen`` caches tokens' buckets."""
    codes, lengths, unique = token_codes(texts)
    if len(seen) > CACHE:
        seen.clear()
    parts = []
    for token in unique:
        found = seen.get(token)
        if found is None:
            found = seen[token] = buckets_of(token)
        parts.append(found)
    flat = np.array([b for p in parts for b in p], np.int64)
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(sizes) - sizes
    of_token = words_[flat[starts]] if len(flat) else words_[:0]
    for more in range(1, FEW):
        longer = np.flatnonzero((sizes > more) & (sizes <= FEW))
        of_token[longer] += words_[flat[starts[longer] + more]]
    for i in np.flatnonzero(sizes > FEW):
        of_token[i] = words_[parts[i]].sum(0)
    sums = np.zeros((len(texts), words_.shape[1]), np.float64)
    ends = np.cumsum(lengths)
    for i, end in enumerate(ends):
        for start in range(end - lengths[i], end, WORDS_AT_ONCE):
            sums[i] += of_token[codes[start : min(end, start + WORDS_AT_ONCE)]].sum(0)
    owner = np.repeat(np.arange(len(texts)), lengths)
    echo = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    echoes = np.bincount(owner[1:][echo], minlength=len(texts)) / np.maximum(lengths, 1)
    words = sums[:, -1:]
    mean = sums[:, :-1] / np.maximum(words, 1)
    return np.hstack(
        [
            mean,
            np.linalg.norm(mean[:, :DIMS], axis=1, keepdims=True),
            np.log1p(np.linalg.norm(mean[:, DIMS : 2 * DIMS], axis=1, keepdims=True)),
            np.log1p(words),
            echoes[:, None],
        ]
    )


@dataclass
class Model:
    vectors: np.ndarray
    known: np.ndarray
    center: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    constant: float | None = None

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((features - self.center) / self.spread @ w1 + b1) @ w2 + b2

    def scores(self, texts: list[str], words_: np.ndarray, seen: dict[str, list[int]]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        z = self.logits(pooled(texts, words_, seen)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(x: np.ndarray, y: np.ndarray, steps: int = 3000, rate: float = 3e-3, batch: int = 256) -> tuple:
    """(center, spread, layers, temperature) from features and labels in a fixed order."""
    rng = np.random.default_rng(7)
    kept = np.arange(len(y)) % 5 == 0  # for the temperature
    xt, yt = x[~kept], y[~kept]
    center, spread = xt.mean(0), xt.std(0) + 1e-6
    xt = (xt - center) / spread
    d = x.shape[1]
    layers = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    for step in range(1, steps + 1):
        at = rng.integers(0, len(yt), batch)
        h = np.tanh(xt[at] @ layers[0] + layers[1])
        error = (1 / (1 + np.exp(-np.clip(h @ layers[2] + layers[3], -500, 500))) - yt[at]) / batch
        back = np.outer(error, layers[2]) * (1 - h**2)
        grads = [xt[at].T @ back + 1e-4 * layers[0], back.sum(0), h.T @ error + 1e-4 * layers[2], error.sum(keepdims=True)]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g**2
            layers[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    z = Model(x, x, center, spread, layers, 1.0).logits(x[kept])
    heat = min(np.exp(np.linspace(-2, 2.5, 91)), key=lambda t: loss(z / t, y[kept]))
    return center, spread, layers, float(heat)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows that are not held out."""
    spark = docs.sparkSession
    open_ = labels.filter(F.col("quality").isNotNull() & (crc_of_id() % 5 != 0))
    graded = open_.groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("quality"))
    turn = part_of_md5(F.col("doc_id").cast("string"), 1, 12)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chosen = graded.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(turn, "doc_id").limit(sample)
    drawn = stored(texts.join(F.broadcast(chosen), "doc_id"))  # at most ``sample`` ids

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BUCKETS, DIMS), np.float32)
        for batch in batches:
            total += context_sums(list(batch.text))
        yield pd.DataFrame({"total": [total.tobytes()]})

    vectors = np.zeros((BUCKETS, DIMS), np.float32)
    for row in drawn.select("text").repartition(4, "text").mapInPandas(sums, "total binary").toLocalIterator():
        vectors += np.frombuffer(row.total, np.float32).reshape(BUCKETS, DIMS)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    known = (length[:, 0] > 0).astype(np.float32)
    vectors = (vectors / np.maximum(length, 1e-9)).astype(np.float32)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_, seen = word_table(vectors, known), {}
        for batch in batches:
            found = list(batch.text)
            for first, last in slices(found):
                x = pooled(found[first:last], words_, seen)
                yield pd.DataFrame(
                    {
                        "doc_id": batch.doc_id.iloc[first:last],
                        "quality": batch.quality.iloc[first:last],
                        "x": [row.tobytes() for row in x],
                    }
                )

    rows = drawn.mapInPandas(features, "doc_id long, quality double, x binary").toPandas()
    rows = rows.sort_values(["doc_id", "x"]).reset_index(drop=True)
    y = (rows.quality.to_numpy(float) >= 0.5).astype(float)
    plain = Model(vectors, known, np.zeros(1), np.ones(1), [], 1.0)
    if len(y) < 10 or y.min() == y.max():
        plain.constant = float(y.mean()) if len(y) else 0.5
        return plain
    rng = np.random.default_rng(11)
    order = rng.permutation(len(y))
    x = np.stack([np.frombuffer(b, np.float64) for b in rows.x])[order]
    center, spread, layers, heat = train(x, y[order])
    return Model(vectors, known, center, spread, layers, heat)


def score(model: Model, text: Column) -> Column:
    """Probability of good quality of each whole text."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words_, seen = word_table(model.vectors, model.known), {}
        for batch in batches:
            texts = [t or "" for t in batch]
            parts = [model.scores(texts[a:b], words_, seen) for a, b in slices(texts)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return scores(text)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(crc_of_id() % 5 == 0, F.lit(False)).alias("held_out")
    scored = docs.select("doc_id", held_out, score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
