"""Log-probabilities of texts: a word unigram base and a causal self-attention model.

Base: words between white space (A-Z lower-cased) and an end, each with
log10((c + 0.5) / (N + 0.5 (V + 1))), c counted over all training rows. Counts
of words with a millionth of all tokens or more (a million at most) go to the
tasks; the other words of each document meet their counts by a join, so the
vocabulary may grow with the corpus. Texts are read and encoded once.

Model: the words, joined by single spaces, become subword ids of a public
vocabulary, then an end. Ids fall into ``CLASSES`` classes (frequent ones alone,
the others by kind and by the frequent ids around them, which tells languages
apart). Causal self-attention over the classes of up to ``WINDOW`` tokens gives
the next class; the id within its class follows its count over all training rows,
inside a word also given the class before it. Windows overlap by half: each token
is scored once, with at least half a window before it where the text has that, in
batches of masked attention. Classes come from the ids of all training rows. The
attention weights are trained in numpy (Adam): started on a bounded sample of
windows, then each task goes through all windows of its training rows, and the
tasks' weights are averaged.

At the start of a word attention first says whether a word begins (the chance
that the word before ends there), then which class it begins with. A word's
probability given that class is a mixture: ``SHARE`` of the frequent words that
begin with the class, by their counts, and the rest of the product over its ids
and its ending. The score is the sum of the words' log10 probabilities and the
end's: that of the text's own segmentation.

Words are told apart by 64-bit hashes of them and of their ids. Defined results: null texts are empty
ones (just an end); rows without doc_id are training rows, not held out;
repeated rows are scored each; without training rows N and V are 0 and all
classes are equally likely; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import crc_of_id, drawn, stored, table
from stratamart.llm.subwords import PIECES, encoding, sent

CLASSES = 64
ALONE = 39
#: Classes of other ids: letters that begin a word or go on in one, then the rest likewise.
KINDS = (12, 8, 2, 2)
#: Rounds of clustering by company, and the weight of the average company.
ROUNDS, AVERAGE = 12, 20.0
#: Bits of a count of company.
THIRD = 21
DIMS = 16
WINDOW = 32
STEP = WINDOW // 2
#: Start of the training: documents of the sample, windows that each gives, steps; batch.
SAMPLE = 2000
PER_DOCUMENT = 16
STEPS = 1500
BATCH = 128
#: Rows of a product of narrow matrices: about the most that BLAS multiplies without packing.
CHUNK = 128
#: Rate of the steps over all training windows, and windows that a task holds at once.
RATE = 0.002
WINDOWS_HELD = 4096
#: Ids with the class before them that a task gathers before it counts them.
PAIRS_HELD = 1_000_000
#: Weight of the frequent words in the mixture.
SHARE = 0.75
#: Pseudo-count of an id's chance without the class before it.
PRIOR = 20.0
#: A word with at least 1 / FREQUENT of all tokens is sent to the tasks.
FREQUENT = 1_000_000
#: Words that a task gathers before it hands on their counts; bytes, ids at once.
HELD = 500_000
BATCH_CHARS = 2_000_000
BATCH_IDS = 800_000
END = PIECES
#: Scores are cut here before their exponentials are summed, lest these overflow.
TOP = np.float32(60)
BITS = math.log2(10)
START = CLASSES  # a class only of inputs


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def keys_of(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, whose ids begin at ``first``: sums of their ids times odd
    numbers drawn for each place in a word, mixed."""
    if not len(first):
        return np.zeros(0, np.int64)
    size = np.diff(first, append=len(ids))
    place = np.arange(len(ids), dtype=np.int64) - np.repeat(first, size)
    factor = scrambled(np.arange(1, int(size.max()) + 1).astype(np.uint64)) | np.uint64(1)
    return scrambled(np.add.reduceat((ids.astype(np.uint64) + np.uint64(1)) * factor[place], first)).view(np.int64)


def scrambled(x: np.ndarray) -> np.ndarray:
    """Whole numbers of 64 bits spread over all of them, one to one."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def packed(ids: np.ndarray, size: np.ndarray) -> pa.Array:
    """Pieces of ``ids``, ``size`` long each, as binary rows of 16-bit numbers."""
    borders = np.append(0, 2 * np.cumsum(size)).astype(np.int32)
    data = pa.py_buffer(ids.astype(np.uint16).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(borders), data])


def flat_bytes(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows (null: none) and the borders between them, from 0."""
    if not len(rows):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    rows = pc.fill_null(rows.cast(pa.large_binary()), b"")
    _, borders, data = rows.buffers()
    borders = np.frombuffer(borders, np.int64)[rows.offset : rows.offset + len(rows) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def words_in(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``words_of`` finds in texts within ``borders`` of their bytes: the bytes of all
    words, A-Z lower-cased, where each word begins there, and how many words a text has."""
    data = data + np.uint8(32) * (data - np.uint8(65) < 26)
    inside = ~((data == 32) | (data - np.uint8(9) < 5))
    edge = np.append(True, ~inside)
    edge[borders] = True
    first = np.flatnonzero(inside & edge[:-1])
    lengths = np.diff(np.searchsorted(first, borders))
    return data[inside], np.cumsum(inside)[first] - 1, lengths


def clusters(company: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Weighted k-means of rows, from the heaviest row on by the farthest ones."""
    if not len(company):
        return np.zeros(0, np.int64)
    centers = company[[weight.argmax()]]
    for _ in range(k - 1):
        apart = np.min([((company - c) ** 2).sum(1) for c in centers], axis=0)
        centers = np.vstack([centers, company[(apart * weight).argmax()]])
    for _ in range(ROUNDS):
        of = ((centers**2).sum(1) - 2 * company @ centers.T).argmin(1)
        total = np.bincount(of, weights=weight, minlength=k)
        sums = np.stack([np.bincount(of, weights=weight * x, minlength=k) for x in company.T], axis=1)
        centers = np.where(total[:, None] > 0, sums / np.maximum(total, 1e-9)[:, None], centers)
    return of


def usual_ids(counts: np.ndarray) -> np.ndarray:
    """All ids, the most frequent first; the first ``ALONE`` are classes of their own."""
    return np.argsort(-counts, kind="stable")


def company_of(windows: np.ndarray, order: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """How often the ``ALONE`` frequent ids share a window with each id (negative, END: none);
    added to ``out``, where given."""
    out = np.zeros((PIECES, ALONE)) if out is None else out
    # An id and a frequent one that share windows of n do so n * n / 4 times in each at most:
    # counts of that many windows fit a third of 64 bits.
    most = ((1 << THIRD) - 1) // max(1, windows.shape[1] ** 2 // 4)
    for begin in range(0, len(windows), most):
        add_company(windows[begin : begin + most], order, out)
    return out


def add_company(windows: np.ndarray, order: np.ndarray, out: np.ndarray) -> None:
    """One step of ``company_of``."""
    real = (windows >= 0) & (windows < END)
    at, ids = np.nonzero(real)[0], windows[real]
    place = np.full(PIECES, -1)
    place[order[:ALONE]] = np.arange(ALONE)
    here = place[ids]
    usual = here >= 0
    around = np.bincount(at[usual] * ALONE + here[usual], minlength=len(windows) * ALONE)
    around = around.reshape(-1, ALONE).astype(np.int32)
    # Frequent ids, near half of all, by a product (whole numbers below 2**53); the rest in
    # the order of their ids, which 16 bits hold, three counts in a number.
    out[order[:ALONE]] += around.T.astype(float) @ around
    at, ids = at[~usual], ids[~usual]
    if len(ids):
        turn = np.argsort(ids.astype(np.uint16), kind="stable")
        first = np.flatnonzero(np.diff(ids[turn], prepend=-1))
        three = np.zeros((len(around), -(-ALONE // 3) * 3), np.int64)
        three[:, :ALONE] = around
        three = three.reshape(len(around), -1, 3) @ (1 << THIRD * np.arange(3))
        # Sums along rows are much faster than down columns.
        sums = np.add.reduceat(three.T.copy().take(at[turn], axis=1), first, axis=1).T
        sums = sums[:, :, None] >> THIRD * np.arange(3) & (1 << THIRD) - 1
        out[ids[turn][first]] += sums.reshape(len(first), -1)[:, :ALONE]


def classes_from(
    counts: np.ndarray, company: np.ndarray, order: np.ndarray, table_: dict[bytes, int], begins: np.ndarray
) -> np.ndarray:
    """Class of each id and of the end, from the ids' counts and company.

    No class holds both ids that begin words and ids that do not."""
    of = np.zeros(PIECES + 1, np.int64)
    of[order[:ALONE]] = np.arange(ALONE)
    mean = (company.sum(0) + 1) / (company.sum() + ALONE)
    company = company + AVERAGE * mean
    company = np.sqrt(company / company.sum(1, keepdims=True))
    kinds = np.full(PIECES, 2)
    for piece, rank in table_.items():
        body = piece.strip()
        if body and (body.isalpha() or body[0] >= 0x80):
            kinds[rank] = 0
    kinds += ~begins[:PIECES]
    first = ALONE
    for kind, k in enumerate(KINDS):
        rest = order[ALONE:][kinds[order[ALONE:]] == kind]
        of[rest] = first + clusters(company[rest], counts[rest] + 0.01, k)
        first += k
    of[END] = CLASSES - 1
    return of


def class_of_ids(windows: np.ndarray, table_: dict[bytes, int], begins: np.ndarray) -> np.ndarray:
    """Class of each id and of the end, from windows (negative: none)."""
    counts = np.bincount(windows[(windows >= 0) & (windows < END)], minlength=PIECES)
    order = usual_ids(counts)
    return classes_from(counts, company_of(windows, order), order, table_, begins)


def begin_flags(table_: dict[bytes, int]) -> np.ndarray:
    """Whether an id, or the end, begins a word."""
    begins = np.zeros(PIECES + 1, bool)
    for piece, rank in table_.items():
        begins[rank] = b" " in piece
    begins[END] = True
    return begins


def id_chances(n: np.ndarray, ends: int, of: np.ndarray) -> np.ndarray:
    """log10 p(id | class, class before it) from the counts ``n`` of all training rows;
    row ``CLASSES`` is for ids that begin a word. CLASSES + 1 rows of
    PIECES + 1 ids: a fixed size."""
    n = np.hstack([n, np.zeros((CLASSES + 1, 1))])
    alone = n.sum(0) + 0.5
    alone[END] += ends
    chance = alone / np.bincount(of, weights=alone, minlength=CLASSES)[of]
    out = np.empty(n.shape, np.float32)
    for row in range(CLASSES + 1):
        per_class = np.bincount(of, weights=n[row], minlength=CLASSES)
        out[row] = np.log10((n[row] + PRIOR * chance) / (per_class[of] + PRIOR))
    return out


def times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``x @ w`` over all tokens, not window by window, in chunks (``CHUNK``)."""
    flat = x.reshape(-1, x.shape[-1])
    some, out = len(flat) // CHUNK * CHUNK, np.empty((len(flat), w.shape[1]), np.float32)
    np.matmul(flat[:some].reshape(-1, CHUNK, x.shape[-1]), w, out=out[:some].reshape(-1, CHUNK, w.shape[1]))
    if some < len(flat):
        np.matmul(flat[some:], w, out=out[some:])
    return out.reshape(*x.shape[:-1], w.shape[1])


def outer(x: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Sum over all tokens of windows of the products of ``x`` and ``d``, in chunks."""
    x, d = x.reshape(-1, x.shape[-1]), d.reshape(-1, d.shape[-1])
    some = len(x) // CHUNK * CHUNK
    parts = x[:some].reshape(-1, CHUNK, x.shape[1]).transpose(0, 2, 1) @ d[:some].reshape(-1, CHUNK, d.shape[1])
    return parts.sum(0) + x[some:].T @ d[some:] if some < len(x) else parts.sum(0)


def turned(x: np.ndarray) -> np.ndarray:
    """Windows with rows and columns exchanged, in that order in memory: products with
    a second factor that is only seen so take twice as long."""
    return x.transpose(0, 2, 1).copy()


class Adam:
    """Steps along gradients, changing the weights in place: views of one array from now on."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.names, self.steps = list(w), 0
        self.w = np.concatenate([w[n].ravel() for n in w])
        for n, part in zip(self.names, np.split(self.w, np.cumsum([w[n].size for n in w])[:-1])):
            w[n] = part.reshape(w[n].shape)
        self.first, self.second = np.zeros_like(self.w), np.zeros_like(self.w)

    def step(self, grads: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        g = np.concatenate([grads[n].ravel() for n in self.names])
        self.first = 0.9 * self.first + 0.1 * g
        self.second = 0.99 * self.second + 0.01 * g * g
        mean, spread = self.first / (1 - 0.9**self.steps), self.second / (1 - 0.99**self.steps)
        self.w -= (rate * mean / (np.sqrt(spread) + 1e-8)).astype(np.float32)


@dataclass
class Attention:
    """One layer of causal self-attention with positions, then next-class scores."""

    of: np.ndarray
    inside: np.ndarray  # log10 p(id | class, class before it in the word)
    begins: np.ndarray  # whether an id begins a word
    w: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        # Which classes count for all tokens, and for those that begin a word.
        self.sides = np.ones((CLASSES, 2), np.float32)
        self.sides[:, 1] = np.bincount(self.of[self.begins], minlength=CLASSES) > 0
        if not self.w:
            rng = np.random.default_rng(5)
            d = DIMS
            shapes = {
                "embed": (CLASSES + 1, d), "place": (WINDOW, d), "q": (d, d), "k": (d, d), "v": (d, d),
                "mix": (2 * d, 2 * d), "bias": (2 * d,), "out": (2 * d, CLASSES), "top": (CLASSES,),
            }
            self.w = {n: (rng.normal(0, 0.3, s)).astype(np.float32) for n, s in shapes.items()}

    def projection(self) -> np.ndarray:
        """Of a token to its query, key and value."""
        return np.concatenate([self.w["q"] * np.float32(DIMS**-0.5), self.w["k"], self.w["v"]], axis=1)

    def forward(self, x: np.ndarray, first: int) -> tuple[np.ndarray, dict]:
        """Next-class scores after the inputs ``first:`` of windows (n, length)."""
        z, s = self.hidden(x)
        return (z + self.w["top"])[:, first:], s

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, dict]:
        """Next-class scores but for their common part (``top``) after all inputs of windows."""
        w, length = self.w, x.shape[1]
        e = np.take(w["embed"], x, axis=0)
        e += w["place"][:length]
        qkv = times(e, self.projection())
        a = qkv[:, :, :DIMS] @ turned(qkv[:, :, DIMS : 2 * DIMS])
        np.exp(np.clip(a, -TOP, TOP, out=a), out=a)
        a *= np.tri(length, dtype=np.float32)
        a *= 1 / (a @ np.ones((length, 1), np.float32))
        # One more input is the bias's.
        h = np.empty((*x.shape, 2 * DIMS + 1), np.float32)
        h[:, :, :DIMS], h[:, :, 2 * DIMS] = e, 1
        np.matmul(a, qkv[:, :, 2 * DIMS :], out=h[:, :, DIMS : 2 * DIMS])
        g = times(h, np.vstack([w["mix"], w["bias"]]))
        np.clip(g, 0, np.inf, out=g)
        return times(g, w["out"]), {"e": e, "qkv": qkv, "a": a, "h": h, "g": g}

    def tables(self) -> tuple[np.ndarray, ...]:
        """For each place and class before it: key; value, with a 1; query; its part of the mixture."""
        w = self.w
        e = w["embed"] + w["place"][:, None]
        qkv = e @ self.projection()
        v = np.concatenate([qkv[:, :, 2 * DIMS :], np.ones((*e.shape[:2], 1), np.float32)], axis=2)
        parts = (qkv[:, :, DIMS : 2 * DIMS], v, qkv[:, :, :DIMS], e @ w["mix"][:DIMS] + w["bias"])
        return tuple(np.ascontiguousarray(x.reshape(-1, x.shape[2])) for x in parts)

    def log_chances(self, x: np.ndarray, y: np.ndarray, first: int, tables=None) -> tuple[np.ndarray, np.ndarray]:
        """log10 p of the classes ``y`` that follow the inputs ``first:``, those of
        a beginning given that a word begins; and log10 p that a word begins."""
        keys, values, queries, own = tables or self.tables()
        length = x.shape[1]
        at = x + np.arange(length) * (CLASSES + 1)
        late = np.ascontiguousarray(at[:, first:])
        a = keys.take(at, axis=0) @ turned(queries.take(late, axis=0))
        np.exp(np.clip(a, -TOP, TOP, out=a), out=a)
        a *= np.tri(length, dtype=np.float32)[first:].T.copy()
        c = a.transpose(0, 2, 1) @ values.take(at, axis=0)
        g = times(c[:, :, :DIMS] * (1 / c[:, :, DIMS:]), self.w["mix"][DIMS:])
        g += own.take(late, axis=0)
        np.clip(g, 0, np.inf, out=g)
        z = times(g, self.w["out"]).reshape(-1, CLASSES)
        np.clip(z, -TOP, TOP, out=z)
        following, top = y.ravel(), np.clip(self.w["top"], -TOP, TOP)
        picked = z.ravel().take(np.arange(y.size) * CLASSES + following) + top[following]
        total = np.log(np.exp(z, out=z) @ (self.sides * np.exp(top)[:, None]))
        begin = total[:, 1] - total[:, 0]
        known = np.where(self.sides[:, 1].take(following) > 0, total[:, 1], total[:, 0])
        ten = np.float32(math.log(10))
        return ((picked - known) / ten).reshape(y.shape), (begin / ten).reshape(y.shape)

    def gradients(self, x: np.ndarray, y: np.ndarray, real: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of the next classes ``y`` of windows."""
        w = self.w
        z, s = self.hidden(x)
        h, qkv = s["h"], s["qkv"]
        dz, following = z.reshape(-1, CLASSES), y.ravel()
        np.exp(np.clip(dz, -TOP, TOP, out=dz), out=dz)
        # Gradients are ``share * dz * often``, the factors left to the smaller products.
        often = np.exp(np.clip(w["top"], -TOP, TOP))
        share = (real / max(1, real.sum())).ravel().astype(np.float32)
        total = dz @ often
        dz.ravel()[np.arange(y.size) * CLASSES + following] -= total / often[following]
        share /= total
        wide = share.reshape(*y.shape, 1)
        grads = {"top": share @ dz * often, "out": outer(s["g"] * wide, dz) * often}
        # The gradients of queries, keys, values and of the mixture stand side by side.
        d = np.empty((*x.shape, 5 * DIMS), np.float32)
        dg = d[:, :, 3 * DIMS :]
        np.multiply(times(dz, (w["out"] * often).T.copy()).reshape(dg.shape), (s["g"] > 0) * wide, out=dg)
        both = outer(h, dg)
        grads["mix"], grads["bias"] = both[:-1], both[-1]
        dc = times(dg, w["mix"][DIMS:].T.copy())
        da = dc @ turned(qkv[:, :, 2 * DIMS :])
        da -= np.einsum("nld,nld->nl", dc, h[:, :, DIMS:-1])[:, :, None]
        da *= s["a"]
        np.matmul(da, qkv[:, :, DIMS : 2 * DIMS], out=d[:, :, :DIMS])
        np.matmul(da.transpose(0, 2, 1), qkv[:, :, :DIMS], out=d[:, :, DIMS : 2 * DIMS])
        np.matmul(s["a"].transpose(0, 2, 1), dc, out=d[:, :, 2 * DIMS : 3 * DIMS])
        dq, grads["k"], grads["v"] = np.split(outer(s["e"], d[:, :, : 3 * DIMS]), 3, axis=1)
        grads["q"] = dq * np.float32(DIMS**-0.5)
        de = times(d, np.vstack([self.projection().T, w["mix"][:DIMS].T]))
        grads["place"], grads["embed"] = np.zeros_like(w["place"]), np.zeros_like(w["embed"])
        grads["place"][: x.shape[1]] = de.sum(0)
        # Sums of the tokens of each class, in the order of the classes.
        flat = x.ravel().astype(np.uint8)
        turn = np.argsort(flat, kind="stable")
        flat = flat[turn]
        first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        grads["embed"][flat[first]] = np.add.reduceat(de.reshape(-1, DIMS).take(turn, axis=0), first, axis=0)
        return grads

    def train(self, x: np.ndarray, y: np.ndarray, real: np.ndarray) -> None:
        """Adam on windows (n, WINDOW) of inputs, next classes and their validity."""
        rng, adam = np.random.default_rng(6), Adam(self.w)
        for step in range(1, STEPS + 1):
            at = rng.integers(0, len(x), BATCH)
            rate = 0.01 * min(1.0, 2 * (1 - step / (STEPS + 1)))
            adam.step(self.gradients(x[at], y[at], real[at]), rate)

    def scores(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token log10 p of its class, of the id in its class, and of a word's
        beginning there; ``ids`` runs through the texts, whose last positions
        (their ends) are at ``ends - 1``."""
        starts = np.append(0, ends[:-1])
        classes, tables = self.of[ids], self.tables()
        # Input t is the class before token t; a text's first input is START.
        inputs = np.append(START, classes[:-1])
        inputs[starts] = START
        inside = self.inside[np.where(self.begins[ids], CLASSES, inputs), ids].astype(np.float64)
        out = np.zeros((2, len(ids)))
        lengths = ends - starts
        # The first window scores up to WINDOW tokens, each later one STEP more.
        later = np.maximum(0, -(-(lengths - WINDOW) // STEP))
        self.put(out, inputs, classes, starts, np.minimum(lengths, WINDOW), 0, tables)
        which = np.repeat(np.arange(len(ends)), later)
        number = np.arange(len(which)) - np.repeat(np.cumsum(later) - later, later)
        begin = starts[which] + (number + 1) * STEP
        self.put(out, inputs, classes, begin, np.minimum(ends[which] - begin, WINDOW), STEP, tables)
        return out[0], inside, out[1]

    def put(self, out, inputs, classes, begin, length, first: int, tables, block: int = 256) -> None:
        """Put in the class scores of the tokens ``first:`` of windows."""
        for i in range(0, len(begin), block):
            width = int(length[i : i + block].max())
            at = begin[i : i + block, None] + np.arange(width)
            real = np.arange(first, width) < length[i : i + block, None]
            at = np.minimum(at, len(inputs) - 1)
            late = at[:, first:]
            chance, begins = self.log_chances(inputs[at], classes[late], first, tables)
            late = late[real]
            out[0][late], out[1][late] = chance[real], begins[real]


def piece_ids(encoder, words: list[bytes]) -> np.ndarray:
    text = (b" " + b" ".join(words)).decode("utf-8", "replace") if words else ""
    return np.append(encoder.encode_to_numpy(text, disallowed_special=()).astype(np.int64), END)


def spelled(
    encoder, begins: np.ndarray, unique: list[bytes], codes: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts and where each ends, as ``piece_ids`` gives them one by one.

    ``codes`` number the words of all texts in ``unique``. The vocabulary never
    looks across a space, so each distinct word is encoded once, with the space
    before it, which one of its ids holds.
    """
    flat = piece_ids(encoder, unique)
    first = np.append(np.flatnonzero(begins[flat[:-1]]), len(flat) - 1)
    size = np.append(np.diff(first), 1)  # the end comes last, as a word of its own
    line = np.insert(codes, np.cumsum(lengths), len(unique)) if len(lengths) else codes
    times = size[line]
    begin = np.cumsum(times) - times
    ids = flat[np.repeat(first[line] - begin, times) + np.arange(int(times.sum()))]
    return ids, np.cumsum(times)[np.cumsum(lengths + 1) - 1]


class Book:
    """Words with their ids and counts, found by their keys; word 0 is the end."""

    def __init__(self, encoder, begins: np.ndarray):
        self.encoder, self.begins = encoder, begins
        self.keys, self.numbers = np.zeros(0, np.int64), np.zeros(0, np.int64)  # in the order of the keys
        self.ids, self.size, self.n = np.array([END], np.uint16), np.ones(1, np.int32), np.zeros(1, np.int64)

    def read(self, texts: pa.Array, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, each with its end, and how many each has. The words of training
        texts are counted. As in ``spelled``, each distinct word is encoded once."""
        data, first, lengths = words_in(*flat_bytes(texts))
        last = np.append(first, len(data))[1:]
        codes, keys = pd.factorize(keys_of(data, first))
        numbers, new = self.found(keys)
        if len(new):
            where = np.empty(len(keys), np.int64)
            where[codes[::-1]] = np.arange(len(codes))[::-1]
            self.add([data[i:j].tobytes() for i, j in zip(first[where[new]].tolist(), last[where[new]].tolist())])
        self.n += np.bincount(numbers[codes[np.repeat(training, lengths)]], minlength=len(self.n))
        codes = np.insert(numbers[codes], np.cumsum(lengths), 0)
        size = self.size[codes]
        begin, ends = np.cumsum(self.size, dtype=np.int64) - self.size, np.cumsum(size, dtype=np.int64)
        ids = self.ids[np.repeat(begin[codes] - (ends - size), size) + np.arange(int(size.sum()))]
        return ids, np.diff(ends[np.cumsum(lengths + 1) - 1], prepend=0)

    def found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words of distinct keys, and places of those that are new."""
        # Searched in their order they are found faster.
        turn = np.argsort(keys)
        spot = np.searchsorted(self.keys, keys[turn])
        new = np.append(self.keys, 0)[spot] != keys[turn]
        new |= spot == len(self.keys)
        numbers = np.append(self.numbers, 0)[spot]
        numbers[new] = len(self.n) + np.arange(np.count_nonzero(new))
        self.keys = np.insert(self.keys, spot[new], keys[turn[new]])
        self.numbers = np.insert(self.numbers, spot[new], numbers[new])
        out = np.empty(len(keys), np.int64)
        out[turn] = numbers
        return out, turn[new]

    def add(self, words: list[bytes]) -> None:
        flat = piece_ids(self.encoder, words)
        first = np.append(np.flatnonzero(self.begins[flat[:-1]]), len(flat) - 1)
        self.ids = np.concatenate([self.ids, flat[:-1].astype(np.uint16)])
        self.size = np.concatenate([self.size, np.diff(first).astype(np.int32)])
        self.n = np.concatenate([self.n, np.zeros(len(words), np.int64)])

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, counts and first ids of the counted words."""
        here = np.flatnonzero(self.n[1:]) + 1
        first = np.cumsum(self.size, dtype=np.int64) - self.size
        return keys_of(self.ids.astype(np.int64), first)[here], self.n[here], self.ids[first[here]].astype(np.int32)

    def id_counts(self) -> np.ndarray:
        """How often each id stands in the counted words."""
        weights = np.repeat(self.n, self.size)[1:]
        return np.bincount(self.ids[1:], weights=weights, minlength=PIECES).astype(np.int64)


def counted(docs: DataFrame, training: Column | None = None, vocabulary: Broadcast | None = None) -> DataFrame:
    """All texts read once: the ids of each (``ids``) with its end, as 16-bit numbers; in
    other rows, from the training texts of a task (all, if not said), words by their keys
    (``word``), with their first ids and counts, and ids (``id`` alone) with theirs."""
    vocabulary = vocabulary or sent(docs.sparkSession)
    begins = begin_flags(vocabulary.value)
    kinds = {"doc_id": pa.int64(), "training": pa.bool_(), "ids": pa.binary()}
    kinds |= {"word": pa.int64(), "id": pa.int32(), "n": pa.int64()}

    def batch_of(rows: int, **columns) -> pa.RecordBatch:
        found = [pa.array(columns[k], t) if k in columns else pa.nulls(rows, t) for k, t in kinds.items()]
        return pa.RecordBatch.from_arrays(found, list(kinds))

    def flushed(book: Book) -> Iterator[pa.RecordBatch]:
        word, n, id_ = book.counts()
        yield batch_of(len(n), word=word, id=id_, n=n)
        n = book.id_counts()
        id_ = np.flatnonzero(n)
        yield batch_of(len(id_), id=id_, n=n[id_])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(vocabulary.value)
        book = Book(encoder, begins)
        for batch in batches:
            borders, first = flat_bytes(batch.column(1))[1], 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(borders, borders[first] + BATCH_CHARS)))
                some = batch.slice(first, last - first)
                learned = some.column(2).to_numpy(zero_copy_only=False).astype(bool)
                rows = packed(*book.read(some.column(1), learned))
                yield batch_of(len(rows), doc_id=some.column(0), training=learned, ids=rows)
                first = last
                if len(book.n) > HELD:
                    yield from flushed(book)
                    book = Book(encoder, begins)
        yield from flushed(book)

    shape = "doc_id long, training boolean, ids binary, word long, id int, n long"
    training = F.lit(True) if training is None else training
    return docs.select(F.col("doc_id").cast("long"), "text", training.alias("training")).mapInArrow(work, shape)


def keep_memory() -> None:
    """Free one block of 30 MB: the allocator then keeps as much for later arrays,
    which would else be given back and cleared anew at each step."""
    np.ones(30 << 20, np.uint8)


def windows_of(rows: pa.Array) -> Iterator[np.ndarray]:
    """Windows (n, WINDOW + 1) of consecutive ids of texts and the id before them,
    each id in exactly one; -1: start, -2: none."""
    parts, held = [], 0
    for row in rows:
        ids = np.append(-1, np.frombuffer(row.as_py(), np.uint16).astype(np.int64))
        n = -(-(len(ids) - 1) // WINDOW)
        ids = np.append(ids, np.full(n * WINDOW + 1 - len(ids), -2))
        for begin in range(0, n, WINDOWS_HELD):
            some = ids[begin * WINDOW : (begin + WINDOWS_HELD) * WINDOW + 1]
            parts.append(np.lib.stride_tricks.sliding_window_view(some, WINDOW + 1)[::WINDOW])
            held += len(parts[-1])
            if held >= WINDOWS_HELD:
                yield np.concatenate(parts)
                parts, held = [], 0
    if parts:
        yield np.concatenate(parts)


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """Sums of ``size`` places from rows (at, n) of the tasks, brought together in few rows."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.ascontiguousarray(batch.column(i).to_numpy()).tobytes() for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], ["at", "n"])

    sums = parts.groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(size)
    for row in sums.mapInArrow(joined, "at binary, n binary").collect():
        out[np.frombuffer(row["at"], np.int64)] = np.frombuffer(row["n"], float)
    return out


def places(total: np.ndarray) -> pa.RecordBatch:
    """Rows (at, n) of the places that are not 0."""
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at].astype(float))], ["at", "n"])


def company_in(rows: DataFrame, order: np.ndarray) -> np.ndarray:
    """``company_of`` the windows of all ``rows``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        total = np.zeros((PIECES, ALONE))
        for batch in batches:
            for ids in windows_of(batch.column(0)):
                company_of(ids[:, 1:], order, total)
        yield places(total.ravel())

    return summed(rows.mapInArrow(work, "at long, n double"), PIECES * ALONE).reshape(PIECES, ALONE)


def averaged(rows: DataFrame, model: Attention) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Weights after a pass over all windows of ``rows``: each task goes on from the
    given ones through its windows, and the tasks' weights are averaged by windows.
    Besides, how often each id follows each class within a word."""
    names = sorted(model.w)
    of, begins, start = model.of, model.begins, {n: model.w[n] for n in names}
    marked = np.append(of, [of[0], START]).astype(np.uint8)  # -2 and -1: its last places
    goes_on = np.append(~begins, [False, False])
    size = sum(start[n].size for n in names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Attention(of, np.zeros((1, 1), np.float32), begins, {n: v.copy() for n, v in start.items()})
        keep_memory()
        adam, rng, seen = Adam(own.w), np.random.default_rng(7), 0
        pairs, found = np.zeros(CLASSES * PIECES, np.int64), []
        for batch in batches:
            for ids in windows_of(batch.column(0)):
                classes, real = marked[ids], ids[:, 1:] >= 0
                within = goes_on[ids[:, 1:]]
                found.append(classes[:, :-1][within].astype(np.int64) * PIECES + ids[:, 1:][within])
                if sum(map(len, found)) > PAIRS_HELD:
                    pairs += np.bincount(np.concatenate(found), minlength=len(pairs))
                    found.clear()
                turn = rng.permutation(len(ids))
                classes, real = classes[turn], real[turn]
                for i in range(0, len(ids), BATCH):
                    x = classes[i : i + BATCH]
                    y = np.minimum(x[:, 1:], CLASSES - 1)
                    grads = own.gradients(x[:, :-1], y, real[i : i + BATCH].astype(np.float32))
                    # A rest smaller than a batch counts for less.
                    adam.step(grads, RATE * len(x) / BATCH)
                seen += len(ids)
        if seen:
            flat = np.concatenate([own.w[n].ravel() for n in names]).astype(float)
            pairs += np.bincount(np.concatenate([*found, []]).astype(np.int64), minlength=len(pairs))
            yield places(np.concatenate([flat * seen, [seen], pairs]))

    sums = summed(rows.mapInArrow(work, "at long, n double"), size + 1 + CLASSES * PIECES)
    found = np.split((sums[:size] / sums[size]).astype(np.float32), np.cumsum([start[n].size for n in names])[:-1])
    weights = {n: part.reshape(start[n].shape) for n, part in zip(names, found)}
    return weights, sums[size + 1 :].reshape(CLASSES, PIECES)


def fit(docs: DataFrame, read: DataFrame, ends: int, vocabulary: Broadcast) -> Attention:
    """Classes from the ids of all training rows ``docs``, read before (``counted``); weights
    started on windows of at most ``SAMPLE`` documents, drawn by hash, then trained on those
    of all rows."""
    begins = begin_flags(vocabulary.value)
    rows = read.filter(F.col("training")).select("ids")
    alone = read.filter(F.col("id").isNotNull() & F.col("word").isNull())
    counts = summed(alone.select(F.col("id").cast("long").alias("at"), F.col("n").cast("double").alias("n")), PIECES)
    order = usual_ids(counts)
    of = classes_from(counts, company_in(rows, order), order, vocabulary.value, begins)
    model = Attention(of, np.zeros((1, 1), np.float32), begins)
    pairs = np.zeros((CLASSES, PIECES))
    chosen = drawn(docs, SAMPLE)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoding(vocabulary.value)
        for batch in batches:
            rows = []
            for text in batch.text:
                ids = piece_ids(encoder, words_of(text))
                for spot in np.unique(np.linspace(0, max(0, len(ids) - WINDOW), PER_DOCUMENT).astype(int)):
                    x = np.append(ids[spot - 1] if spot else -1, ids[spot : spot + WINDOW])
                    rows.append(np.pad(x, (0, WINDOW + 1 - len(x)), constant_values=-2).astype(np.int32).tobytes())
            yield pd.DataFrame({"ids": rows})

    # At most SAMPLE * PER_DOCUMENT windows of WINDOW + 1 numbers; -1: start, -2: none.
    first = sorted(chosen.mapInPandas(work, "ids binary").toPandas().ids)
    ids = np.frombuffer(b"".join(first), np.int32).reshape(-1, WINDOW + 1).astype(np.int64)
    if len(ids):
        classes = np.where(ids == -1, START, of[np.maximum(ids, 0)])
        model.train(classes[:, :-1], np.minimum(classes[:, 1:], CLASSES - 1), (ids[:, 1:] >= 0).astype(np.float32))
        model.w, pairs = averaged(rows, model)
    model.inside = id_chances(np.vstack([pairs, counts * begins[:PIECES]]), ends, of)
    return model


def scored(rows: DataFrame, frequent: tuple[np.ndarray, np.ndarray, np.ndarray], model: Attention) -> DataFrame:
    """Per row of ids: tokens, sums over frequent words, model score, and the other words."""
    known, chances, among = frequent
    share, rest = math.log10(SHARE), math.log10(1 - SHARE)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            first = 0
            while first < len(texts):
                # Equal texts are scored once.
                last, size, own, distinct = first, 0, [], {}
                while last < len(texts) and size < 2 * BATCH_IDS:
                    text = texts[last].as_py()
                    if text not in distinct:
                        distinct[text] = len(distinct)
                        size += len(text)
                    own.append(distinct[text])
                    last += 1
                found = part(list(distinct)).take(pa.array(own))
                columns = [ids.slice(first, last - first), *found.columns]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *found.schema.names])
                first = last

    def part(texts: list[bytes]) -> pa.RecordBatch:
        n = len(texts)
        ids_ = np.frombuffer(b"".join(texts), np.uint16).astype(np.int64)
        ends = np.cumsum([len(x) // 2 for x in texts])
        # One id of each word holds the space before it; the end is a word too.
        at = np.flatnonzero(model.begins[ids_])
        last = np.searchsorted(at, ends) - 1
        lengths = np.diff(last, prepend=-1) - 1
        codes, keys = pd.factorize(np.delete(keys_of(ids_, at), last))
        # Searched in their order they are found faster.
        turn, spot = np.argsort(keys), np.empty(len(keys), np.int64)
        spot[turn] = np.minimum(np.searchsorted(known, keys[turn]), max(0, len(known) - 1))
        here = known[spot] == keys if len(known) else np.zeros(len(keys), bool)
        doc = np.repeat(np.arange(n), lengths)
        often = here[codes] if len(codes) else np.zeros(0, bool)
        worth = np.where(here, chances[spot] if len(known) else 0.0, 0.0)
        base = np.bincount(doc[often], weights=worth[codes[often]], minlength=n)
        seen = np.bincount(doc[often], minlength=n)
        pairs, times = np.unique(doc[~often] * max(1, len(keys)) + codes[~often], return_counts=True)
        of, word = pairs // max(1, len(keys)), keys[pairs % max(1, len(keys))] if len(keys) else pairs
        borders = np.append(0, np.cumsum(np.bincount(of, minlength=n))).astype(np.int32)
        chance, inside, begin = model.scores(ids_, ends)
        first = chance[at]
        chance[at] = 0
        # A spelled word goes on to where the next begins; nothing comes after the end.
        over = np.append(begin[at[1:]], 0.0)
        over[last] = 0
        of_word = np.add.reduceat(chance + inside, at) + over + rest
        usual = np.full(len(of_word), share)  # the end is alone in its class
        own = among[spot] if len(known) else np.zeros(len(keys))
        usual[np.delete(np.arange(len(of_word)), last)] = np.where(often, own[codes] + share, -np.inf)
        mixed = first + np.logaddexp2(usual * BITS, of_word * BITS) / BITS
        score = np.add.reduceat(mixed, last - lengths)
        rare = pa.ListArray.from_arrays(
            pa.array(borders),
            pa.StructArray.from_arrays([pa.array(word, pa.int64()), pa.array(times, pa.int32())], ["word", "times"]),
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(lengths + 1), pa.array(seen.astype(np.int64)), pa.array(base), pa.array(score.astype(float)), rare],
            ["n_tokens", "seen", "base", "score", "rare"],
        )

    shape = "doc_id long, n_tokens long, seen long, base double, score double, rare array<struct<word:long,times:int>>"
    return rows.select("doc_id", "ids").mapInArrow(work, shape)


def score(docs: DataFrame, held_out) -> DataFrame:
    """The columns of ``op10_lm_score`` for all rows of ``docs``."""
    spark = docs.sparkSession
    vocabulary = sent(spark)
    out = F.coalesce(held_out, F.lit(False))
    training = docs.filter(~out)
    read = stored(counted(docs, ~out, vocabulary))
    texts = read.filter(F.col("ids").isNotNull())
    # Words of one key, up to chance copies of one word.
    parts = read.filter(F.col("word").isNotNull()).groupBy("word")
    words = stored(parts.agg(F.sum("n").alias("n"), F.min("id").alias("id")))
    sums = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")).first()
    ends = texts.filter("training").count()
    total, distinct = (sums.n or 0) + ends, sums.distinct + (ends > 0)
    scale = total + 0.5 * (distinct + 1)
    # A word with 1 / FREQUENT of the tokens: FREQUENT of them at most.
    end = math.log10((ends + 0.5) / scale)
    model = fit(training, read, ends, vocabulary)
    often = words.filter(F.col("n") * FREQUENT >= total).orderBy("word").toPandas()
    times = often["n"].to_numpy(float) + 0.5
    class_ = model.of[often["id"].to_numpy(np.int64)]
    # A frequent word among those that begin with its class.
    among = np.log10(times / np.bincount(class_, weights=times, minlength=CLASSES)[class_])
    frequent = (often["word"].to_numpy(np.int64), np.log10(times / scale), among)
    rows = stored(scored(texts, frequent, model).withColumn("row", F.monotonically_increasing_id()))
    exploded = rows.select("row", F.explode("rare").alias("rare")).select("row", "rare.word", "rare.times")
    seldom = words.filter(F.col("n") * FREQUENT < total).select("word", "n")
    count = F.coalesce(F.col("n"), F.lit(0))
    met = exploded.join(seldom, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((count + 0.5) / F.lit(scale))).alias("rare_base"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_seen"),
    )
    whole = rows.select("row", "doc_id", "n_tokens", "seen", "base", "score").join(met, "row", "left")
    held = F.coalesce(crc_of_id() % 5 == 1, F.lit(False))
    return whole.select(
        "doc_id",
        held.alias("held_out"),
        "n_tokens",
        (F.col("seen") + F.coalesce("rare_seen", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + F.lit(end)).alias("base_score"),
        "score",
    )


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, crc_of_id() % 5 == 1)
