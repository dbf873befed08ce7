"""Steps of the language model: texts read once, gradients, counts in blocks."""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stratamart.llm import lm_score
from stratamart.llm.subwords import PIECES, encoding, ranks

TEXTS = ["", None, " ", "a b A", "it's a «quoted» word, it's", "x  y  z  ", "日本 語 123 ... a　b c", "b" * 300 + " C", "\x0bq\x1cw\x85e\t\n\r r"]


def test_one_reading_gives_ids_words_and_counts(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 2)], "doc_id long, text string").repartition(3)
    rows = lm_score.counted(docs, F.col("doc_id") < len(TEXTS)).collect()
    encoder = encoding(ranks())
    texts = {r.doc_id: np.frombuffer(r.ids, np.uint16).tolist() for r in rows if r.ids is not None}
    assert texts == {i: lm_score.piece_ids(encoder, lm_score.words_of(t)).tolist() for i, t in enumerate(TEXTS * 2)}
    assert {r.doc_id for r in rows if r.training} == set(range(len(TEXTS)))
    words, ids = Counter(), Counter()
    for r in rows:
        if r.word is not None:
            words[r.word, r.id] += r.n
        elif r.id is not None:
            ids[r.id] += r.n
    expected = Counter(w for t in TEXTS for w in lm_score.words_of(t))
    assert sorted(words.values()) == sorted(expected.values())
    first = Counter()
    for w, n in expected.items():
        first[int(lm_score.piece_ids(encoder, [w])[0])] += n
    assert first == sum((Counter({i: n}) for (_, i), n in words.items()), Counter())
    assert ids == Counter(int(i) for t in TEXTS for i in lm_score.piece_ids(encoder, lm_score.words_of(t))[:-1])


def test_words_of_a_second_batch_keep_their_numbers():
    encoder, begins = encoding(ranks()), lm_score.begin_flags(ranks())
    book = lm_score.Book(encoder, begins)
    for texts in (["c b a", "b"], ["a d b", ""], ["a"]):
        ids, size = book.read(pa.array(texts), np.ones(len(texts), bool))
        alone = [lm_score.piece_ids(encoder, lm_score.words_of(t)) for t in texts]
        assert ids.tolist() == np.concatenate(alone).tolist() and size.tolist() == [len(x) for x in alone]
    assert sorted(book.counts()[1]) == [1, 1, 3, 3]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(4)
    of = np.append(rng.integers(0, lm_score.CLASSES - 1, PIECES), lm_score.CLASSES - 1)
    model = lm_score.Attention(of, np.zeros((1, 1), np.float32), np.append(of[:-1] % 2 == 0, True))
    for length in (32, 20):
        x, y = rng.integers(0, lm_score.CLASSES + 1, (9, length)), rng.integers(0, lm_score.CLASSES, (9, length))
        real = (rng.random(x.shape) < 0.8).astype(np.float32)

        def loss():
            z = model.forward(x, 0)[0].astype(float)
            z -= np.log(np.exp(z).sum(2, keepdims=True))
            return -(np.take_along_axis(z, y[:, :, None], 2)[:, :, 0] * real).sum() / real.sum()

        grads = model.gradients(x, y, real)
        for name, w in model.w.items():
            # Along the gradient the loss changes as its length says.
            way, step = grads[name] / np.linalg.norm(grads[name]), 0.01
            start, w[...] = w.copy(), w + step * way
            above, w[...] = loss(), start - step * way
            below, w[...] = loss(), start
            assert np.isclose((above - below) / (2 * step), np.linalg.norm(grads[name]), rtol=0.02), name


def test_company_of_a_full_chunk_does_not_run_over():
    order = np.arange(PIECES)
    windows = np.full((2 * lm_score.WINDOWS_HELD + 5, lm_score.WINDOW), 7000)
    windows[:, ::2] = 38
    out = lm_score.company_of(windows, order)
    half = lm_score.WINDOW // 2
    assert out[7000, 38] == out[38, 38] == len(windows) * half * half and out.sum() == 2 * out[38, 38]
    assert (lm_score.company_of(windows, order, out.copy()) == 2 * out).all()


def test_pairs_of_ids_are_counted_in_blocks(spark, monkeypatch):
    table = ranks()
    encoder, begins = encoding(table), lm_score.begin_flags(table)
    of = np.append(np.arange(PIECES) % (lm_score.CLASSES - 1), lm_score.CLASSES - 1)
    texts = ["antidisestablishment xylophonists " * n for n in (1, 30, 300)]
    ids = [lm_score.piece_ids(encoder, lm_score.words_of(t)) for t in texts]
    rows = spark.createDataFrame([(bytearray(x.astype(np.uint16).tobytes()),) for x in ids], "ids binary").coalesce(1)
    expected = np.zeros((lm_score.CLASSES, PIECES))
    for x in ids:
        for before, i in zip(x[:-1], x[1:]):
            if not begins[i]:
                expected[of[before], i] += 1
    for held in (0, 10**6):
        monkeypatch.setattr(lm_score, "PAIRS_HELD", held)
        model = lm_score.Attention(of, np.zeros((1, 1), np.float32), begins)
        assert (lm_score.averaged(rows, model)[1] == expected).all()
