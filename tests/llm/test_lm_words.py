"""Words of many texts encoded once give the ids of each text encoded alone."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stratamart.llm import lm_score
from stratamart.llm.subwords import PIECES, encoding, ranks

TEXTS = ["", " ", "a b a", "it's a «quoted» word, it's", "x  y  z  ", "日本 語 123 4567 !!! ... a", "b" * 300 + " c", " "]


def test_spelled_equals_piece_ids():
    table = ranks()
    encoder, begins = encoding(table), np.zeros(PIECES + 1, bool)
    for piece, rank in table.items():
        begins[rank] = b" " in piece
    begins[PIECES] = True
    lists = [lm_score.words_of(t) for t in TEXTS]
    unique = list(dict.fromkeys(w for x in lists for w in x))
    codes = np.array([unique.index(w) for x in lists for w in x], np.int64)
    ids, ends = lm_score.spelled(encoder, begins, unique, codes, np.array([len(x) for x in lists]))
    alone = [lm_score.piece_ids(encoder, x) for x in lists]
    assert ids.tolist() == np.concatenate(alone).tolist()
    assert ends.tolist() == np.cumsum([len(x) for x in alone]).tolist()
    none = np.array([], np.int64)
    assert lm_score.spelled(encoder, begins, [], none, np.array([0, 0]))[1].tolist() == [1, 2]


def test_equal_texts_have_equal_scores(spark):
    docs = spark.createDataFrame([(i, TEXTS[i % len(TEXTS)]) for i in range(64)], "doc_id long, text string")
    rows = lm_score.score(docs, F.lit(False)).collect()
    assert len(rows) == 64
    for i in range(len(TEXTS)):
        assert len({(r.score, round(r.base_score, 9), r.n_tokens) for r in rows if r.doc_id % len(TEXTS) == i}) == 1


def test_rows_that_are_not_drawn_move_classes_and_weights(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "SAMPLE", 1)
    monkeypatch.setattr(lm_score, "STEPS", 2)
    vocabulary = lm_score.sent(spark)

    texts = {1: "a house by the sea and a boat in the sea " * 20, 2: "der hund und die katze und der vogel " * 60}
    both = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    chosen = lm_score.drawn(both, 1).first().text

    def fitted(docs):
        return lm_score.fit(docs, lm_score.stored(lm_score.counted(docs)), docs.count(), vocabulary)

    alone, both = fitted(both.filter(F.col("text") == chosen)), fitted(both)
    assert (alone.of != both.of).any()
    assert any(np.abs(alone.w[n] - both.w[n]).max() > 1e-4 for n in alone.w)


def test_windows_hold_each_id_once():
    rows = [np.arange(n, dtype=np.uint16) for n in (1, 32, 33, 200)]
    windows = np.concatenate(list(lm_score.windows_of(pa.array([r.tobytes() for r in rows], pa.binary()))))
    assert windows[:, 1:][windows[:, 1:] >= 0].tolist() == np.concatenate(rows).tolist()
    assert (windows[:, 0] == -1).sum() == len(rows)
    order = np.arange(lm_score.PIECES)
    company = np.zeros((lm_score.PIECES, lm_score.ALONE))
    for window in windows[:, 1:]:
        ids = window[window >= 0]
        for i in ids:
            for j in ids[ids < lm_score.ALONE]:
                company[i, j] += 1
    assert (lm_score.company_of(windows[:, 1:], order) == company).all()


def test_company_counts_the_frequent_ids_of_each_window():
    rng = np.random.default_rng(3)
    windows = rng.integers(-2, 300, (50, 9))
    windows[rng.random(windows.shape) < 0.05] = lm_score.END
    counts = np.bincount(windows[(windows >= 0) & (windows < lm_score.END)], minlength=lm_score.PIECES)
    order = lm_score.usual_ids(counts)
    expected = np.zeros((lm_score.PIECES, lm_score.ALONE))
    usual = {int(x): i for i, x in enumerate(order[: lm_score.ALONE])}
    for window in windows.tolist():
        real = [x for x in window if 0 <= x < lm_score.END]
        for x in real:
            for other in real:
                if other in usual:
                    expected[x, usual[other]] += 1
    assert (lm_score.company_of(windows, order) == expected).all()
    assert not lm_score.company_of(windows[:0], order).any()
