"""Hard negatives: against brute force, the bounds on their own, odd rows."""

import itertools
import math
from types import SimpleNamespace

import numpy as np
import pytest

from stratamart.llm import hard_negatives as hn

SHAPE = "vec_id long, embedding array<float>, label int, x string, rid long, anchor long, score long"


def plain(rows):
    """The result by definition, each row with each."""
    usable = [
        (v, (lab + 1) % 10 if v is not None and v % 7 == 0 else lab, [math.floor(256 * float(np.float32(c))) for c in e])
        for v, e, lab, *_ in rows
        if lab is not None and e is not None and all(c is not None and math.isfinite(c) for c in e)
    ]

    def score(a, b):
        return sum(x * y for x, y in itertools.zip_longest(a, b, fillvalue=0))

    def order(pair):
        return (-pair[0], pair[1] is None, pair[1] or 0)

    out = []
    for i, (v, label, x) in enumerate(usable):
        if v is None or v % 100:
            continue
        others = [(score(x, y), w, lab) for j, (w, lab, y) in enumerate(usable) if j != i]
        same = sorted([(s, w) for s, w, lab in others if lab == label], key=order)[:5]
        for s, w in same:
            fit = [(t, u) for t, u, lab in others if lab != label and 30 * s <= 100 * t <= 90 * s]
            for rank, (t, u) in enumerate(sorted(fit, key=order)[:10], 1):
                out.append((v, w, rank, u, s, t))
    return sorted(out, key=str)


def found(spark, tmp_path, rows):
    spark.createDataFrame(rows, SHAPE).write.parquet(str(tmp_path / "embeddings.parquet"))
    df = hn.op12_hard_negatives(spark, str(tmp_path))
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def drawn(n, seed, dims=8, ids=None):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(5, dims))
    x = middle[draw.integers(0, 5, n)] + 0.3 * draw.normal(size=(n, dims))
    ids = range(n) if ids is None else ids
    return [(int(i), [float(c) for c in v], int(draw.integers(0, 4)), None, None, None, None) for i, v in zip(ids, x)]


REST = (None, None, None, None)
ODD = [
    (None, [0.5, 0.5], 1, *REST),
    (None, [0.4, 0.5], 2, *REST),
    (0, None, 1, *REST),
    (100, [1.0, None], 1, *REST),
    (200, [1.0, float("nan")], 1, *REST),
    (300, [1.0, 1.0], None, *REST),
    (400, [1.0, 1.0], 1, *REST),
    (400, [1.0, 1.0], 1, *REST),
    (500, [], 1, *REST),
    (1, [0.5], 2, *REST),
    (2, [0.5, 0.5, 0.0], 2, *REST),
    (3, [0.5, 0.5], 2, *REST),
    (3, [0.5, 0.5], 2, *REST),
    (5, [1.0, 1.0], 1, *REST),
]


@pytest.mark.parametrize("rows", [[], ODD[2:4], ODD, ODD[-2:], [*ODD * 2, *drawn(60, 3, 2)]])
def test_odd_rows(spark, tmp_path, rows):
    assert found(spark, tmp_path, rows) == plain(rows)


def test_many_packs_blocks_and_copies(spark, tmp_path, monkeypatch):
    """A third of all rows share one id, every fourth row is an anchor, small packs and blocks."""
    monkeypatch.setattr(hn, "PACK_BYTES", 8 * 8 * 25)
    monkeypatch.setattr(hn, "BLOCK", 6)
    monkeypatch.setattr(hn, "PIVOTS", 3)
    ids = [i * 25 for i in range(200)] + [77] * 100
    rows = drawn(300, 5, ids=ids)
    rows = [*rows[:200], *[(77, rows[200][1], i % 3, *REST) for i in range(100)]]
    assert found(spark, tmp_path, rows) == plain(rows)


@pytest.mark.parametrize("scale", [1, 40, 10**5])
def test_bounds_lose_no_row_and_spare_some(scale):
    draw = np.random.default_rng(scale)
    x = np.rint((draw.normal(size=(6, 16))[draw.integers(0, 6, 500)] + 0.05 * draw.normal(size=(500, 16))) * 256)
    x = (x * scale).astype(np.int64)
    a, labels = x[:60], draw.integers(0, 3, 500).astype(np.int32)
    order, parent, edge = hn.spanning_tree(a)
    assert sorted(order) == list(range(60)) and (parent >= 0).sum() == 59
    for i, p in enumerate(parent):
        assert p < 0 or math.isclose(edge[i], math.dist(a[i], a[p]), rel_tol=1e-9)
    pack = hn.Pack(
        SimpleNamespace(
            ids=np.arange(500).tobytes(),
            unnamed=np.zeros(500, bool).tobytes(),
            pack_labels=labels.tobytes(),
            pack_rids=np.arange(500).tobytes(),
            xs=x.tobytes(),
        ),
        16,
    )
    block = hn.Block(
        SimpleNamespace(
            rids=np.arange(60).tobytes(),
            labels=labels[:60].tobytes(),
            vectors=a.tobytes(),
            tree=np.stack([order, parent]).astype(np.int64).tobytes(),
            edges=edge.tobytes(),
        ),
        16,
    )
    exact = a @ x.T
    top = exact.max(1)
    wanted = [[(1, int(t * 0.85), int(t * 0.9)), (2, 5, 4)] for t in top]
    scored = 0
    for i, rows, scores, n in hn.candidates(pack, block, wanted):
        scored += n
        assert (exact[i, rows] == scores).all()
        inside = (labels != labels[i]) & (exact[i] >= wanted[i][0][1]) & (exact[i] <= wanted[i][0][2])
        assert set(np.flatnonzero(inside)) <= set(rows)
    assert scored < 0.5 * 60 * 500
