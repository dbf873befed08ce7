"""Bundles of rings: what is sent, exact scores of any size, ties and repeated ids."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import pivot_search


def is_query():
    return F.col("vec_id") % 10 == 0


@pytest.fixture()
def small_parts(monkeypatch):
    for name, value in {"BUNDLE_ROWS": 16, "CHUNK_ROWS": 8, "QUERY_BLOCK": 4}.items():
        monkeypatch.setattr(pivot_search, name, value)


def vectors(rows, scale, dims=5, seed=3):
    made = random.Random(seed)
    return [(i, [float(np.float32(made.gauss(0, scale))) for _ in range(dims)]) for i in range(rows)]


def searched(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = pivot_search.top_k(df, is_query(), pivots=4, **options).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)


def brute(rows, top=10):
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    pairs = {}
    for q, x in whole:
        if q % 10 == 0:
            pairs.setdefault(q, []).extend((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in whole if i != q)
    return sorted((q, k + 1, i, -s) for q, found in pairs.items() for k, (s, i) in enumerate(sorted(found)[:top]))


def test_queries_are_not_broadcast(spark):
    """Queries sent to all that they want are many times what the plan estimates of them."""
    numbers = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda k: F.sin(F.col("id") * 64 + k * k))
    df = spark.range(4000).select(F.col("id").alias("vec_id"), numbers.alias("embedding"))
    limit = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(4 << 20))
    try:
        assert pivot_search.top_k(df, is_query()).count() == 4000
    finally:
        spark.conf.set(limit, before)


@pytest.mark.parametrize("scale", [1, 50, 1e4, 1e5])
def test_scores_of_any_size(spark, small_parts, scale):
    rows = vectors(150, scale)
    assert searched(spark, rows) == brute(rows)


def test_kinds_hold_every_sum_of_products():
    kinds = [pivot_search.kind_of(n) for n in (0, 2**24 - 1, 2**24, 2**53 - 2**30, 2**53, 1e18)]
    assert kinds == [np.float32] * 2 + [np.float64] * 2 + [np.int64] * 2


def test_one_long_vector_among_short_ones(spark, small_parts):
    rows = vectors(120, 1) + [(1000, [3e5] * 5), (1001, [-3e5] * 5)]
    assert searched(spark, rows) == brute(rows)


@pytest.mark.parametrize("copies", ["vectors", "ids", "both"])
def test_a_third_of_all_rows_alike(spark, small_parts, copies):
    rows = vectors(90, 1)
    for k in range(0, 90, 3):
        rows[k] = (0 if copies != "vectors" else rows[k][0], rows[0][1] if copies != "ids" else rows[k][1])
    assert searched(spark, rows) == brute(rows)


def test_fewer_rows_than_wanted(spark, small_parts):
    rows = vectors(6, 1) + [(0, [0.0] * 5)]
    assert searched(spark, rows) == brute(rows)
    assert searched(spark, [(0, []), (1, [])]) == [(0, 1, 1, 0)]
    assert searched(spark, vectors(40, 1), top=3) == brute(vectors(40, 1), 3)


def test_rows_of_one_id_are_dealt_over_bundles(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "BUNDLE_ROWS", 16)
    seen, search = [], pivot_search.search

    def remember(rows, *more):
        seen.append([r["count"] for r in rows.groupBy("bundle").count().collect()])
        return search(rows, *more)

    monkeypatch.setattr(pivot_search, "search", remember)
    assert len(searched(spark, [(20, [1.0, 2.0])] * 2000 + vectors(1000, 1, 2))) == 1000
    assert all(sum(s) == 3000 and max(s) < 3 * 3000 / 64 for s in seen) and len(seen) == 2


def test_rows_that_reach_the_bar():
    q, x = np.ones((2, 1), np.float32), np.array([[5], [7], [7], [7], [9]] * 9, np.float32)
    ids = np.arange(45)
    bar = np.array([pivot_search.LEAST, 9])
    i, found, s = pivot_search.reaching(q, np.array([4, 100]), bar, x, ids, 2)
    assert set(ids[4::5]) - {4} >= set(found[i == 0]) >= {9, 14} and set(s[i == 0]) == {9}
    assert list(found[i == 1])[:2] == [4, 9] and set(s[i == 1]) == {9}
