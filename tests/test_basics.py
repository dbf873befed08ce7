import datetime as dt
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from stratamart.bizdate import day_bounds, day_slices, parse_ds
from stratamart.functions import metrics, temporal
from stratamart.functions.money import RATE, money, ratio


@pytest.mark.parametrize("bad", ["2026-08-25", "2026082", "202608255", "20260230", "abcdefgh",
                                 " 0260825", "２０２６０８２５", None, 20260825])
def test_bad_ds(bad):
    with pytest.raises(ValueError):
        parse_ds(bad)


def test_day_bounds_cover_the_day_without_overlap():
    start, end = day_bounds("20240228")
    assert (start, end) == (dt.datetime(2024, 2, 28), dt.datetime(2024, 2, 29))
    slices = day_slices("20240228", 7)
    assert slices[0][0] == start and slices[-1][1] == end
    assert all(a[1] == b[0] for a, b in zip(slices, slices[1:]))


def test_wilson_matches_exact_arithmetic(spark):
    """All (n, good) with n <= 120 against high-precision decimals."""
    getcontext().prec = 50
    pairs = [(n, g) for n in range(1, 121) for g in range(n + 1)]
    df = spark.createDataFrame(pairs, "n bigint, g bigint")
    rows = df.select("n", "g", metrics.wilson_lower_bound(F.col("g"), F.col("n")).alias("w"))
    z, z2 = Decimal("1.96"), Decimal("3.8416")
    for n, g, w in rows.collect():
        p = Decimal(g) / n
        exact = (p + z2 / (2 * n) - z * ((p * (1 - p) + z2 / (4 * n)) / n).sqrt()) / (1 + z2 / n)
        assert w >= 0
        assert abs(w - max(exact, Decimal(0))) <= Decimal("0.0000005000001"), (n, g)


def test_risk_flag_edges(spark):
    cases = [(20, 6, True), (20, 5, False), (19, 19, False), (100, 30, True), (100, 29, False),
             (1_000_000_007, 300_000_002, False), (1_000_000_007, 300_000_003, True)]
    df = spark.createDataFrame([c[:2] for c in cases], "n bigint, bad bigint")
    got = df.select("n", "bad", metrics.risk_flag(F.col("bad"), F.col("n")).alias("f")).collect()
    assert [tuple(r) for r in got] == cases


def test_ratio_guards_zero_and_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 0), (1, 3), (2, 3), (1, 8)], "a bigint, b bigint")
    got = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"), RATE)).collect()]
    assert got == [Decimal("0"), Decimal("0.333333"), Decimal("0.666667"), Decimal("0.125000")]
    cents = spark.createDataFrame([("0.125",), ("0.135",), ("-0.125",)], "v string")
    got = [str(r[0]) for r in cents.select(money(F.col("v").cast("decimal(10,3)"))).collect()]
    assert got == ["0.13", "0.14", "-0.13"]


def test_score_levels(spark):
    df = spark.range(1, 6).select(metrics.score_level(F.col("id")))
    assert [r[0] for r in df.collect()] == ["bad", "bad", "mid", "good", "good"]


def test_contract_time_cuts_below_millis(spark):
    t = dt.datetime(2026, 8, 25, 9, 15, 20, 123999)
    df = spark.createDataFrame([(t,)], "t timestamp_ntz")
    row = df.select(temporal.contract_time(F.col("t")), temporal.has_sub_millis(F.col("t")),
                    temporal.ds_of(F.col("t"))).first()
    assert tuple(row) == ("2026-08-25 09:15:20.123", True, "20260825")
