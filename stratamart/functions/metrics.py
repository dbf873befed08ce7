"""Business metric formulas, one expression each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import MONEY, RATE, ratio

# Fixed values of the metric definitions.
Z_SCORE = 1.96
Z_SQUARED = 3.8416
GOOD_FROM_SCORE = 4
MID_SCORE = 3
RISK_MIN_RATINGS = 20
RISK_BAD_PERCENT = 30
RANK_TYPES = ("gmv", "paid_sku_num", "paid_order_count")
TOP_N = 10


def average_order_amount(gmv: Column, orders: Column) -> Column:
    return ratio(gmv, orders, MONEY)


def view_to_pay_rate(payers: Column, viewers: Column) -> Column:
    return ratio(payers, viewers, RATE)


def average_score(score_sum: Column, ratings: Column) -> Column:
    return ratio(score_sum, ratings, RATE)


def share(part: Column, whole: Column) -> Column:
    return ratio(part, whole, RATE)


def score_level(score: Column) -> Column:
    return (
        F.when(score >= GOOD_FROM_SCORE, "good")
        .when(score == MID_SCORE, "mid")
        .otherwise("bad")
    )


def wilson_lower_bound(good: Column, ratings: Column) -> Column:
    """Lower end of the Wilson 95 % interval of good/ratings.

    Worked out in double: a decimal product would be cut to six digits before
    the square root and can come out negative for shops with no good rating.
    """
    n = ratings.cast("double")
    p = good.cast("double") / n
    centre = p + Z_SQUARED / (n * 2)
    spread = F.sqrt((p * (1 - p) + Z_SQUARED / (n * 4)) / n) * Z_SCORE
    bound = (centre - spread) / (1 + Z_SQUARED / n)
    return F.greatest(bound, F.lit(0.0)).cast(RATE)


def risk_flag(bad: Column, ratings: Column) -> Column:
    """Enough ratings and a bad share of at least 30 %, compared exactly in integers."""
    return (ratings >= RISK_MIN_RATINGS) & (bad * 100 >= ratings * RISK_BAD_PERCENT)
