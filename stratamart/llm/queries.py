"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratamart.llm import (
    decontam,
    hard_negatives,
    html_text,
    lm_score,
    merkle,
    mixing,
    near_dedup,
    packing,
    pii,
    pivot_search,
    quality,
    sharding,
    token_rollup,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_html_text": html_text.op1_html_text,
        "op2_pivot_search": pivot_search.op2_pivot_search,
        "op3_quality": quality.op3_quality,
        "op4_pii": pii.op4_pii,
        "op5_near_dedup": near_dedup.op5_near_dedup,
        "op6_mixing": mixing.op6_mixing,
        "op7_decontam": decontam.op7_decontam,
        "op8_sharding": sharding.op8_sharding,
        "op9_token_rollup": token_rollup.op9_token_rollup,
        "token_totals": token_rollup.token_totals,
        "op10_lm_score": lm_score.op10_lm_score,
        "op11_packing": packing.op11_packing,
        "op12_hard_negatives": hard_negatives.op12_hard_negatives,
        "op13_merkle": merkle.op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    """The others are held against brute force in ``tests/llm``."""
    return {
        "op2_pivot_search": pivot_search.OP2_SQL,
        "op6_mixing": mixing.OP6_SQL,
        "op8_sharding": sharding.OP8_SQL,
        "op12_hard_negatives": hard_negatives.OP12_SQL,
        "op13_merkle": merkle.OP13_SQL,
    }
