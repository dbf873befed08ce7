import pytest

from stratamart.errors import DataQualityError
from stratamart.operators.quality import Contract, broken_rows, profile, require
from stratamart.plans import contracts

RULES = Contract("t", key=("k",), required=("k", "v"), forbidden={"negative": "v < 0"})


def make(spark, rows):
    return spark.createDataFrame(rows, "k int, v int")


def test_clean_data_passes_and_returns_the_count(spark):
    assert require(make(spark, [(1, 0), (2, 5)]), RULES) == 2


def test_every_broken_rule_is_named(spark):
    df = make(spark, [(1, 0), (1, -1), (2, None), (3, -4)])
    row = profile(df, RULES).first().asDict()
    assert row == {"row_count": 4, "repeated_keys": 1, "required_is_null": 1, "negative": 2}
    with pytest.raises(DataQualityError, match="repeated_keys=1, required_is_null=1, negative=2"):
        require(df, RULES)


def test_broken_rows_lists_each_rule(spark):
    df = make(spark, [(1, 0), (2, -1), (None, -2)])
    got = {tuple(r) for r in broken_rows(df, RULES).collect()}
    assert got == {("negative", 2), ("required_is_null", None), ("negative", None)}


def test_row_count_rules(spark):
    empty = make(spark, [])
    assert require(empty, RULES) == 0
    with pytest.raises(DataQualityError, match="no rows"):
        require(empty, Contract("t", ("k",), not_empty=True))
    with pytest.raises(DataQualityError, match="row_count=1, expected 4"):
        require(make(spark, [(1, 1)]), Contract("t", ("k",), rows=4))


def test_column_order_is_part_of_the_contract(spark):
    with pytest.raises(DataQualityError, match="column order"):
        require(make(spark, [(1, 1)]), Contract("t", ("k",), columns=("v", "k")))


def test_rating_counts_must_add_up(spark):
    df = spark.createDataFrame(
        [("1d", 1, "s", 3, 9, 1, 1, 1), ("1d", 2, "s", 3, 9, 1, 1, 0)],
        "stat_period string, shop_id bigint, shop_name string, rating_count bigint, "
        "score_sum bigint, good_count bigint, mid_count bigint, bad_count bigint")
    got = broken_rows(df, contracts.SHOP_RATING).collect()
    assert [tuple(r) for r in got] == [("counts_differ", "1d", 2)]


@pytest.mark.parametrize("table", sorted(contracts.SOURCE))
def test_source_contracts_are_valid_sql(spark, table):
    schemas = {
        "shop_info": "shop_id bigint, status tinyint",
        "sku_info": "sku_id bigint, price decimal(10,2), status tinyint, "
        "create_time timestamp, update_time timestamp",
        "order_info": "order_id bigint, order_status string, order_amount decimal(20,2), "
        "create_time timestamp, update_time timestamp",
        "order_detail": "order_detail_id bigint, sku_num int, original_amount decimal(20,2), "
        "final_amount decimal(20,2)",
        "payment_info": "payment_id bigint, payment_type string, payment_status string, "
        "payment_amount decimal(20,2), payment_time timestamp, create_time timestamp",
        "user_behavior": "event_id bigint, event_type string",
        "rating_info": "rating_id bigint, shop_score tinyint",
    }
    df = spark.createDataFrame([], schemas[table])
    assert profile(df, contracts.SOURCE[table]).first().row_count == 0
