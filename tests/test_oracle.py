"""Every named query against its SQL, on the smallest data set and a second cutoff."""

import duckdb
import pytest

import __spark_entry__ as entry
import check
from conftest import SMALL
from stratamart import oracles
from stratamart.queries import BUILDERS, Layers

# Empty on this data set only because it is too small for their seeds.
MAY_BE_EMPTY = {"anti_behavior_sku"}


def test_every_query_has_sql():
    assert set(BUILDERS) == set(oracles.oracle_sql())
    assert set(BUILDERS) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_query_equals_its_sql(spark, name):
    good, note = check.compare(spark, SMALL, name)
    assert good, note
    assert "types" not in note
    if name not in MAY_BE_EMPTY:
        assert not note.startswith("0 rows"), "compares two empty results"


def _at(sql: str) -> str:
    """The same statements for the cutoff 20240120, when later facts exist."""
    return (
        sql.replace("20240130", "20240120").replace("2024-01-30", "2024-01-20")
        .replace("2024-01-24", "2024-01-14").replace("2024-01-01'), ('all", "2023-12-22'), ('all")
    )


@pytest.mark.parametrize("name", ["dwd_trade", "dwd_behavior", "dwd_rating", "dws_site",
                                  "dws_sku", "ads_overview", "ads_sku_topn", "ads_shop_rating"])
def test_earlier_cutoff_ignores_later_facts(spark, name):
    df = BUILDERS[name](Layers(spark, SMALL, "20240120"))
    mine = check._bag(df.columns, df.collect())
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    result = con.execute(_at(oracles.oracle_sql()[name]))
    columns = [c[0] for c in result.description]
    assert mine == check._bag(columns, result.fetchall())
    assert mine
