"""Fingerprints: independent of order, sensitive to every change, held against the source."""

import datetime as dt
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import facts as f
from stratamart import jobs
from stratamart.errors import DataQualityError
from stratamart.operators.fingerprint import SUMS, differences, fingerprint, in_database, row_text
from stratamart.plans.ods import INGESTS
from stratamart.schemas import TABLES
from stratamart.sources import jdbc, tables

SHAPES = {"order_info": f.ORDER, "order_detail": f.DETAIL, "payment_info": f.PAYMENT,
          "user_behavior": f.BEHAVIOR, "rating_info": f.RATING}


def printed(df):
    schema = TABLES["ods.ods_rating_info_di"].schema
    return tuple(fingerprint(df, schema).select(*SUMS).first())


def test_the_sums_tell_rows_not_their_order(spark):
    rows = [f.rating(i, score=i % 5 + 1, time=f.NOON + dt.timedelta(microseconds=i)) for i in range(200)]

    def of(rows):
        return printed(spark.createDataFrame(rows, f.RATING))

    whole = of(rows)
    assert whole[0] == 200 and of(rows[::-1]) == whole
    assert printed(spark.createDataFrame(rows, f.RATING).repartition(7)) == whole
    changed = [f.rating(3, score=5, time=rows[3][4]), *rows[:3], *rows[4:]]
    swapped = [(*rows[0][:3], rows[1][3], rows[0][4], f.DS), (*rows[1][:3], rows[0][3], rows[1][4], f.DS), *rows[2:]]
    for other in (rows[1:], [*rows, rows[0]], [rows[1], rows[1], *rows[2:]], changed, swapped):
        assert of(other) != whole
    assert of([]) == (0, 0, 0)


def test_texts_of_rows_do_not_run_together(spark):
    schema = spark.createDataFrame([], "a string, b string").schema
    rows = [("1", "2:x"), ("1:2", "x"), (None, "-"), ("-", None), ("", ""), (None, None), ("é", "日本")]
    texts = [r.t for r in spark.createDataFrame(rows, schema).select(row_text(schema).alias("t")).collect()]
    assert len(set(texts)) == len(rows) and texts[4:6] == ["0:0:", "--"] and texts[-1] == "1:é2:日本"


def test_the_database_query_groups_at_the_source(spark):
    (order,) = [i for i in INGESTS if i.source == "order_info"]
    text = jdbc.fingerprint_query(order, f.DS)
    assert "from order_info where create_time >= '2026-08-25 00:00:00.000000'" in text
    assert text.startswith("(select hour(create_time) as hour, count(*) as row_count") and text.endswith("group by 1) f")
    for column in order.columns:
        assert column in text
    # The same text in another engine, its functions named as there, gives the same sums.
    rows = [f.order(i, amount=i, created=f.NOON + dt.timedelta(minutes=i)) for i in range(150)]
    con = duckdb.connect()
    df = spark.createDataFrame(rows, f.ORDER)
    con.register("order_info_frame", df.toPandas())
    con.execute("create table order_info as select * replace (cast(order_amount as decimal(20,2)) as order_amount) from order_info_frame")
    con.execute("create macro date_format(t, p) as strftime(t, '%Y-%m-%d %H:%M:%S.%f')")
    con.execute("create macro char_length(t) as length(t)")
    con.execute("create macro conv(h, a, b) as cast('0x' || h as bigint)")
    query = in_database(TABLES[order.target].schema, "order_info", "true", {"hour": "hour(create_time)"})
    theirs = {r[0]: tuple(map(int, r[1:])) for r in con.execute(f"select * from {query}").fetchall()}
    mine = fingerprint(df, TABLES[order.target].schema, [F.hour("create_time").alias("hour")])
    assert {r.hour: (r.row_count, int(r.hash_a), int(r.hash_b)) for r in mine.collect()} == theirs
    assert len(theirs) == 3


def test_a_slice_on_one_side_only_differs(spark):
    schema = "hour int, row_count bigint, hash_a decimal(38,0), hash_b decimal(38,0)"
    a = spark.createDataFrame([(1, 2, f.money(3), f.money(4)), (2, 1, f.money(1), f.money(1))], schema)
    b = spark.createDataFrame([(1, 2, f.money(3), f.money(4)), (5, 1, f.money(1), f.money(1))], schema)
    assert {r.hour: r.is_equal for r in differences(a, b, ["hour"]).collect()} == {1: True, 2: False, 5: False}


class Source:
    """Reads altered rows of one fact, but knows what the rows should be."""

    def __init__(self, spark, alter=None):
        self.rows = {
            "order_info": [f.order(i, created=f.NOON + dt.timedelta(hours=i)) for i in range(1, 6)],
            "order_detail": [f.detail(i) for i in range(1, 4)],
            "payment_info": [f.payment(1)],
            "user_behavior": [f.event(1)],
            "rating_info": [f.rating(1)],
        }
        self.spark, self.alter = spark, alter or (lambda rows: rows)

    def __call__(self, name):
        rows = self.alter(self.rows[name]) if name == "order_info" else self.rows[name]
        return self.spark.createDataFrame(rows, SHAPES[name])

    def fingerprint(self, name):
        ingest = jdbc.BY_SOURCE[name]
        rows = self.spark.createDataFrame(self.rows[name], SHAPES[name])
        return fingerprint(rows, TABLES[ingest.target].schema, [F.hour(ingest.time_column).alias("hour")])


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    tables.create_all(spark, str(tmp_path_factory.mktemp("prints")))
    yield
    for table in tables.TABLES:
        spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize(
    ("alter", "message"),
    [
        (lambda rows: rows[1:], "order_info hour 13: 1 rows at the source, 0 here"),
        (lambda rows: [*rows, rows[2]], "order_info hour 15: 1 rows at the source, 2 here"),
        (lambda rows: [(*rows[0][:4], f.money(11), *rows[0][5:]), *rows[1:]], "order_info hour 13: 1 rows at the source, 1 here"),
    ],
)
def test_a_reader_that_loses_doubles_or_changes_a_row_is_refused(spark, warehouse, alter, message):
    jobs.load_day(spark, Source(spark), f.DS)
    before = {i.target: tables.current_path(spark, i.target, f.DS) for i in INGESTS}
    with pytest.raises(DataQualityError, match=message):
        jobs.load_day(spark, Source(spark, alter), f.DS)
    assert {i.target: tables.current_path(spark, i.target, f.DS) for i in INGESTS} == before
    assert tables.read_partition(spark, "ods.ods_order_info_di", f.DS).count() == 5


def test_sums_are_those_of_both_parts_of_the_md5(spark):
    schema = StructType.fromDDL("id bigint, name string")
    rows = [(k, None if k % 5 == 0 else f"n{k}") for k in range(200)]
    text = lambda v: "-" if v is None else f"{len(str(v))}:{v}"
    digests = [hashlib.md5("".join(map(text, r)).encode()).hexdigest() for r in rows]
    assert any(int(d[0], 16) > 7 for d in digests) and any(int(d[8], 16) > 7 for d in digests)
    df = spark.createDataFrame(rows, schema)
    got = fingerprint(df, schema)
    assert tuple(got.select(*SUMS).first()) == (
        200, sum(int(d[:8], 16) for d in digests), sum(int(d[8:16], 16) for d in digests))
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "decimal(38,0)", "decimal(38,0)"]
    assert tuple(fingerprint(df.limit(0), schema).select(*SUMS).first()) == (0, 0, 0)


def test_each_row_is_hashed_once_and_summed_as_whole_numbers(spark):
    schema = StructType.fromDDL("id bigint, name string")
    df = fingerprint(spark.createDataFrame([(1, "a")], schema), schema)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("md5(") == 1
    assert "sum(cast(conv" not in text
