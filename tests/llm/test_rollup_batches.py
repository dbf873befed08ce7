"""Redelivered and cut-off batches of token counts."""

import pytest
from pyspark.sql import functions as F

from stratamart.llm import token_rollup

ROW = [("s", "en", "v", 1, 5, 2)]


def changes(spark, sign=1):
    rows = [(s, lang, v, sign * d, sign * c, sign * t) for s, lang, v, d, c, t in ROW]
    return spark.createDataFrame(rows, token_rollup.SHAPE)


@pytest.mark.parametrize("batch", ["1", "2024/01/01 a:b=c%", "ü*?"])
def test_a_committed_batch_is_left_as_it_is(spark, tmp_path, batch):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "rollup"))
    rollup.commit(batch, changes(spark))
    lost = changes(spark).withColumn("n_docs", F.raise_error(F.lit("source lost")).cast("long"))
    rollup.commit(batch, lost)  # neither read nor written
    assert [tuple(r) for r in rollup.totals().collect()] == ROW
    rollup.commit(batch + "x", changes(spark))
    assert rollup.totals().first().n_docs == 2


def test_a_batch_that_was_cut_off_is_written_anew(spark, tmp_path):
    folder = tmp_path / "rollup"
    rollup = token_rollup.Rollup(spark, str(folder))
    rollup.commit("1", changes(spark))
    (folder / "batch=1" / "_SUCCESS").unlink()  # as if the writer had been lost
    assert rollup.totals().count() == 0
    rollup.commit("1", changes(spark))
    assert [tuple(r) for r in rollup.totals().collect()] == ROW
    rollup.commit("2", changes(spark, -1))
    assert rollup.totals().count() == 0
