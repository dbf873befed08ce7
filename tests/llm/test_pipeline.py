"""The pipeline: each stage on what the one before it kept, and odd rows."""

import pytest

import corpus_pipeline
from stratamart.llm import decontam, mixing, near_dedup, quality
from stratamart.llm.common import stored

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs
        docs = stored(stage(spark, docs, SMALL))
        if name != "sharding":
            assert docs.columns == columns
    model = quality.fit(seen["quality"], spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = seen["quality"].select("doc_id", quality.score(model, "text").alias("s")).collect()
    good = {r.doc_id for r in scores if r.s >= quality.THRESHOLD}
    assert {r.doc_id for r in seen["near_dedup"].collect()} == good
    classes = {r.class_id for r in near_dedup.classes(seen["near_dedup"]).collect()}
    assert {r.doc_id for r in seen["decontam"].collect()} == classes
    items = [decontam.normal(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    mixed = seen["mixing"].collect()
    assert not any(i in decontam.normal(r.text) for r in mixed for i in items)
    copies = {r.doc_id: r["__mix_copies"] for r in mixing.mix(seen["mixing"]).collect()}
    assert seen["sharding"].count() == sum(copies.values()) == docs.count()
    assert set(docs.columns) == {*columns, "shard", "slot"}


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0)]])
def test_odd_documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SMALL)
    assert docs.count() <= len(rows)


def test_documents_with_the_columns_of_the_last_stage(spark):
    rows = [(1, "a b c", "en", "a", 5, "x", 9), (1, "a b c", "en", "a", 5, "x", 9), (2, None, None, None, None, None, None)]
    shape = "doc_id long, text string, lang string, source string, n_chars long, shard string, SLOT long"
    docs = spark.createDataFrame(rows, shape)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stored(stage(spark, docs, SMALL))
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert dict(docs.dtypes)["shard"] == "int" and docs.count() >= 1


def test_entry_lists_the_operators():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and sum(n.startswith("op") for n in names) == 13
    assert set(entry.oracle_sql()) <= set(names)
