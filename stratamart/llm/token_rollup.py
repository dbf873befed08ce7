"""Token counts kept by signed deltas: totals by source, language and tokenizer version.

A batch of changes holds inserted, deleted and revised counts of documents. It
becomes signed rows (documents, characters, tokens): an insert adds, a delete
takes away what the ledger holds, a revision takes away the old count and adds
the new one. The signed rows are summed per source, language and version and
committed under the batch's id; totals are the sum over all commits, so no
commit reads the corpus. A batch id names its folder (escaped, whatever its signs):
a batch that was committed before is left as it is when it is delivered again, and
one cut off by a failure has no ``_SUCCESS`` file, does not count and is written anew.

Defined results: null texts count 0 tokens; null source and language are groups
of their own; repeated rows of one insert are documents of their own; groups
that fall to no documents are left out; an empty change table commits nothing;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import shared_folder, stored, table
from stratamart.llm.subwords import VOCABULARY, encoding, sent

GROUP = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_chars", "n_tokens"]
#: Versions of ``rolled``; the last counts each text once.
WHITE_SPACE, SUBWORDS, DISTINCT = "white-space", "byte_bpe_50k", "byte_bpe_50k, each text once"
SHAPE = "source string, lang string, tokenizer string, n_docs long, n_chars long, n_tokens long"


def n_tokens(text: Column, vocabulary: Broadcast) -> Column:
    """Subword tokens of each whole text."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoding(vocabulary.value)
        for batch in batches:
            yield pd.Series([len(encoder.encode_ordinary(t)) if t else 0 for t in batch], dtype="int64")

    return count(text)


def counted(docs: DataFrame, tokenizer: str, vocabulary: Broadcast) -> DataFrame:
    """Ledger rows of documents: one count per document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"),
        n_tokens(F.col("text"), vocabulary).alias("n_tokens"),
    )


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Ledger rows as contributions to the totals."""
    return rows.select(
        *GROUP,
        F.lit(sign).cast("long").alias("n_docs"),
        (F.col("n_chars") * sign).alias("n_chars"),
        (F.col("n_tokens") * sign).alias("n_tokens"),
    )


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Signed rows that replace ledger rows by others."""
    return signed(old, -1).unionByName(signed(new, 1))


class Rollup:
    """Committed deltas under a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark, self.folder = spark, folder or shared_folder(spark)

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Sum the signed rows and write them as this batch, unless it is committed."""
        folder = f"{self.folder}/batch={quote(batch, safe='')}"
        if folder in self._committed():
            return
        sums = changes.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in SUMS])
        sums.write.mode("overwrite").parquet(folder)

    def _committed(self) -> list[str]:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        marks = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batch=*/_SUCCESS")
        found = marks.getFileSystem(conf).globStatus(marks) or []
        return sorted(f"{self.folder}/{status.getPath().getParent().getName()}" for status in found)

    def totals(self) -> DataFrame:
        """Documents, characters and tokens per group, from all committed batches."""
        folders = self._committed()
        if not folders:
            return self.spark.createDataFrame([], SHAPE)
        rows = self.spark.read.schema(SHAPE).parquet(*folders)
        sums = rows.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in SUMS])
        return sums.filter("n_docs <> 0 or n_chars <> 0 or n_tokens <> 0")


def rolled(spark: SparkSession, sf_dir: str, path: str) -> Rollup:
    """All documents through five batches: inserted under every version, subwords
    first with a provisional count by white space; that count revised to subwords;
    a part of the ledger deleted and inserted again; and the count without copies
    revised from all rows to one of each text, which is delivered again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    vocabulary = sent(spark, path)
    keyed = docs.withColumn("text_key", F.sha2(F.coalesce("text", F.lit("")), 256))
    slim = keyed.select(
        "doc_id",
        "source",
        "lang",
        "text_key",
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_words"),
        n_tokens(F.col("text"), vocabulary).alias("n_tokens"),
    )
    ledger = stored(slim)

    def rows(of: DataFrame, version: str, tokens: str = "n_tokens") -> DataFrame:
        return of.select("source", "lang", F.lit(version).alias("tokenizer"), "n_chars", F.col(tokens).alias("n_tokens"))

    words, provisional = rows(ledger, WHITE_SPACE, "n_words"), rows(ledger, SUBWORDS, "n_words")
    subwords, copied = rows(ledger, SUBWORDS), rows(ledger, DISTINCT)
    # Rows of a text are combined in the tasks, so a text may have any number of copies.
    by_text = ledger.groupBy("text_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "source", "lang")).alias("row"),
        F.max("n_chars").alias("n_chars"),
        F.max("n_tokens").alias("n_tokens"),
    )
    once = rows(by_text.select("row.source", "row.lang", "n_chars", "n_tokens"), DISTINCT)
    part = rows(ledger.filter(F.substring("text_key", 1, 1) == "0"), SUBWORDS)
    rollup = Rollup(spark)
    rollup.commit("insert", signed(words, 1).unionByName(signed(provisional, 1)).unionByName(signed(copied, 1)))
    rollup.commit("revise", revised(provisional, subwords))
    rollup.commit("delete", signed(part, -1))
    rollup.commit("insert_again", signed(part, 1))
    for _ in range(2):  # delivered twice, counted once
        rollup.commit("without_copies", revised(copied, once))
    return rollup


def op9_token_rollup(spark: SparkSession, sf_dir: str, path: str = VOCABULARY) -> DataFrame:
    """Totals without copies, in subword tokens: each text once, for its row of least
    doc_id (rows without one last, then the least source and language)."""
    totals = rolled(spark, sf_dir, path).totals().filter(F.col("tokenizer") == DISTINCT)
    return totals.withColumn("tokenizer", F.lit(SUBWORDS))


def token_totals(spark: SparkSession, sf_dir: str, path: str = VOCABULARY) -> DataFrame:
    """Totals of all rows, for each tokenizer version."""
    return rolled(spark, sf_dir, path).totals().filter(F.col("tokenizer") != DISTINCT)
