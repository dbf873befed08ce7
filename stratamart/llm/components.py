"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); root is its least node.

    Each round takes the least label among the neighbors, then the label of that
    label, so long chains halve. Rounds end when no label changes; each is
    written to the shared folder, and only a count comes to the driver.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    edges = stored(both.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct())
    labels = stored(edges.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("root")))
    while True:
        of_other = labels.select(F.col("node").alias("other"), F.col("root").alias("near"))
        nearest = edges.join(of_other, "other").groupBy("node").agg(F.min("near").alias("near"))
        step = stored(
            labels.join(nearest, "node", "left").select(
                "node", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("root")
            )
        )
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("far"))
        # A root is the least node of its part so far, hence a node itself.
        labels = stored(
            step.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("far", "root")).alias("root"))
        )
        if labels.filter("old <> root").isEmpty():
            return labels.select("node", "root")
        labels = labels.select("node", "root")
