"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """node, label of every node of ``edges`` (a, b): the least node that can be reached.

    Each round a node takes the least label among its own and its neighbours', then the label of that
    label, so chains shorten by half or more. Labels are written to the shared folder each round, which
    cuts lineage; only the number of changes comes to the driver. Rows with a null are left out.
    """
    links = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    both = links.union(links.select("b", "a")).toDF("node", "other").distinct()
    both = stored(both)
    labels = stored(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("near"))
        )
        nearer = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = nearer.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("far", "label")).alias("label")
        )
        new = stored(new)
        if not new.where("label <> old").limit(1).count():
            return new.select("node", "label")
        labels = new.select("node", "label")
