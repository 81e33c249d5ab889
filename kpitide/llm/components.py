"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpitide.llm.common import written

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of each node of ``a, b``; the component is its smallest node.

    Each round every node takes the smallest label next to it, and then the label of its label, so that the length of a chain halves. Labels
    are written to the shared folder each round. A node with many edges is no large group: labels are minima of partial minima.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b")
    both = written(both.distinct(), "component-edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "id"), "component-labels")
    for _ in range(MOST_ROUNDS):
        beside = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(beside, labels["id"] == beside["a"]).select(
            "id", F.col("component").alias("was"), F.least("component", "near").alias("component")
        )
        lower = written(lower, "component-lower")
        of_label = lower.select(F.col("id").alias("label"), F.col("component").alias("next"))
        jumped = lower.join(of_label, lower["component"] == of_label["label"]).select("id", "was", F.col("next").alias("component"))
        stepped = written(jumped, "component-labels")
        labels = stepped.select("id", "component")
        if stepped.where("was != component").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
