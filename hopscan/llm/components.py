"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hopscan.llm.store import checkpointed


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b) links: the smallest node reachable.

    Each round every node takes the smallest label next to it, then the label of its label, so the
    rounds grow with the logarithm of the longest path. Every round is a stored table.
    """
    both = checkpointed(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                        .filter("a <> b").distinct())
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("m"))
                          .select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("m")))
        step = (labels.join(near, labels.node == near.a)
                .select("node", F.col("component").alias("old"), F.least("component", "m").alias("component")))
        step = checkpointed(step)
        up = step.select(F.col("node").alias("at"), F.col("component").alias("up"))
        labels = checkpointed(step.join(up, step.component == up["at"]).select("node", "old", F.least("component", "up").alias("component")))
        if labels.filter("old <> component").isEmpty():
            return labels.select("node", "component")
        labels = labels.drop("old")
