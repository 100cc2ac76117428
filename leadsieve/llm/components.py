"""Connected components of an edge table, by smallest labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsieve.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node connected to it) for every node of edges (a, b).

    Each round a node takes the smallest label among its neighbours and then that label's own label, so the rounds grow
    with the logarithm of a component's width for most shapes. Self edges are allowed. Only counts reach the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = staged(both, "edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("low"))
                    .select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("low"))
                .withColumnRenamed("a", "node"))
        taken = labels.join(near, "node").select(
            "node", F.least("label", "low").alias("next"), F.col("label").alias("was"))
        own = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        after = staged(taken.join(own, "next").select("node", F.least("next", "beyond").alias("label"), "was"), "labels")
        labels = after.select("node", "label")
        if after.filter("label <> was").isEmpty():
            return labels
