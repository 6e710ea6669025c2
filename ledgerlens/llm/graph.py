"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.scratch import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node reachable, for every node that has a link.

    Each round takes the smallest label among a node and its neighbours, then the
    label of that label (pointer jumping); it ends when no label changes, after
    about the logarithm of the longest path.  Rounds are stored tables, so a lost
    executor costs one round at most and no lineage builds up."""
    both = (links.select(F.col(a).alias("node"), F.col(b).alias("other"))
            .union(links.select(F.col(b).alias("node"), F.col(a).alias("other")))
            .filter("node <> other").distinct())
    edges = stored(both, "edges")
    labels = stored(edges.groupBy("node").agg(F.min("other").alias("low"))
                    .select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("label").alias("low")))
        spread = (labels.withColumnRenamed("label", "was").join(near, "node")
                  .select("node", "was", F.least("was", "low").alias("step")))
        jump = labels.select(F.col("node").alias("step"), F.col("label").alias("beyond"))
        moved = stored(spread.join(jump, "step", "left")
                       .select("node", "was", F.least(
                           "step", F.coalesce("beyond", "step")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("was <> label").limit(1).count() == 0:
            return labels
