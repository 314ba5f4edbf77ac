"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.sources.storage import materialize

# Rounds halve the depth of every tree; 60 suffice for any number of nodes that fits a long.
MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node that an edge ``(a, b)`` touches: its smallest member.

    Every round each node takes the smallest label around it, and then the label that this label
    has itself, so paths shorten by half. Labels are written to the shared folder after each
    round, which cuts the lineage. Both joins are on the node, where Spark can split a hub, and
    labels are pre-aggregated before they are exchanged. The edges are computed once: those of a
    spanning tree may be others the next time, and then their two directions would not match.
    """
    edges = materialize(edges.select("a", "b"), "links")
    both = materialize(
        edges.union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node"))
                         .agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    for _ in range(MAX_ROUNDS):
        around = (both.join(labels, both["b"] == labels["node"])
                  .groupBy("a").agg(F.min("label").alias("near")))
        nearest = (labels.join(around, labels["node"] == around["a"])
                   .select("node", F.col("label").alias("before"),
                           F.least("label", "near").alias("label")))
        target = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = materialize(nearest.join(target, "label", "left").select(
            "node", "before", F.least("label", F.coalesce("further", "label")).alias("label")),
            "labels")
        labels = new.select("node", "label")
        if new.where(F.col("before") != F.col("label")).isEmpty():
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError("labels did not settle")
