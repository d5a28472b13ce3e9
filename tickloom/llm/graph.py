"""Connected components of a stored edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.storage import stored



def components(edges: DataFrame) -> DataFrame:
    """(node, component) of undirected edges (a, b); component is the smallest node reachable.

    Every round each node takes the smallest label next to it and then the
    label of its label, until nothing changes.  Labels are written to the
    shared folder each round, so a lost executor costs at most one round.  An
    empty edge table gives an empty result; loops and repeated edges are harmless.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        low = labels.join(near, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("old"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("above"))
        new = stored(low.join(up, "component").select("node", F.least("component", "above").alias("component"), "old"), "labels")
        moved = new.where("component <> old").limit(1).count()
        labels = new.select("node", "component")
        if not moved:
            return labels
