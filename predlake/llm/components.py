"""Connected components of an edge table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) longs -> (node, root): root is the smallest node reachable. Nodes without an edge are absent.

    A round takes the least label among a node and its neighbours, then the
    label of that label, so chains halve from round to round. Labels only fall
    and a round that changes none ends the loop. Each round is written to the
    shared folder; nothing but one count reaches the driver. A node with very
    many edges is a key of a join (split by adaptive execution) and of a
    minimum (combined before the shuffle). An empty edge table gives no rows.
    """
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct(), "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("low")))
        lower = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "low").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        step = materialise(lower.join(jump, "mid", "left")
                           .select("node", "was", F.least("mid", F.coalesce("far", "mid")).alias("root")), "labels")
        labels = step.select("node", "root")
        if step.where("root <> was").isEmpty():
            return labels
