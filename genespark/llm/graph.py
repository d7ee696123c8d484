"""Connected components as joins: no edge or label ever goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.llm.util import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over undirected `edges` (a, b), for every node of an edge.

    Each round takes the least root among the neighbours, then follows roots of roots; rounds go on until nothing
    changes (about the logarithm of the longest path). Hubs send one partial minimum a task.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a"), "left").select("node", F.col("root").alias("was"), F.least("root", F.coalesce("near", "root")).alias("root"))
        jump = labels.select(F.col("node").alias("at"), F.col("root").alias("far"))
        step = step.join(jump, F.col("root") == F.col("at"), "left").select("node", "was", F.least("root", F.coalesce("far", "root")).alias("root"))
        step = materialize(step, "labels")
        changed = step.where("root <> was").limit(1).count()
        discard(labels)
        labels = step.select("node", "root")
        labels._scratch_path = step._scratch_path
        if not changed:
            discard(both)
            return labels
