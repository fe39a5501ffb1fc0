"""Connected components by hooking to the smallest neighbouring label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (smallest node reachable) of every node of the edges (a, b).

    Each round takes the smallest label among the neighbours and then the label of that label,
    and is written to the shared folder; rounds end when no label changes. Loops, repeated edges
    and nulls do no harm. No edges give no rows.
    """
    pairs = edges.select("a", "b").filter("a <> b")
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        hooked = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("component"))
        roots = hooked.select(F.col("node").alias("component"), F.col("component").alias("root"))
        nxt = stored(hooked.join(roots, "component", "left").select("node", "old", F.least("component", F.coalesce("root", "component")).alias("component")), "labels")
        labels = nxt.select("node", "component")
        if nxt.filter("old <> component").isEmpty():
            return labels
