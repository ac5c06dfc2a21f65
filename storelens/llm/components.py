"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node of the component.

    Each round a node takes the smallest root of its neighbours and then the root of its root, so long chains halve.
    """
    both = edges.where("a <> b").select("a", "b").unionByName(edges.where("a <> b").select(
        F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both)
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")))
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("root").alias("near_"))
        lower = roots.join(near, "node").select("node", F.least("root", "near_").alias("root"), F.col("root").alias("was_"))
        up = roots.select(F.col("node").alias("root"), F.col("root").alias("above_"))
        jumped = materialize(lower.join(up, "root", "left").select(
            "node", F.least("root", F.coalesce("above_", "root")).alias("root"), "was_"))
        if jumped.where("root <> was_").isEmpty():
            return jumped.select("node", "root")
        roots = jumped.select("node", "root")
