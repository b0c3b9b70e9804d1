"""Connected components over edge tables, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, keep


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of edges (a long, b long).

    Each round takes the least label among a node's own, its neighbours' and its label's; labels are
    written each round, so nothing but counts reaches the driver. Null ends are left out, loops and
    repeated edges do no harm, an empty table gives no rows."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = keep(both.filter(F.col("a").isNotNull() & F.col("b").isNotNull()).distinct())
    labels = keep(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("low")), "b").groupBy("a").agg(F.min("low").alias("low"))
        moved = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("label", "low").alias("label"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = keep(moved.join(jump, "label", "left").select("node", F.least("label", F.coalesce("further", "label")).alias("label"), "was"))
        changed = new.filter(F.col("label") != F.col("was")).limit(1).count()
        drop(labels)
        labels = new
        if not changed:
            drop(both)
            return labels.select("node", "label")
