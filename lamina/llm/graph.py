"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.session import written

# Up to so many edges the labels, at most two for each, are broadcast (about 20 MB); beyond it both sides are shuffled.
BROADCAST_EDGES = 200_000
# Rows of a written part.
_ROWS = 500_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of `edges` (a, b); the component is its least node.

    Each round takes the least label of the neighbours and then the label of the label; rounds end when none changes.
    Labels are written to the shared folder after each round. An empty edge table gives an empty result.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a is not null and b is not null").distinct(), "edges")
    edge_count = both.count()
    # A few rows in hundreds of files would cost more than the work on them.
    files = max(1, -(-edge_count // _ROWS))
    beside = F.broadcast if edge_count <= 2 * BROADCAST_EDGES else lambda df: df
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")).coalesce(files), "labels")
    while True:
        near = (
            both.coalesce(files).join(beside(labels.withColumnRenamed("node", "b")), "b").groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        step = beside(labels).join(near, "node").select("node", F.least("component", "near").alias("to"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("over"))
        moved = written(
            step.join(beside(jump), "to", "left").select(
                "node", F.least("to", "over").alias("component"), (F.least("to", "over") != F.col("was")).alias("moved")
            ).coalesce(files),
            "labels",
        )
        done = moved.where("moved").isEmpty()
        labels = moved.drop("moved")
        if done:
            return labels
